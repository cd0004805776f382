"""Sharding, mixing and URL filters against plain Python."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

pytest.importorskip("tessella.llm")

from tessella.llm.mixing import mix_to_targets, source_targets  # noqa: E402
from tessella.llm.sharding import keyed_rows, shard_by_splitters, splitters  # noqa: E402
from tessella.llm.urls import RULES, _canonical_sql, blocked_bloom, canonical_url, judge_urls, possible_hits  # noqa: E402


def sharded(rows, shards):
    """Shard and slot of each (doc_id, text) by sorting everything."""
    sized = sorted(
        ((zlib.crc32((t or "").encode()), i is not None, i or 0, len((t or "").encode()) + 1) for i, t in rows)
    )
    total, upto, slots, out = sum(s[3] for s in sized), 0, Counter(), []
    for crc, known, i, size in sized:
        upto += size
        shard = min(shards - 1, (2 * upto - size) * shards // (2 * total))
        out.append((i if known else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
    return out


TEXTS = [None, "", "a", "a", "a", "zoë", "x" * 5000, "b c", "b c", *[f"text {i} " * (i % 17) for i in range(300)]]


@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_shards_as_sorted(spark, documents, long_text, ranges):
    texts = [*TEXTS, long_text]
    ids = [None if i == 4 else i // 2 if i < 9 else i for i in range(len(texts))]
    got = shard_by_splitters(documents(texts, ids=ids), shards=4, ranges=ranges, per_range=2).collect()
    rows = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got]
    assert sorted(rows, key=str) == sorted(sharded(list(zip(ids, texts, strict=True)), 4), key=str)
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


def test_equal_rows_get_slots_of_their_own(spark, documents):
    got = shard_by_splitters(documents(["same"] * 40, ids=[1] * 40), shards=8).collect()
    assert Counter(r.shard for r in got) == dict.fromkeys(range(8), 5)
    assert sorted((r.shard, r.slot) for r in got) == [(s, i) for s in range(8) for i in range(5)]


def test_overfull_ranges_are_subdivided(spark, documents):
    docs = keyed_rows(documents(["hot words"] * 2000 + [f"t{i}" for i in range(1000)]))
    total = docs.groupBy().sum("size").first()[0]
    bounds, filled = splitters(docs, total, ranges=16, per_range=4, overfull=1.5)
    assert sum(n for _, _, n in filled) == 3000
    # One checksum holds two thirds of the rows and is cut many times by the id.
    assert max(b for _, b, _ in filled) <= 4 * total / 16
    assert len(bounds) >= 12


def test_shards_of_nothing(spark, documents):
    assert shard_by_splitters(documents([]), shards=8).count() == 0


def targets(sizes, cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if cap * sizes[s] < weight[s] * level}
        if not over:
            return target | {s: weight[s] * level for s in free}
        target |= {s: cap * sizes[s] for s in over}
        left -= sum(cap * sizes[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 3, "c": 2, "d": 500, None: 1}, {"a": 0, "b": 5}, {"": 4, "z": 100, "é": 7}])
def test_targets_share_the_excess(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(targets(sizes))


def test_mix_meets_targets_and_repeats(spark, documents, long_text):
    texts = [None, "", " \t\n", *[f"w{i} " * (i % 40 + 1) for i in range(400)], long_text[:2000], "same one", "same one"]
    sources = [None if i % 11 == 0 else ["a", "b", "c", "hot"][min(3, i % 9)] for i in range(len(texts))]
    docs = documents(texts, sources=sources, ids=[*range(len(texts) - 2), 9000, 9000])
    got = mix_to_targets(docs).collect()
    again = mix_to_targets(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id, r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert len(got) == len(texts)
    sizes = defaultdict(int)
    for t, s in zip(texts, sources, strict=True):
        sizes[s] += len((t or "").split())
    goal, taken, largest = targets(dict(sizes)), defaultdict(int), defaultdict(int)
    for r in got:
        assert r.taken == r.size * r.copies and r.taken <= 3 * r.size
        assert r.target == pytest.approx(goal[r.source]) and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= largest[s] / 2 + 1e-6


def test_better_documents_are_drawn_more_often(spark, documents):
    clean, junk = ["word " * 20] * 400, ["w##$$ " * 20] * 400
    docs = documents(clean + junk + ["b " * 40] * 1600, sources=["a"] * 800 + ["b"] * 1600)
    got = mix_to_targets(docs).where("source = 'a'").collect()
    assert {r.copies for r in got} <= {1, 2}
    twice = Counter(r.doc_id < 400 for r in got if r.copies == 2)
    assert twice[True] > 2 * twice[False]


def test_mix_of_nothing(spark, documents):
    assert mix_to_targets(documents([])).count() == 0
    assert {(r.copies, r.taken) for r in mix_to_targets(documents(["", None])).collect()} == {(0, 0)}


URLS = [
    None,
    "",
    "no scheme.com/x",
    "http://",
    "http://com",
    "http://com/",
    "HTTP://A.Example.COM/en/1?x=http://net/es/",
    "https://www.example.com/en/",
    "https://www.example.com/EN/",
    "https://x.www.example.com/en/a#b",
    "https://notexample.com/en/",
    "ftp://example.com?/en/",
    "http://example.com/en",
    "http://net/es/a",
    "http://a.b.net/fr/",
    "http://a.b.net/de/",
    "http://.com/",
    "http://com./",
    "http://x.org/" + "y" * 50_000,
    "http://" + "a." * 3000 + "net/es/",
    "http://net/es/a",
]


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_urls_as_judged_one_by_one(spark):
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    listed = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, listed).collect()}
    assert got == {i: judged(u) for i, u in enumerate(URLS)}
    assert judge_urls(pages.limit(0), listed).count() == 0
    empty = judge_urls(pages, listed.limit(0)).collect()
    assert len(empty) == len(URLS) and {(r.rule, r.verdict) for r in empty} == {(None, "allow")}


def test_bloom_filter_misses_nothing_and_passes_little(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS key")
    others = spark.range(20_000).selectExpr("concat('o', id) AS key")
    bloom, blocks = blocked_bloom(keys, "key")
    assert possible_hits(keys, "key", bloom, blocks).count() == 3000
    assert possible_hits(others, "key", bloom, blocks).count() < 400
    assert math.ceil(3000 * 16 / 512) == blocks


SPELLINGS = {
    "www.a.org/x/y?a=1&b=2": [
        "https://www.a.org/x/y?a=1&b=2",
        "HTTP://WWW.A.org:80/x/y/?b=2&a=1#top",
        "https://user:pass@www.a.org.:443/x/./z/../y?&utm_source=feed&a=1&b=2",
        "http://www.a.org/%78/y?%61=1&b=2&gclid=7",
        "ftp://www.a.org:/x/y//?a=1&b=2",
    ],
    "www.a.org:8080/": ["http://www.a.org:8080", "http://www.a.org:8080/..", "http://www.a.org:8080/?utm_id=3"],
    "www.a.org/%2F%zz%E4": ["http://www.a.org/%2f%zz%e4/"],
    None: [None, "", "www.a.org/x/y"],
}


def test_spellings_of_a_url_are_one(spark):
    rows = [(want, url) for want, urls in SPELLINGS.items() for url in urls]
    got = spark.createDataFrame(rows, "want string, url string").select("want", "url", canonical_url(F.col("url")).alias("got"))
    assert [(r.url, r.got) for r in got.collect()] == [(url, want) for want, url in rows]


def test_listed_urls_are_blocked_where_no_rule_fits(spark):
    urls = [u for us in SPELLINGS.values() for u in us] + ["http://www.example.com/en/1", "http://x.net/es/", "http://b.org/" + "y/" * 20_000]
    pages = spark.createDataFrame([(i, u, "c") for i, u in enumerate(urls * 2)], "page_id long, url string, canonical string")
    listed = spark.createDataFrame(RULES, "host string, path string, verdict string")
    blocked = spark.createDataFrame(
        [("http://www.a.org/x/y?b=2&a=1",), ("https://www.example.com/en/1",), (None,), ("http://b.org/" + "y/" * 20_000,)] * 2, "url string"
    )
    got = {r.page_id: (r.rule, r.verdict) for r in judge_urls(pages, listed, blocked=blocked).collect()}
    same = set(SPELLINGS["www.a.org/x/y?a=1&b=2"]) | {urls[-1]}
    fixed = {"http://www.example.com/en/1": ("www.example.com/en/", "allow"), "http://x.net/es/": ("net/es/", "block")}
    assert got == {i: fixed.get(u, (None, "block" if u in same else "allow")) for i, u in enumerate(urls * 2)}
    none = judge_urls(pages, listed, blocked=blocked.limit(0)).where("rule IS NULL AND verdict <> 'allow'")
    assert none.count() == 0


def test_rules_of_many_shapes(spark):
    rules = [(f"h{i % 7}.org", "/" + "ab" * (i % 40) + str(i), "block" if i % 3 else "allow") for i in range(300)]
    urls = [f"http://{'x.' * (i % 3)}h{i % 8}.org/{'ab' * (i % 41)}{i}/t" for i in range(320)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.rule for r in judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}

    def want(url):
        host, path = url.removeprefix("http://").split("/", 1)
        fits = [h + p for h, p, _ in rules if (host == h or host.endswith("." + h)) and ("/" + path).startswith(p)]
        return max(fits, key=len, default=None)

    assert got == {i: want(u) for i, u in enumerate(urls)}


def test_spellings_agree_with_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    urls = [u for us in SPELLINGS.values() for u in us] + [u for u in URLS if u is None or "%" not in u]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.key for r in rows.select("page_id", canonical_url(F.col("url")).alias("key")).collect() if r.key is not None}
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [list(r) for r in enumerate(urls)])
    assert got == dict(con.sql(f"WITH {_canonical_sql()} SELECT page_id, canonical FROM canonical").fetchall())

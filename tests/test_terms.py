"""Terms counted, weighted and compared inside the tasks, against the plain forms."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessella import operators as op
from tessella.functions import regex, text
from tessella.operators import terms as tm
from tessella.operators import vectorise
from tessella.operators.vectorise import pair_stats, top_vocabulary, term_stats

TOKENS = [["b", "a", "b", "a"], [], None, ["a"], ["é", "b", "é"], ["b", None, "a"]]


def grams(words):
    words = words or []
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:]) if a is not None and b is not None]
    return Counter([w for w in words if w is not None] + pairs)


def test_pairs_are_counted_in_the_task():
    row, code, counts, terms = tm.counted(pa.array(TOKENS, pa.list_(pa.string())), pairs=True)
    got = {(r, terms[c].as_py()): n for r, c, n in zip(row.tolist(), code.tolist(), counts.tolist(), strict=True)}
    assert got == {(i, t): n for i, words in enumerate(TOKENS) for t, n in grams(words).items()}


def test_statistics_need_no_row_per_text_and_term(spark):
    rows = [(i, "ab"[i % 2] if i % 5 else None, w) for i, w in enumerate(TOKENS * 20)]
    df = spark.createDataFrame(rows, "id int, g string, tokens array<string>").coalesce(1)
    counts, seen = defaultdict(int), defaultdict(int)
    for _, g, words in rows:
        for t, n in grams(words).items():
            counts[g, t] += n
            seen[g, t] += 1
    stats = term_stats(df, "tokens", "g", pairs=True)
    assert {(r.g, r.term): (r.df, r.tf) for r in stats.collect()} == {k: (seen[k], n) for k, n in counts.items()}
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_a_vocabulary_is_cut_before_it_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(tm, "MANY", 50)
    rows = [(g, f"t{i:04}", 1, random.Random(i).randint(1, 4)) for g in "ab" for i in range(3000)]
    stats = spark.createDataFrame(rows, "g string, term string, df long, tf long").repartition(3)
    sizes = spark.createDataFrame([("a", 9), ("b", 9)], "g string, n_docs long")
    top = top_vocabulary(stats, sizes, "g", 1200)
    expected = {(g, t) for g in "ab" for _, t in sorted((-tf, t) for h, t, _, tf in rows if h == g)[:1200]}
    assert {(r.g, r.term) for r in top.collect()} == expected
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 2 and plan.rindex("Window") < plan.index("MapInArrow")


def _random_words(n=300):
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(n * 8)] + ["é", None]
    rows = [(i, rng.choice(["a", "b", None]), rng.choices(words, k=rng.randint(0, 12))) for i in range(n)]
    return rows + rows[:20] + [(n, "a", None), (n, "small", ["x", "y", "x", "y"])]


@pytest.mark.parametrize("size, min_df, max_df, held", [(5, 1, None, 4), (40, 3, 60.0, 1 << 22), (7, 2, 30.0, 50), (None, 2, 200.0, 1)])
def test_only_pairs_that_can_be_among_the_most_used_are_counted(spark, monkeypatch, size, min_df, max_df, held):
    monkeypatch.setattr(tm, "PAIRS", held)
    monkeypatch.setattr(tm, "ROWS", 11)
    df = spark.createDataFrame(_random_words(), "id int, g string, tokens array<string>").repartition(3)
    for group in ("g", None):
        whole = term_stats(df, "tokens", group, pairs=True).collect()
        found = pair_stats(df, "tokens", group, size, min_df, max_df).collect()
        assert len(found) < len(whole) and len(found) == len(set(found))

        def top(rows):
            kept = [r for r in rows if r.df >= min_df and (max_df is None or r.df <= max_df)]
            order = sorted(kept, key=lambda r: (-r.tf, r.term))
            return {r for g in {r[0] if group else 0 for r in kept} for r in [x for x in order if not group or x[0] == g][:size]}

        assert top(found) == top(whole) and top(whole) and set(found) <= set(whole)


def test_pairs_are_not_shuffled_as_texts(spark, monkeypatch):
    """Index and features count words as texts, and pairs as numbers, unless there are too many words to hold."""
    rows = [(i, g or "c", " ".join(w for w in words or [] if w)) for i, g, words in _random_words()]
    df = spark.createDataFrame(rows, "id int, g string, text string")
    asked = []

    def spied(*args, pairs=False, **kwargs):
        asked.append(pairs)
        return term_stats(*args, pairs=pairs, **kwargs)

    monkeypatch.setattr(vectorise, "term_stats", spied)
    words = op.tokenize(df, "text", [])
    run = lambda: (
        op.build_index(df, "id", "g", "text", 30, []).vocab.orderBy("group", "term").collect(),
        op.fit_tfidf(words, "tokens", min_df=2, size=30, pairs=True),
    )
    numbers = run()
    assert asked == [False, False]
    monkeypatch.setattr(vectorise, "MAX_TERMS", 60)
    assert run() == numbers and True in asked


@pytest.mark.parametrize("pairs", [True, False])
def test_places_are_those_of_the_terms(pairs):
    vocab = ["a", "a b", "b b", "c", "é b"]
    row, at, counts = tm.Places(pa.array(vocab), pairs).counted(pa.array([*TOKENS, ["b", "b", "b", "zz", "c"]], pa.list_(pa.string())))
    got = {(r, vocab[p]): n for r, p, n in zip(row.tolist(), at.tolist(), counts.tolist(), strict=True)}
    lists = [*TOKENS, ["b", "b", "b", "zz", "c"]]
    assert got == {(i, t): n for i, w in enumerate(lists) for t, n in grams(w).items() if t in vocab and (pairs or " " not in t)}


def test_stored_words_are_taken(spark):
    rows = [(i, g, " ".join(w for w in words or [] if w) if i % 9 else None) for i, g, words in _random_words()]
    df = spark.createDataFrame(rows, "id int, g string, text string")
    stored = op.durable(op.tokenize(df, "text", ["w1"], "words"))
    parts = [op.build_index(stored.drop("text").withColumn("text", F.lit(None)), "id", "g", "text", 20, ["w1"], tokens="words")]
    parts.append(op.build_index(df, "id", "g", "text", 20, ["w1"]))
    for table in ("vocab", "weights", "sizes"):
        a, b = (sorted(map(tuple, getattr(x, table).collect()), key=str) for x in parts)
        assert a == b and a


def _index(rows):
    weights = [[{"term": t, "weight": w} for t, w in ws] for _, _, ws in rows]
    kind = pa.list_(pa.struct([("term", pa.string()), ("weight", pa.float64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([g for g, _, _ in rows]), pa.array([d for _, d, _ in rows]), pa.array(weights, kind)], ["group", "doc", "weights"]
    )


@pytest.mark.parametrize("cells", [1, 40, 1 << 22])
def test_closest_equals_sorting_all_pairs(monkeypatch, cells):
    monkeypatch.setattr(tm, "CELLS", cells)
    rng = random.Random(5)
    rows = [
        (rng.choice(["x", "y", None]), d, [(t, rng.choice([0.25, 0.5])) for t in rng.sample("abcdef", rng.randint(0, 4))])
        for d in rng.sample(range(500), 120)
    ]
    asked = [(q, rng.choice("xyz"), t, rng.choice([0.5, 1.0])) for q in (1, 2, 3, 4, None) for t in rng.sample("abcdefg", 3)]
    asked += asked[:2]  # what comes twice counts twice
    table = pa.table(dict(zip(["query_id", "group", "term", "q_weight"], map(list, zip(*asked)), strict=True)))
    batches = [_index(rows[i : i + 30]) for i in range(0, 120, 30)]
    got = [tuple(r.values()) for b in tm.Asked(table).closest(iter(batches), 5, 9) for r in b.to_pylist()]
    sums = defaultdict(dict)
    for q, g, t, x in asked:
        for h, d, ws in rows:
            for u, w in ws:
                if g == h and t == u:
                    sums[q, g][d] = sums[q, g].get(d, 0) + w * x
    expected = {(q, g, d, s) for (q, g), docs in sums.items() for d, s in sorted(docs.items(), key=lambda x: (-x[1], x[0]))[:5]}
    assert len(got) == len(expected) and set(got) == expected
    assert not list(tm.Asked(table.slice(0, 0)).closest(iter(batches), 5, 9))


def test_repeated_ids_are_summed_and_pairs_are_not_shuffled(spark):
    texts = [(1, "spark joins"), (2, "spark joins rows"), (2, "joins rows"), (3, "rows"), (4, "spark"), (5, "data")]
    df = spark.createDataFrame([(i, "a", t) for i, t in texts], "id bigint, g string, text string")
    queries = spark.createDataFrame([(1, "a", "spark joins rows")], "query_id bigint, group string, text string")
    index = op.build_index(df, "id", "g", "text", stop_words=[])
    expected = [tuple(r) for r in op.retrieve_topk(index, queries, 4, broadcast_rows=0).orderBy("rank").collect()]
    assert [tuple(r) for r in op.retrieve_topk(index, queries, 4).orderBy("rank").collect()] == expected
    once = op.build_index(df.where("id <> 2"), "id", "g", "text", stop_words=[])
    plan = op.retrieve_topk(once, queries, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "[group" not in "".join(x for x in plan.split("\n") if "Join" in x and "term" in x)


@pytest.mark.parametrize("pattern", [r"b\.?s", r"ph\.?d", "x?ab?", r"a\?b", "a[bc]", r"\.?"])
def test_spellings_are_all_texts_of_a_pattern(pattern):
    found = regex.spellings(pattern)
    if found is None:
        assert pattern in (r"a\?b", "a[bc]")
        return
    letters = "bsphdxa."
    words = {""} | {a + b + c + d for a in letters for b in ["", *letters] for c in ["", *letters] for d in ["", *letters]}
    assert set(found) == {w for w in words if re.fullmatch(pattern, w)}


def test_optional_letters_are_guarded(spark):
    df = spark.createDataFrame([("b.s",), ("bs degree",), ("abs",), ("b s",), ("bss",)], "t string")
    found = df.select(regex.search(F.col("t"), r"b\.?s\b").alias("found"))
    assert [r.found for r in found.collect()] == [True, True, True, False, False]
    assert "Contains" in found._jdf.queryExecution().optimizedPlan().toString()


def test_white_space_is_that_of_python(spark):
    """Of every character; printable ASCII is tested by a class of its own, around that of the others."""
    rows = [(f"a{chr(c)}b", len(f"a{chr(c)}b".split()), c) for c in [*range(0xD800), *range(0xE000, 0x11000), 0x10FFFF]]
    df = spark.createDataFrame(rows, "t string, n int, c int")
    assert df.where(text.word_count(F.col("t")) != F.col("n")).count() == 0
    outer = regex.NOT_SPACE[1:].split("[")[0]
    assert all(re.fullmatch(f"[{outer}]", chr(c)) for c in range(0x21, 0x7F))
    assert regex.NOT_SPACE.count("[") == 2


def test_large_batches_are_summed_and_weighed_in_parts(monkeypatch):
    """A batch is coded a few terms at a time, with the sums and weights of the whole; a row alone may have more, and lists may be null."""
    rng = random.Random(3)
    rows = [[f"w{rng.randrange(30)}" for _ in range(rng.randrange(40))] for _ in range(200)] + [None, [], ["w1"] * 90]
    batch = pa.RecordBatch.from_arrays([pa.array([i % 3 for i in range(len(rows))]), pa.array(rows, pa.list_(pa.string()))], ["group", "terms"])
    vocab, idf = pa.array([f"w{i}" for i in range(20)]), vectorise.np.arange(1.0, 21.0)
    batches = [batch, batch.slice(20, 50)]

    def found():
        sums, sizes, weights = defaultdict(lambda: [0, 0]), [], []
        code, of = tm.coded_terms, tm.Places.counted
        monkeypatch.setattr(tm, "coded_terms", lambda lists, pairs=False: sizes.append(len(lists.flatten())) or code(lists, pairs))
        monkeypatch.setattr(tm.Places, "counted", lambda self, lists: sizes.append(len(lists.flatten())) or of(self, lists))
        for part in tm.batch_stats(batches):
            for r in part.to_pylist():
                sums[r["group"], r["term"]][0] += r["df"]
                sums[r["group"], r["term"]][1] += r["tf"]
        for b in batches:
            weights += tm.weigh(b.column("terms"), tm.Places(vocab), idf, True).to_pylist()
        monkeypatch.setattr(tm, "coded_terms", code)
        monkeypatch.setattr(tm.Places, "counted", of)
        return dict(sums), weights, max(sizes)

    whole, weights, most = found()
    monkeypatch.setattr(tm, "TERMS", 100)
    assert most > 1000 and found() == (whole, weights, 100)
    assert len(weights) == 253 and tm.weigh(batch.column("terms").slice(0, 0), tm.Places(vocab), idf, True).to_pylist() == []

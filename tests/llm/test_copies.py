"""Near duplicates and repeated lines against plain Python."""

import random
import re

import numpy as np
import pytest

pytest.importorskip("tessella.llm")

from tessella.llm import near  # noqa: E402
from tessella.llm.graph import components  # noqa: E402
from tessella.llm.lines import dedup_lines  # noqa: E402


def shingled(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def grouped(rows):
    """(n_shingles, component) of each (doc_id, text), all pairs compared."""
    sets = [shingled(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            lowest[find(i)] = min(lowest.get(find(i), doc), doc)
    return [(len(s), lowest.get(find(i))) for i, s in enumerate(sets)]


def corpus(seed, n=140):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(n):
        kind = rng.randrange(6)
        if kind < 3 and texts:
            words = rng.choice(texts).split()
            for _ in range(rng.randrange(1, 3) if kind else rng.randrange(6)):
                at = rng.randrange(len(words) + 1)
                words[at : at + rng.randrange(2)] = [word() for _ in range(rng.randrange(2))]
            texts.append(" ".join(words) or "x")
        elif kind == 3:
            texts.append(" ".join(passage + [word() for _ in range(rng.randrange(4, 30))]))
        elif kind == 4:
            texts.append(" ".join(word() for _ in range(rng.randrange(1, 9))))
        else:
            texts.append(" ".join(word() for _ in range(rng.randrange(20, 120))))
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_as_all_pairs_give_them(spark, documents, long_text, seed):
    texts = [*corpus(seed), None, "", " \n\t", long_text, long_text + "x", "Same WORDS here", "same words\nHERE", "one", "one"]
    ids = [i * 7 % 1009 for i in range(len(texts))]
    ids[3] = ids[4] = 5000  # one id, two texts
    ids[-1] = ids[-2]  # a repeated row
    got = near.near_duplicates(documents(texts, ids=ids)).collect()
    rows = list(zip(ids, texts, strict=True))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(
        (doc, *g) for (doc, _), g in zip(rows, grouped(rows), strict=True)
    )


def test_frequent_shingles_change_no_component(spark, documents, monkeypatch):
    docs, texts = documents(corpus(4)), corpus(4)
    expected = grouped(list(enumerate(texts)))
    everything = np.unique(np.concatenate([near.shingles(t.encode()) for t in texts]))
    some = everything[::3]
    monkeypatch.setattr(near, "frequent_shingles", lambda rows: (some, np.arange(len(some))))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near.near_duplicates(docs).collect())
    assert got == [(i, *g) for i, g in enumerate(expected)]


def test_hot_groups_of_copies(spark, documents):
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(700):
        words = list(base)
        words[rng.randrange(120)] = f"x{i}"
        texts.append(" ".join(words))
    docs = documents(texts)
    tokens, counts = near.frequent_shingles(docs)
    assert 50 < len(tokens) <= 116 and counts.min() >= 100
    assert {r.component_id for r in near.near_duplicates(docs).collect()} == {0}


@pytest.mark.parametrize("hot", [0, 150])
def test_pairs_inside_components_are_listed(spark, documents, hot):
    rng = random.Random(hot)
    texts = [*corpus(5, 90), None, "", "same words", "Same WORDS"]
    for i in range(hot):  # more classes in a bucket than a leaf holds
        words = [f"w{k}" for k in range(120)]
        words[rng.randrange(120)] = f"x{i}"
        texts.append(" ".join(words))
    pairs, members = near.near_pairs(documents(texts))
    of = {r.doc_id: r.rep for r in members.collect()}
    assert len(of) == len(texts)
    sets = [shingled(t) for t in texts]
    assert all((of[i] is None) == (not s) for i, s in enumerate(sets))
    rep = {}
    for i, s in enumerate(sets):
        if s:
            assert rep.setdefault(of[i], s) == s
    expected = sorted(
        (a, b) for a in rep for b in rep
        if a < b and 100 * len(rep[a] & rep[b]) >= 80 * len(rep[a] | rep[b])
    )
    assert sorted((r.a, r.b) for r in pairs.collect()) == expected and expected


def test_the_first_of_each_group(spark, documents):
    docs = documents(["a b c d e f", "A b c d e f", "other words", "other words", None, ""], ids=[4, 2, 9, 9, None, 1])
    got = near.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.first) for r in got if r.doc_id is not None) == [(1, True), (2, True), (4, False), (9, True), (9, True)]
    assert near.near_duplicates(docs.limit(0)).count() == 0


def test_tree_finds_all_that_the_bound_allows():
    rng = np.random.default_rng(3)
    points = rng.poisson(3, (300, near.GROUPS))
    points[100:200] = points[:100] + rng.poisson(0.1, (100, near.GROUPS))
    points[7, 3] = points[107, 3] = 70_000
    assert (near.unpacked([near.packed(p) for p in points]) == points).all()
    assert near.unpacked([near.packed(p) for p in points[:5]]).dtype == np.uint8
    sizes = points.sum(1)
    tree = near.RTree(points, sizes)
    for i in range(0, 300, 7):
        bound = np.minimum(points, points[i]).sum(1)
        expected = np.flatnonzero(9 * bound >= 4 * (sizes + sizes[i]))
        assert sorted(tree.near(points[i], sizes[i])) == expected.tolist()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_that_have_not_settled_raise(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError, match="settled"):
        components(path, rounds=1)


def deduped(rows):
    """Lines kept of each (doc_id, text) when windows are seen one by one."""
    seen, out = set(), []
    for doc, text in sorted(rows):
        lines = text.split("\n")
        filled = [i for i, x in enumerate(lines) if re.search("[^\x20\x09-\x0d]", x)]
        gone = set()
        for k in range(len(filled) - 2):
            window = tuple(lines[i] for i in filled[k : k + 3])
            if window in seen:
                gone.update(filled[k : k + 3])
            seen.add(window)
        out.append((doc, "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)))
    return out


def test_lines_as_seen_one_by_one(spark, documents):
    rng = random.Random(1)
    texts = ["\n".join(rng.choice(["a", "b", "c", "", " ", "d e", "\t", "é"]) for _ in range(rng.randrange(25))) for _ in range(60)]
    texts += ["x\ny\nz", "x\ny\nz\n\nx\ny\nz", "line\n" * 4000]
    got = sorted(map(tuple, dedup_lines(documents(texts)).collect()))
    assert got == deduped(list(enumerate(texts)))


@pytest.mark.parametrize("share", [1, 10**9])
def test_hot_windows_are_removed_like_others(spark, documents, monkeypatch, share):
    """With 1 no window is hot, with the other share every one."""
    monkeypatch.setattr("tessella.llm.lines.HOT", share)
    texts = [f"head {i % 3}\nx\ny\nz\ntail {i}" for i in range(40)] + ["x\ny\nz"] * 3
    got = sorted(map(tuple, dedup_lines(documents(texts)).collect()))
    assert got == deduped(list(enumerate(texts)))


def test_lines_of_odd_rows(spark, documents):
    docs = documents([None, "", "a\nb\nc", "a\nb\nc", "a\nb\nc", "a\nb"], ids=[None, 0, None, 5, 5, 6])
    got = sorted(((r.doc_id is not None, r.doc_id), r.text is not None, r.text, r.n_removed) for r in dedup_lines(docs).where("doc_id is not null").collect())
    assert got == [((True, 0), True, "", 0), ((True, 5), True, "", 3), ((True, 5), True, "", 3), ((True, 6), True, "a\nb", 0)]
    assert sorted(map(str, [r.text for r in dedup_lines(docs).where("doc_id is null").collect()])) == ["None", "a\nb\nc"]
    assert dedup_lines(docs.limit(0)).count() == 0


def test_passages_on_one_and_two_lines(spark, documents):
    long = " ".join(f"w{i}" for i in range(51))
    half = [" ".join(f"{c}{i}" for i in range(26)) for c in "xy"]
    texts = [f"a\n{long}\nb\nc", f"d\n{long}\ne", "\n".join(["f", *half, "g"]), "\n".join(["h", *half, "i"]), "short", "short\n", "k\nl", "k\n\nl", "m\nshort\no"]
    got = {r.doc_id: (r.text, r.n_removed) for r in dedup_lines(documents(texts), passage=50).collect()}
    assert got[0] == (texts[0], 0) and got[1] == ("d\ne", 1)
    assert got[2] == (texts[2], 0) and got[3] == ("h\ni", 2)
    assert got[4] == ("short", 0) and got[5] == ("", 1) and got[6] == ("k\nl", 0) and got[7] == ("", 2)
    assert got[8] == (texts[8], 0)


def test_a_large_group_of_near_copies_is_united_before_its_pairs(spark, monkeypatch):
    """About half of the pairs of copies link; few of them are verified once the rounds are over."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for doc in range(240):
        words = list(base)
        for at in rng.sample(range(400), rng.randint(1, 8)):
            words[at] = f"x{doc}_{at}"
        rows.append((doc, " ".join(words)))
    taken, verified = [], near.verified

    def counted(pairs, *args, **kwargs):
        taken.append(pairs.count())
        return verified(pairs, *args, **kwargs)

    monkeypatch.setattr(near, "verified", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near.near_duplicates(docs).collect())
    assert found == [(doc, *g) for (doc, _), g in zip(rows, grouped(rows), strict=True)]
    assert taken[-1] <= 10 * len(rows), taken

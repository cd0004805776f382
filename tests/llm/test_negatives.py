"""Hard negatives against all products."""

import math

import numpy as np
import pytest

pytest.importorskip("tessella.llm")

from pyspark.sql import functions as F  # noqa: E402

from tessella.llm.negatives import Side, mine_hard_negatives, scores, shared_list, walked  # noqa: E402

KIND = "vec_id long, embedding array<double>, label int, score double, row string, rank int"


def brutally(rows, every, positives=5, negatives=10):
    """All results for the (id, vector, label) by Python's integers."""
    usable = [r for r in rows if None not in r and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in usable]
    out = []
    for a, (anchor, u, label) in enumerate(whole):
        if anchor % every:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(u, v, strict=False)), i, b, lab) for b, (i, v, lab) in enumerate(whole) if b != a)
        for minus, positive, _, _ in [r for r in ranked if r[3] == label][:positives]:
            fit = [(-s, i) for s, i, _, lab in ranked if lab != label and 30 * -minus <= 100 * -s <= 90 * -minus]
            out += [(anchor, positive, n + 1, i, -minus, s) for n, (s, i) in enumerate(fit[:negatives])]
    return sorted(out)


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, label, 0.5, "x", 1) for i, v, label in rows], KIND)


def mined(spark, rows, every, **settings):
    found = mine_hard_negatives(table_of(spark, rows), F.col("vec_id") % every == 0, **settings)
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("block, clusters", [(32_768, 64), (40, 5)])
def test_as_brute_force(spark, block, clusters):
    """Clusters, a hot direction, copies with equal scores, odd rows; small blocks are visited in two rounds."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    vectors = np.concatenate([centres[rng.integers(0, 6, 350)] + 0.7 * rng.normal(size=(350, 8)), np.tile(centres[0], (150, 1))]) / 8
    rows = [(int(i), v.tolist(), int(rng.integers(0, 4))) for i, v in enumerate(vectors)]
    rows += [(600, None, 1), (603, [math.nan] * 8, 1), (606, [None] * 8, 1), (609, [math.inf] * 8, 1), (612, [0.1] * 8, None)]
    rows += [(615, [0.0] * 8, 1), (618, [0.3] * 3, 1), (621, [], 2), (None, [0.3] * 8, 2), rows[0], rows[3]]
    got = mined(spark, rows, 3, block=block, clusters=clusters)
    want = brutally([(r[0], r[1], r[2]) if r[1] is None or len(r[1]) == 8 else (r[0], r[1] + [0.0] * (8 - len(r[1])), r[2]) for r in rows], 3)
    assert got == want
    assert len(got) > 1000


def test_nothing_to_mine(spark):
    assert mined(spark, [], 1) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)], 5) == []
    assert mined(spark, [(5, [1.0], 0), (2, [0.5], 1)], 5) == []
    assert mined(spark, [(5, [1.0], 0), (7, [1.0], 0), (2, [0.5], 1), (3, [0.5], 1)], 5) == [
        (5, 7, 1, 2, 65536, 32768),
        (5, 7, 2, 3, 65536, 32768),
    ]


def test_large_components(spark):
    rows = [(i, [2.0**22 * (i % 5 + 1), 3.0 * i, -(2.0**21)], i % 2) for i in range(40)]
    assert mined(spark, rows, 10) == brutally(rows, 10)


def test_scores_without_bound():
    x, y = np.array([[2.0**40, 1.0]]), np.array([[2.0**12, 3.0], [2.0**30, 1.0]])
    assert scores(x, y).tolist() == [[2**52 + 3, 2**63 - 1]]


def test_walk_stops_early():
    """Far candidates are never multiplied once the list certifies the end."""
    rng = np.random.default_rng(3)
    near = np.array([1.0, 0]) * 200 + rng.integers(-9, 9, (300, 2))
    far = np.array([0.0, 1]) * 200 + rng.integers(-9, 9, (9000, 2))
    vectors = np.concatenate([near, far]).round()
    block = Side(np.arange(9300), np.arange(9300), np.arange(9300) % 2, vectors)
    anchors = Side(np.array([-1]), np.array([-1]), np.array([0]), np.array([[200.0, 0.0]]))
    listed = shared_list(block, np.array([1.0, 0.0]), 0.0)
    asked = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            asked.append(np.size(key))
            return super().__getitem__(key)

    watched = block._replace(vectors=vectors.view(Watched))
    got = walked(anchors, [(np.array([-(10**16)]), np.array([10**16]))], watched, listed, 5, True)
    want = sorted((-int(vectors[i] @ [200, 0]), i) for i in range(0, 9300, 2))[:5]
    assert [(-s, i) for s, i in got[2:].T.tolist()] == want
    assert sum(asked) < 1000

"""The epsilon grid order join against all products."""

import math

import numpy as np
import pytest

pytest.importorskip("tessella.llm")

from tessella.llm.vectors import interval_join, linked, near_vectors, principal_axes, units  # noqa: E402

KIND = "vec_id long, embedding array<float>, label int, rep long, n_links string"


def brutally(rows, least=0.9):
    """n_links, component_id and kept of each (id, vector), by all pairs."""
    ok = [
        v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)
        for _, v in rows
    ]
    vectors = [np.asarray(v, np.float32).astype(float) if good else None for (_, v), good in zip(rows, ok, strict=True)]
    n = len(rows)
    near = [
        [j for j in range(n) if j != i and ok[i] and ok[j] and len(vectors[i]) == len(vectors[j])
         and vectors[i] @ vectors[j] / math.sqrt(vectors[i] @ vectors[i]) / math.sqrt(vectors[j] @ vectors[j]) >= least]
        for i in range(n)
    ]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        lead = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), lead, rows[i][0] == lead))
    return out


def clustered(seed, groups, size, dim, noise):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return (np.repeat(centres, size, 0) + noise * rng.normal(size=(groups * size, dim))).astype(np.float32)


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 3, 5, "x") for i, v in rows], KIND)


@pytest.mark.parametrize("interval, fan", [(8192, 8), (32, 2)])
def test_as_brute_force(spark, interval, fan):
    """Small intervals make several levels of interval pairs; hot groups of copies and near copies."""
    spread = clustered(1, 40, 6, 16, 0.25)
    hot = np.concatenate([clustered(2, 1, 80, 16, 0.05), np.tile(clustered(3, 1, 1, 16, 0), (60, 1))])
    rows = [(i * 3 % 1009, v.tolist()) for i, v in enumerate(np.concatenate([spread, hot]))]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [math.nan] * 16), (2004, [math.inf] + [1.0] * 15)]
    rows += [(2005, [None] + [1.0] * 15), (2006, [1.0, 0.0]), (2007, [2.0, 0.0]), (None, [1.0, 0.0]), (None, [0.0, 5.0])]
    rows += [(7, rows[7][1]), (rows[7][0], rows[7][1]), (2008, [3e38] * 16), (2009, [1e38] * 16), (2010, [0.25])]
    got = near_vectors(table_of(spark, rows), interval=interval, fan=fan).collect()
    want = brutally(rows)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(w[1] > 60 for w in want)


def test_chains_and_ties(spark):
    """A chain of small turns is one component; a cosine of exactly the threshold links."""
    turns = [(i, [math.cos(0.3 * i), math.sin(0.3 * i)]) for i in range(9)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(table_of(spark, turns)).collect()}
    assert got == {i: (1 if i in (0, 8) else 2, 0) for i in range(9)}
    even = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8])], "vec_id long, embedding array<double>")
    assert {r.n_links for r in near_vectors(even, least=0.6).collect()} == {1}


def test_no_rows_and_only_unusable_rows(spark):
    assert near_vectors(table_of(spark, [])).count() == 0
    got = near_vectors(table_of(spark, [(1, None), (2, [0.0])])).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("noise", [0.02, 0.2, 0.4])
def test_intervals_in_a_task(noise):
    rng = np.random.default_rng(5)
    vectors = clustered(4, 12, 30, 12, noise).astype(float)
    copies = rng.integers(1, 4, len(vectors))
    axes = principal_axes(units(vectors))
    hits = linked(units(vectors), units(vectors), 0.9, vectors, vectors)
    np.fill_diagonal(hits, False)
    whole = interval_join(vectors, copies, 0, axes, 0.9, leaf=16)
    assert (whole.counts == hits @ copies).all()
    cut = interval_join(vectors, copies, 150, axes, 0.9, leaf=16)
    hits[:150, :150] = hits[150:, 150:] = False
    assert (cut.counts == hits @ copies).all()
    for links, pairs in ((cut, hits),):
        i, j = np.nonzero(pairs)
        assert (links.root[i] == links.root[j]).all()

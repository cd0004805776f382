"""Hard-negative mining: anchors of a cluster share one list of candidates in the order of an angular bound."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import durable
from .registry import partitions, query, table

#: Anchors that the centroids are fitted on, and centroids; they decide no score.
SAMPLE, CLUSTERS, ROUNDS = 4_096, 64, 10
#: Candidates of a block, which a task holds; candidates first walked at once.
BLOCK, STEP = 32_768, 256
#: Scores beyond a long are given as the largest one.
MOST = 2**63 - 1
#: What rounding may take from a cosine bound.
SLACK = 1e-7


def quantised(vector: list | np.ndarray, dim: int, scale: float) -> bytes:
    """floor(scale * x) of each component, filled up with zeros; two bytes each where they fit."""
    with np.errstate(over="ignore"):
        whole = np.nan_to_num(np.floor(np.asarray(vector, np.float64) * scale))
    whole = np.r_[whole, np.zeros(dim - len(whole))]
    return whole.astype("<i2" if np.abs(whole).max(initial=0) < 2**15 else "<f8").tobytes()


def unpacked(column: list[bytes], dim: int) -> np.ndarray:
    """Quantised vectors as rows of whole numbers in doubles."""
    rows = [np.frombuffer(b, "<i2" if len(b) == 2 * dim else "<f8") for b in column]
    return np.stack(rows).astype(np.float64) if rows else np.zeros((0, dim))


def scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer inner products: by doubles where every sum is exact, else by integers without a bound."""
    largest = max(1.0, np.abs(x).max(initial=0)) * max(1.0, np.abs(y).max(initial=0)) * max(1, x.shape[1])
    if largest < 2**53:
        return (x @ y.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in m], object).reshape(m.shape) for m in (x, y)]
    return np.clip(whole[0] @ whole[1].T, -MOST, MOST).astype(np.int64)


def _directions(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and unit rows; a zero row has no direction and stays zero."""
    top = np.abs(rows).max(1, initial=0)
    scaled = rows / np.where(top > 0, top, 1)[:, None]
    size = np.sqrt((scaled * scaled).sum(1))
    return size * top, scaled / np.where(size > 0, size, 1)[:, None]


def centroids_of(sample: np.ndarray, clusters: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of the directions in ``sample``; the first ones lie far from each other."""
    points = _directions(sample)[1]
    chosen, near = [0], points @ points[0]
    while len(chosen) < min(clusters, len(points)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, points @ points[chosen[-1]])
    middle = points[chosen]
    for _ in range(rounds):
        of = (points @ middle.T).argmax(1)
        sums = np.zeros_like(middle)
        np.add.at(sums, of, points)
        moved = _directions(sums)[1]
        middle = np.where((moved != 0).any(1)[:, None], moved, middle)
    return middle


class Lists(NamedTuple):
    """Centroids, and the largest angle of each to one of its anchors."""

    centroids: np.ndarray
    radii: np.ndarray


def _placed(centroids: np.ndarray, dim: int):
    """A function of vectors: nearest centroid, angle to it, and length."""

    def place(column: pa.Array) -> pa.Array:
        size, points = _directions(unpacked(column.to_pylist(), dim))
        near = points @ centroids.T
        of = near.argmax(1)
        angle = np.arccos(near[np.arange(len(of)), of].clip(-1, 1))
        arrays = [pa.array(of.astype(np.int32)), pa.array(angle), pa.array(size)]
        return pa.StructArray.from_arrays(arrays, ["cell", "angle", "size"])

    return F.arrow_udf(place, "struct<cell:int,angle:double,size:double>").asNondeterministic()


class Best:
    """The first ``k`` candidates of each group, by score, then id; a group is a window of an anchor."""

    def __init__(self, groups: int, k: int) -> None:
        self.k, self.held = k, np.zeros((3, 0), np.int64)
        self.last = np.full(groups, -MOST - 1, np.int64)  # score that a candidate must reach
        self.full = np.zeros(groups, bool)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        held = np.concatenate([self.held, np.stack([group, score, ids])], 1)
        held = held[:, np.lexsort((held[2], -held[1], held[0]))]
        starts = np.flatnonzero(np.r_[True, held[0, 1:] != held[0, :-1]]) if held.shape[1] else np.zeros(0, int)
        lengths = np.diff(np.r_[starts, held.shape[1]])
        place = np.arange(held.shape[1]) - np.repeat(starts, lengths)
        self.held = held[:, place < self.k]
        done = lengths >= self.k
        at = held[0, starts[done]]
        self.full[at], self.last[at] = True, held[1, starts[done] + self.k - 1]


class Side(NamedTuple):
    """Rows of a block, or anchors."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


def shared_list(block: Side, centroid: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The block's candidates from the largest bound down, and the bounds for an anchor of length 1.

    No anchor of the cluster has a greater angle to the centroid than ``radius``, so its
    angle to a candidate is at least the candidate's angle to the centroid less the radius.
    """
    size, points = _directions(block.vectors)
    angle = np.arccos((points @ centroid).clip(-1, 1))
    bound = size * np.minimum(1, np.cos(np.maximum(0, angle - radius)) + SLACK)
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def walked(anchors: Side, windows: list[tuple[np.ndarray, np.ndarray]], block: Side, listed, k: int, same: bool) -> np.ndarray:
    """(anchor, window, score, id) of the first ``k`` of the block in every window of each anchor.

    Every anchor walks the shared list from its head and stops where it is certain that no
    later candidate can enter a window: the bound times its length is under the score of
    the window's last one, or under the window's lower end.
    """
    order, bound = listed
    size = _directions(anchors.vectors)[0] * (1 + SLACK)
    owner = np.repeat(np.arange(len(windows)), [len(lo) for lo, _ in windows])
    nth = np.concatenate([np.arange(len(lo)) for lo, _ in windows]) if windows else np.zeros(0, int)
    low = np.concatenate([lo for lo, _ in windows]) if windows else np.zeros(0, np.int64)
    high = np.concatenate([hi for _, hi in windows]) if windows else np.zeros(0, np.int64)
    best, at, step = Best(len(owner), k), 0, STEP
    open_groups = np.flatnonzero(low <= high)
    while at < len(order) and len(open_groups):
        reach = size[owner[open_groups]] * bound[at]
        need = np.maximum(low, best.last)[open_groups]
        open_groups = open_groups[reach >= need]
        members, of = np.unique(owner[open_groups], return_inverse=True)
        if not len(members):
            break
        part = order[at : at + step]
        found = scores(anchors.vectors[members], block.vectors[part])
        fits = (anchors.labels[members][:, None] == block.labels[part][None, :]) == same
        fits &= anchors.rows[members][:, None] != block.rows[part][None, :]
        span = max(1, (1 << 22) // max(1, len(part)))
        for i in range(0, len(open_groups), span):
            group, row = open_groups[i : i + span], of[i : i + span]
            floor = np.maximum(low[group], best.last[group])[:, None]
            hits = fits[row] & (found[row] >= floor) & (found[row] <= high[group][:, None])
            g, c = np.nonzero(hits)
            best.add(group[g], found[row[g], c], block.ids[part[c]])
        at, step = at + step, min(2 * step, 8_192)
    group, score, ids = best.held
    return np.stack([anchors.rows[owner[group]], nth[group], score, ids]) if len(group) else np.zeros((4, 0), np.int64)


def _walks(lists: Lists, dim: int, k: int, same: bool):
    """A function of rows sorted by block, kind and cluster: a block's candidates, then the anchors that visit it."""

    def side(tab: pa.Table) -> Side:
        ints = [np.asarray(tab[c], np.int64) for c in ("row", "id", "label")]
        return Side(*ints, unpacked(tab["q"].to_pylist(), dim))

    def visit(block: Side, cluster: int, tab: pa.Table, known: dict) -> pa.RecordBatch:
        if cluster not in known:
            known.clear()
            known[cluster] = shared_list(block, lists.centroids[cluster], lists.radii[cluster])
        lo, hi = (tab[c].to_pylist() for c in ("lo", "hi"))
        windows = [(np.array(a, np.int64), np.array(b, np.int64)) for a, b in zip(lo, hi, strict=True)]
        found = walked(side(tab), windows, block, known[cluster], k, same)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["row", "window", "score", "id"])

    def run(batches):
        block, pieces, held, known = None, [], None, {}
        for batch in batches:
            tab = pa.Table.from_batches([batch])
            blocks, kinds, clusters = (np.asarray(tab[c], np.int64) for c in ("block", "kind", "cluster"))
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0) | (np.diff(clusters) != 0)) + 1
            for a, b in zip(np.r_[0, edges], np.r_[edges, len(blocks)], strict=True):
                if b == a:
                    continue
                if block != blocks[a]:
                    block, pieces, held, known = blocks[a], [], None, {}
                run_of = tab.slice(a, b - a)
                if kinds[a] == 0:
                    pieces.append(side(run_of))
                    continue
                if held is None:
                    held = Side(*(np.concatenate(x) for x in zip(*pieces, strict=True))) if pieces else side(run_of.slice(0, 0))
                yield visit(held, int(clusters[a]), run_of, known)

    return run


def _found(visits: DataFrame, candidates: DataFrame, lists: Lists, dim: int, k: int, same: bool) -> DataFrame:
    """(row, window, score, id): the first ``k`` of each visited block, for every anchor and window."""
    none = F.lit(None).cast("array<long>")
    visited = durable(visits.select("block").distinct())
    held = candidates.join(visited, "block", "left_semi").select(
        "block", F.lit(0).alias("kind"), F.lit(0).alias("cluster"), "row", "id", "label", "q", none.alias("lo"), none.alias("hi")
    )
    asked = visits.select("block", F.lit(1).alias("kind"), "cluster", "row", "id", "label", "q", "lo", "hi")
    dealt = held.unionByName(asked).repartition(partitions(candidates), "block")
    ordered = dealt.sortWithinPartitions("block", "kind", "cluster")
    return durable(ordered.mapInArrow(_walks(lists, dim, k, same), "row long, window long, score long, id long"))


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` over all blocks, ranked from 1."""
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(anchors: DataFrame, candidates: DataFrame, bounds: DataFrame, lists: Lists, dim: int, k: int, same: bool) -> DataFrame:
    """(row, window, score, id, rank) over all blocks.

    First each anchor visits the blocks of its own cell; what it found there rules out
    the other blocks whose bound cannot reach it.
    """
    own = durable(bounds.where("cell = cluster").select("block", "cluster"))
    near = _found(anchors.join(own, "cluster"), candidates, lists, dim, k, same)
    lasts = _first(near, k).where(F.col("rank") == k).groupBy("row").agg(
        F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("lasts")
    )
    floors = F.transform("lo", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("lasts", i.cast("long")), x)))
    real = F.filter(F.zip_with(floors, F.col("hi"), lambda x, y: F.when(x <= y, x)), lambda x: x.isNotNull())
    asking = durable(anchors.join(lasts, "row", "left").withColumn("need", F.array_min(real)).drop("lasts"))
    others = bounds.where("cell <> cluster").withColumnRenamed("cluster", "of")
    reach = F.col("size") * (1 + SLACK) * F.col("bound") >= F.col("need")
    visits = asking.join(others, (F.col("cluster") == F.col("of")) & reach).drop("of")
    return _first(near.unionByName(_found(visits, candidates, lists, dim, k, same)), k)


def _share(score: Column, hundredths: int, extra: int) -> Column:
    """floor((score * hundredths + extra) / 100) without leaving the range of a long."""
    score = F.greatest(score, F.lit(-MOST + 100))
    rest = F.pmod(score, F.lit(100))
    hundreds = F.call_function("div", score - rest, F.lit(100))
    return hundreds * hundredths + F.floor((rest * hundredths + extra) / 100)


def mine_hard_negatives(
    df: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
    clusters: int = CLUSTERS,
    block: int = BLOCK,
) -> DataFrame:
    """The nearest rows of other labels under each anchor's positives, exactly.

    Vectors become whole numbers, floor(scale * x); a score is their integer inner
    product. An anchor's positives are its best ``positives`` other rows of the same
    label; for each, the best ``negatives`` rows of other labels whose score is ``low``
    to ``high`` hundredths of the positive's are returned. Equal scores go by id.

    Anchors are clustered by direction around centroids fitted on at most 4,096 of them.
    Candidates lie in blocks of a bounded size by their nearest centroid. In each block
    the candidates are sorted once for each cluster by an upper bound from their angle to
    its centroid; every member walks that list until what it has found certifies that
    nothing later can enter. Anchors visit the blocks of their own cell first, and then
    only those that their scores so far do not rule out.

    ``anchors`` is a condition over the columns of ``df``. Returns anchor_id, positive_id,
    rank (from 1), negative_id, positive_score, negative_score. Rows with a null id, label or vector, or a
    null or non-finite component take no part; short vectors, empty ones too, count as
    filled up with zeros. Repeated rows are rows of their own, as candidates and as
    anchors. A positive with a score under zero has no window. Scores beyond a
    long are given as the largest one. An empty table or one without anchors gives no rows; other columns are
    ignored. Evenly spread directions leave little to skip: then every anchor is
    multiplied with every candidate, in blocks.
    """
    spark = df.sparkSession
    double = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    whole = df.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & F.coalesce(finite, F.lit(False)))
    chosen = whole.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
        double.alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asks"),
    )
    dim = max(1, chosen.agg(F.max(F.size("vector"))).first()[0] or 1)

    def pack(column: pa.Array) -> pa.Array:
        return pa.array([quantised(v, dim, scale) for v in column.to_pylist()], pa.binary())

    packed = F.arrow_udf(pack, "binary").asNondeterministic()
    rows = durable(chosen.select("id", "label", "asks", packed("vector").alias("q")).withColumn("row", F.monotonically_increasing_id()))
    sample = rows.where("asks").orderBy(F.xxhash64("id", "row")).limit(SAMPLE).select("q").collect()
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not sample:
        return empty
    points = unpacked([bytes(r.q) for r in sample], dim)
    middle = centroids_of(points, max(1, min(clusters, len(points) // 32)))
    placed = durable(rows.withColumn("p", _placed(middle, dim)("q")).select("id", "label", "asks", "q", "row", "p.*"))
    asking = placed.where("asks").withColumnRenamed("cell", "cluster")
    # A row for each centroid, of which there are at most `clusters`.
    radii = {r.cluster: r.r for r in asking.groupBy("cluster").agg(F.max("angle").alias("r")).collect()}
    lists = Lists(middle, np.array([radii.get(i, 0.0) for i in range(len(middle))]))
    sizes = {r.cell: r.n for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = F.get(F.array(*[F.lit(-(-sizes.get(i, 0) // block) or 1).cast("long") for i in range(len(middle))]), F.col("cell"))
    candidates = placed.withColumn("block", F.col("cell") * F.lit(1 << 32) + F.pmod(F.xxhash64("row"), parts))
    candidates = durable(candidates.select("block", "row", "id", "label", "q", "cell", "angle", "size"))
    between = np.arccos((middle @ middle.T).clip(-1, 1))
    # The least angle between a cluster's anchors and a block, less the block's own radius.
    apart = F.array(*[F.array(*[F.lit(float(max(0.0, between[i, j] - lists.radii[j]))) for j in sorted(radii)]) for i in range(len(middle))])
    names = F.array(*[F.lit(j) for j in sorted(radii)])
    blocks = durable(
        candidates.groupBy("block", "cell").agg(F.max("angle").alias("radius"), F.max("size").alias("largest"))
    )
    listed = F.transform(F.get(apart, F.col("cell")), lambda x, i: F.struct(F.get(names, i).alias("cluster"), x.alias("apart")))
    cosine = F.cos(F.greatest(F.col("apart") - F.col("radius"), F.lit(0.0))) + SLACK
    bound = F.col("largest") * F.greatest(cosine, F.lit(0.0))
    bounds = durable(blocks.select("block", "cell", "radius", "largest", F.inline(listed)).select("block", "cell", "cluster", bound.alias("bound")))

    asking = durable(asking.select("cluster", "row", "id", "label", "q", "size"))
    all_of = asking.withColumns({"lo": F.array(F.lit(-MOST)), "hi": F.array(F.lit(MOST))})
    best = durable(_searched(all_of, candidates, bounds, lists, dim, positives, True).drop("window"))
    lo, hi = _share(F.col("score"), low, 99), _share(F.col("score"), high, 0)
    windows = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", lo.alias("lo"), hi.alias("hi")))).alias("w"))
    windows = windows.select("row", F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"))
    hard = durable(_searched(asking.join(windows, "row"), candidates, bounds, lists, dim, negatives, False))
    named = best.select("row", (F.col("rank") - 1).cast("long").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        hard.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        .join(named, ["row", "window"])
        .join(asking.select("row", F.col("id").alias("anchor_id")), "row")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


@query("""
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, with the labels of every seventh turned by one."""
    rows = table(spark, sf_dir, "embeddings")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.withColumn("label", turned), F.col("vec_id") % 100 == 0)

"""Embedding near-dedup: an epsilon grid order join over the vectors' principal axes."""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, FloatType

from ..session import durable
from .graph import components
from .registry import partitions, query, table

#: Vectors that the axes are fitted on; they steer the order and decide no link.
SAMPLE = 8_192
#: Leading axes whose cells give the order.
AXES = 8
#: Vectors of a sequence interval that a task holds, intervals under one of the level above, and vectors multiplied at once.
INTERVAL, FAN, LEAF = 8_192, 8, 256
#: Cosines this near to the threshold are summed again, in an order of their own.
BORDER = 1e-9


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null, no null or non-finite component, not zero."""
    double = vector.cast("array<double>")
    finite = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(finite & F.exists(double, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The lists of one length as rows of doubles."""
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two, which is exact, so that no square overflows."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1, keepdims=True))[1])


def units(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1."""
    rows = scaled(rows)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def principal_axes(rows: np.ndarray) -> np.ndarray:
    """An orthonormal basis as columns, the axis of the largest variance first."""
    spread = rows - rows.mean(0)
    return np.linalg.eigh(spread.T @ spread)[1][:, ::-1]


def _leads(axes: np.ndarray, kept: int):
    """A function of vectors: their coordinates on the leading axes."""

    def leads(vectors: pa.Array) -> pa.Array:
        found = units(matrix(vectors, len(axes))) @ axes[:, :kept]
        offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * kept)
        return pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))

    return F.arrow_udf(leads, "array<double>").asNondeterministic()


def _numbered(df: DataFrame, order: str, out: str) -> DataFrame:
    """Add 0, 1, .. by ``order``, a column of different values: range by range, each from where the one before ends."""
    dealt = durable(df.repartitionByRange(partitions(df), order).withColumn("part", F.spark_partition_id()))
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = durable(counts.withColumn("start", F.coalesce(upto, F.lit(0))))  # a row for each partition
    inside = Window.partitionBy("part").orderBy(order)
    numbered = dealt.withColumn(out, F.row_number().over(inside) - 1)
    return numbered.join(starts.select("part", "start"), "part").withColumn(out, F.col(out) + F.col("start")).drop("part", "start")


def _interval_pairs(sequence: DataFrame, n_intervals: int, eps: float, fan: int) -> DataFrame:
    """(a, b): pairs of intervals, a <= b, whose boxes on the leading axes lie within ``eps``.

    Recursive, all pairs of one level at once: a pair of larger intervals that is near
    enough is followed into the pairs of their parts.
    """
    spark = sequence.sparkSession
    kept = range(AXES)
    bounds = [f(F.get("lead", F.lit(i))).alias(f"{side}{i}") for i in kept for side, f in (("lo", F.min), ("hi", F.max))]
    boxes = durable(sequence.groupBy("interval").agg(*bounds))
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    depth = max(1, math.ceil(math.log(max(n_intervals, 2), fan)))
    for level in range(depth - 1, -1, -1):
        node = F.floor(F.col("interval") / F.lit(fan**level)).cast("long")
        ends = [f(f"{s}{i}").alias(f"{s}{i}") for i in kept for s, f in (("lo", F.min), ("hi", F.max))]
        nodes = durable(boxes.groupBy(node.alias("node")).agg(*ends).withColumn("up", F.floor(F.col("node") / fan).cast("long")))
        both = pairs.join(nodes.alias("x"), F.col("a") == F.col("x.up")).join(nodes.alias("y"), F.col("b") == F.col("y.up"))

        def gap(i):
            apart = F.greatest(F.col(f"x.lo{i}") - F.col(f"y.hi{i}"), F.col(f"y.lo{i}") - F.col(f"x.hi{i}"), F.lit(0.0))
            return F.coalesce(apart * apart, F.lit(0.0))  # short vectors have fewer axes

        near = functools.reduce(lambda s, t: s + t, [gap(i) for i in kept]) <= F.lit(eps * eps + BORDER)
        pairs = durable(
            both.where(near & (F.col("x.node") <= F.col("y.node"))).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        )
    return pairs


class Links:
    """Links of the vectors of a task: how many each has, and the components so far."""

    def __init__(self, copies: np.ndarray) -> None:
        self.copies, self.counts, self.root = copies, np.zeros(len(copies), np.int64), np.arange(len(copies))

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        """Components of the pairs (x[i], y[i]) become one; each takes its smallest root."""
        while True:
            a, b = self.root[x], self.root[y]
            apart = np.flatnonzero(a != b)
            if not len(apart):
                return
            lo, hi = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            np.minimum.at(self.root, hi, lo)
            while (above := self.root[self.root] != self.root).any():
                self.root[above] = self.root[self.root[above]]

    def add(self, x: np.ndarray, y: np.ndarray, hits: np.ndarray, one_side: bool) -> None:
        """Links where ``hits`` of vectors ``x`` against ``y``; ``one_side``: x is y, and each pair stands twice."""
        self.counts[x] += hits @ self.copies[y]
        if not one_side:
            self.counts[y] += hits.T @ self.copies[x]
        i, j = np.nonzero(hits & (self.root[x][:, None] != self.root[y][None, :]))
        self.join(x[i], y[j])

    def add_all(self, x: np.ndarray, y: np.ndarray, one_side: bool) -> None:
        """Every vector of ``x`` links with every one of ``y``."""
        own = self.copies[x] if one_side else 0
        self.counts[x] += self.copies[y].sum() - own
        if not one_side:
            self.counts[y] += self.copies[x].sum()
        self.join(np.concatenate([x, y]), np.full(len(x) + len(y), x[0]))


def linked(x: np.ndarray, y: np.ndarray, least: float, rows_x: np.ndarray, rows_y: np.ndarray) -> np.ndarray:
    """Which cosines of the unit rows ``x`` and ``y`` are ``least`` or more.

    Those at the border are summed again from the rows themselves, so that they don't
    depend on what is multiplied with them.
    """
    cosines = x @ y.T
    hits = cosines >= least
    for i, j in zip(*np.nonzero(np.abs(cosines - least) < BORDER), strict=True):
        a, b = rows_x[i], rows_y[j]
        hits[i, j] = math.fsum(a * b) / (math.sqrt(math.fsum(a * a)) * math.sqrt(math.fsum(b * b))) >= least
    return hits


def interval_join(rows: np.ndarray, copies: np.ndarray, split: int, axes: np.ndarray, least: float, leaf: int = LEAF) -> Links:
    """Links within a sequence of ``rows``, or between its first ``split`` and the rest.

    Intervals of leaves are halved until their boxes on all axes are farther apart than
    the threshold's distance, or one leaf is left on either side. Two leaves whose balls
    are certainly within the angle link as a whole, without a product; others are multiplied.
    """
    links, rows = Links(copies), scaled(rows)
    vectors = units(rows)
    eps, angle = math.sqrt(2 - 2 * least), math.acos(least)
    turned = vectors @ axes
    sides = [(0, split), (split, len(vectors))] if split else [(0, len(vectors))]
    leaves = [[np.arange(i, min(i + leaf, hi)) for i in range(lo, hi, leaf)] for lo, hi in sides]
    low, high, centres, radii = [], [], [], []
    for side in leaves:
        low.append(np.stack([turned[at].min(0) for at in side]))
        high.append(np.stack([turned[at].max(0) for at in side]))
        middle = units(np.stack([turned[at].mean(0) + 1e-30 for at in side]))
        centres.append(middle)
        radii.append([np.arccos((turned[at] @ c).clip(-1, 1)).max() for at, c in zip(side, middle, strict=True)])
    p, q = 0, len(leaves) - 1
    open_pairs = [(0, len(leaves[p]), 0, len(leaves[q]))]
    while open_pairs:
        i, j, k, m = open_pairs.pop()
        if p == q and m <= i:
            continue  # the other half of the square
        apart = np.maximum(low[p][i:j].min(0) - high[q][k:m].max(0), low[q][k:m].min(0) - high[p][i:j].max(0)).clip(0)
        if apart @ apart > eps * eps + BORDER:
            continue
        if j - i > 1 or m - k > 1:
            if j - i >= m - k:
                half = (i + j) // 2
                open_pairs += [(i, half, k, m), (half, j, k, m)]
            else:
                half = (k + m) // 2
                open_pairs += [(i, j, k, half), (i, j, half, m)]
            continue
        if p == q and k < i:
            continue
        x, y, same = leaves[p][i], leaves[q][k], p == q and i == k
        between = math.acos(max(-1.0, min(1.0, float(centres[p][i] @ centres[q][k])))) if not same else 0.0
        reach = radii[p][i] + radii[q][k]
        if between - reach > angle + 1e-6:
            continue
        if between + reach < angle - 1e-6:
            links.add_all(x, y, same)
            continue
        hits = linked(vectors[x], vectors[y], least, rows[x], rows[y])
        if same:
            np.fill_diagonal(hits, False)
        links.add(x, y, hits, same)
    return links


def _joined(axes: np.ndarray, least: float):
    """A function of a tile's rows (a, b, interval, rep, copies, vector): (rep, root, links) of those that link."""

    def join(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by([("interval", "ascending"), ("seq", "ascending")])
        interval, reps = np.asarray(rows["interval"]), np.asarray(rows["rep"], np.int64)
        copies = np.asarray(rows["copies"], np.int64)
        vectors = matrix(rows["vector"].combine_chunks(), len(axes))
        split = int(np.count_nonzero(interval == interval[0])) % len(interval)
        links = interval_join(vectors, copies, split, axes, least)
        at = np.flatnonzero(links.counts)
        return pa.table({"rep": reps[at], "root": reps[links.root[at]], "links": links.counts[at]})

    return join


def _class_links(classes: DataFrame, dim: int, least: float, interval: int, fan: int) -> DataFrame:
    """(rep, root, links) of classes of one length, a row for each tile where a class links."""
    spark = classes.sparkSession
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vector").toArrow()
    axes = principal_axes(units(matrix(sample["vector"].combine_chunks(), dim)))
    kept, eps = min(AXES, dim), math.sqrt(2 - 2 * least)
    placed = classes.withColumn("lead", _leads(axes, kept)("vector"))
    cell = F.transform("lead", lambda x: F.floor(x / F.lit(eps)).cast("int"))
    ordered = durable(placed.withColumn("place", F.struct(cell.alias("cell"), "rep")))
    sequence = durable(
        _numbered(ordered, "place", "seq").drop("place").withColumn("interval", F.floor(F.col("seq") / interval).cast("long"))
    )
    last = sequence.agg(F.max("interval")).first()[0]
    pairs = _interval_pairs(sequence, last + 1, eps, fan)
    ends = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("interval"))
    tiles = sequence.select("interval", "seq", "rep", "copies", "vector").join(durable(ends), "interval")
    # A tile holds two intervals at most.
    return tiles.groupBy("a", "b").applyInArrow(_joined(axes, least), "rep long, root long, links long")


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.9,
    interval: int = INTERVAL,
    fan: int = FAN,
) -> DataFrame:
    """Links and components of all vectors whose cosine is ``least`` or more, in double precision.

    Equal vectors are one class. Classes are sorted by their grid cells on the leading
    principal axes, cells as wide as the distance of the threshold. The sequence is cut
    into intervals; pairs of intervals are followed recursively from large to small where
    their boxes are near enough, first between tasks, then within each, and multiplied
    where neither distance nor nearness is certain. A task holds two intervals and
    reports each vector's links and its component in the tile, never pairs. The axes are
    fitted on at most 8,192 vectors and decide no link.

    Returns one row for each row: vec_id, n_links (other rows linked directly),
    component_id (smallest id reached, itself included) and kept (vec_id = component_id).
    Null, empty and zero vectors and those with a null or non-finite component link with
    nothing, vectors of another length neither. Repeated rows and rows of one id are
    vectors of their own, which link as equal ones do; all that have the smallest id are
    kept. A null id is the smallest only where there is no other. An empty table gives no
    rows; other columns are ignored. Work that no bound saves grows with the square of
    the intervals: evenly spread vectors of many dimensions leave nothing to skip.
    """
    element = df.schema[vector_col].dataType
    kind = "array<float>" if isinstance(element, ArrayType) and isinstance(element.elementType, FloatType) else "array<double>"
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast(kind).alias("vector"))
    has = rows.where(usable(F.col("vector")))
    classes = durable(
        has.groupBy("vector")
        .agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
        .withColumns({"rep": F.monotonically_increasing_id(), "dim": F.size("vector")})
    )
    found = []
    for (dim,) in sorted(classes.select("dim").distinct().collect()):
        found.append(_class_links(classes.where(F.col("dim") == dim), dim, least, interval, fan))
    alone = rows.where(~usable(F.col("vector"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if not found:
        return alone
    links = durable(functools.reduce(DataFrame.unionByName, found))
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = durable(components(links.select(F.col("rep").alias("a"), F.col("root").alias("b"))))
    placed = (
        classes.join(roots, F.col("rep") == F.col("node"), "left")
        .withColumn("root", F.coalesce("root", "rep"))
        .join(counts, "rep", "left")
        .select("vector", "least_id", "root", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    placed = durable(placed)
    lowest = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labelled = placed.join(lowest, "root").select(F.col("vector").alias("of"), "n_links", "component_id")
    kept = F.col("vec_id").eqNullSafe(F.col("component_id"))
    joined = has.join(labelled, F.col("vector") == F.col("of")).select("vec_id", "n_links", "component_id", kept.alias("kept"))
    return joined.unionByName(alone)


@query("""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
    AND len(list_filter(embedding, lambda y: y <> 0)) > 0),
e AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)""")
def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    return near_vectors(table(spark, sf_dir, "embeddings"))

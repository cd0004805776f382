"""Connected components of an edge table, without ever holding it in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import durable


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _stars_only(edges: DataFrame) -> bool:
    """Whether every node has one edge down, or only edges up."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    seen = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not seen.agg(F.max(F.col("down") + F.col("up") > 1)).first()[0]


def hooked(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``: the smallest node at most two edges away.

    Nodes of one root are surely connected; a component that is no star may keep several.
    """
    both = _both_ways(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    near = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("m"))
    far = both.join(near.hint("merge"), F.col("v") == F.col("node")).groupBy("u").agg(F.min("m").alias("m"))
    return far.select(F.col("u").alias("node"), F.least("u", "m").alias("root"))


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; the root is the smallest node it reaches.

    Alternating large-star and small-star steps (Kiveris et al., 2014): neighbours are
    hooked to the smallest node around until every component is a star. The edges never
    grow in number; each step is stored, which cuts the lineage. Loops and repeated edges
    do no harm. Where ``rounds`` are not enough, it raises.
    """
    edges = durable(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    for _ in range(rounds):
        if _stars_only(edges):
            break
        both = _both_ways(edges)
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).hint("merge")
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # The smallest neighbour of a node that lies below it; it takes over the others.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = durable(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    else:
        raise RuntimeError(f"components have not settled in {rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

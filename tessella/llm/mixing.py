"""Mixing sources to target weights by Efraimidis-Spirakis sampling, native throughout."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import durable
from .registry import partitions, query, table

#: Characters that junk is full of; the fewer, the likelier a document is drawn.
SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]+"


def symbol_weight(text: Column) -> Column:
    """Quality weight of a text: 1 without symbols, falling to 0.05 at a quarter of symbols."""
    n = F.length(text)
    symbols = n - F.length(F.translate(text, SYMBOLS, ""))
    return F.coalesce(F.greatest(F.lit(0.05), 1 - 4 * symbols / F.greatest(n, F.lit(1))), F.lit(1.0))


def uniform(*keys: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the keys alone, the same in every rerun."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def running_sum(rows: DataFrame, order: list[str], size: str) -> DataFrame:
    """``rows`` with ``upto``: the sum of ``size`` over all rows up to this one in ``order``.

    Rows are range-partitioned on the whole order, so a hot leading key is spread over
    many tasks; each task sums its range and starts at the sum of the ranges before.
    The dealt rows are stored, so a lost executor can't deal them anew.
    """
    dealt = durable(
        rows.repartitionByRange(partitions(rows), *order).withColumn("part", F.spark_partition_id())
    )
    sums = dict(dealt.groupBy("part").agg(F.sum(size)).collect())
    starts, before = [], 0
    for part in range(max(sums, default=0) + 1):
        starts.append(before)
        before += sums.get(part, 0)
    start = F.get(F.from_json(F.lit(json.dumps(starts)), "array<bigint>"), F.col("part"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return dealt.withColumn("upto", F.sum(size).over(inside) + start).drop("part")


def source_targets(sources: DataFrame, cap: int = 3, weights: int = 3) -> DataFrame:
    """Target and epochs of each source of ``sources(source, source_size)``.

    Sources in code-point order, null last, weigh 1, 2, .. ``weights``, repeating. The
    targets share the sum of all sizes by weight; none passes ``cap`` times its source's
    size. A common level (target per unit of weight) is raised until the capped sources'
    excess is dealt to the others; each step reads two sums, so the sources may be many.
    """
    ranked = running_sum(
        sources.withColumn("one", F.lit(1)).withColumn("last", F.col("source").isNull()),
        ["last", "source"],
        "one",
    )
    ranked = durable(ranked.select("source", "source_size", F.expr(f"(upto - 1) % {weights} + 1").alias("weight")))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        is_capped = F.col("source_size") * cap < F.col("weight") * F.lit(level)
        n, used, free = ranked.agg(
            F.count(F.when(is_capped, 1)),
            F.coalesce(F.sum(F.when(is_capped, F.col("source_size") * cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~is_capped, F.col("weight"))), F.lit(0)),
        ).first()
        if n == capped or not free:
            break
        capped, level = n, (total - used) / free
    target = F.least((F.col("source_size") * cap).cast("double"), F.col("weight") * F.lit(level))
    return ranked.withColumn("target", target).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    )


def mix_to_targets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight: Column | None = None,
    seed: str = "mix",
    keep: list[str] | None = None,
) -> DataFrame:
    """How often the mix takes each row of ``docs``.

    A source's target is met by complete epochs over all its rows, then by rows in order
    of an exponential key, -ln(u) / quality weight: the smallest keys are a weighted
    sample without replacement. Sizes are summed along that order, and a row is taken once
    more if its middle lies within the budget, so a source misses its target by at most
    half of one row. u depends on the id and the seed, so reruns agree.

    Returns doc_id, the ``keep`` columns, copy, size (words; null or empty text: 0), source, source_size,
    target, copies (times the row is taken) and taken (words). A null source is a source,
    ranked last; repeated rows are drawn each on their own, next to each other; an empty
    table gives no rows. Other columns are ignored.
    """
    text = F.col(f"`{text_col}`")
    weight = symbol_weight(text) if weight is None else weight
    # Named apart from whatever the caller keeps.
    extra = [F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(keep or [])]
    rows = durable(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            F.col(f"`{source_col}`").cast("string").alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            (-F.log(uniform(F.col(f"`{id_col}`"), seed=seed)) / weight).alias("draw"),
            F.monotonically_increasing_id().alias("copy"),
            *extra,
        )
    )
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(durable(sources))
    starts = running_sum(targets.withColumn("last", F.col("source").isNull()), ["last", "source"], "source_size")
    starts = durable(starts.withColumn("start", F.col("upto") - F.col("source_size")).drop("upto", "weight", "last"))
    summed = running_sum(
        rows.withColumn("last", F.col("source").isNull()), ["last", "source", "draw", "doc_id", "copy"], "size"
    ).drop("last")
    joined = summed.withColumnRenamed("source", "s").join(starts, F.col("s").eqNullSafe(F.col("source"))).drop("s")
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    chosen = 2 * (F.col("upto") - F.col("start")) - F.col("size") < 2 * budget
    copies = F.col("epochs") + chosen.cast("long")
    return joined.select(
        "doc_id",
        *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep or [])],
        "copy",
        "size",
        "source",
        "source_size",
        "target",
        copies.cast("long").alias("copies"),
        (F.col("size") * copies).cast("long").alias("taken"),
    )


@query(rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
  (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u,
  coalesce(greatest(0.05::DOUBLE, 1 - 4 * (length(text) - length(translate(text, '{SYMBOLS}', '')))::DOUBLE / greatest(length(text), 1)), 1) AS weight
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, sum(source_size) OVER () AS total FROM s),
c AS (SELECT *, row_number() OVER f AS k,
      CAST(total - coalesce(sum(3 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / CAST(sum(w) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
      FROM r WINDOW f AS (ORDER BY 3.0 * source_size / w, source NULLS LAST)),
l AS (SELECT arg_min(level, k) AS level FROM c WHERE 3 * source_size >= w * level),
t AS (SELECT c.source, c.source_size, least(CAST(3 * c.source_size AS DOUBLE), c.w * l.level) AS target FROM c, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs,
      sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(u) / weight, d.doc_id ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (epochs + CASE WHEN 2 * upto - size < 2 * (target - epochs * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
""")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with the words the mix takes of each."""
    mixed = mix_to_targets(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")

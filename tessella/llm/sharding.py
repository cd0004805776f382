"""Sharding by sampled splitters: near-equal bytes per shard, native throughout."""

from __future__ import annotations

import json
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..session import durable
from .registry import query, table

KEY = ["text_crc32", "doc_id", "copy"]


def keyed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Thin rows to shard: id, size, checksum, and a number that tells repeated rows apart.

    Stored, so that the running number and all later passes see the same rows even when
    an executor is lost; the texts are read once.
    """
    text = F.col(f"`{text_col}`")
    return durable(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.monotonically_increasing_id().alias("copy"),
        )
    )


def range_of(bounds: list[tuple], schema: StructType) -> Column:
    """Number of sorted ``bounds`` at or below the row's key: blocks first, then inside one."""
    if not bounds:
        return F.lit(0)
    step = isqrt(len(bounds)) + 1
    named = [dict(zip(KEY, b, strict=True)) for b in bounds]
    fields = ", ".join(f"{c}: {schema[c].dataType.simpleString()}" for c in KEY)
    # One text that Spark folds into a constant: many literals would be slow to plan.
    blocks = F.from_json(
        F.lit(json.dumps([named[i : i + step] for i in range(0, len(named), step)], default=str)),
        f"array<array<struct<{fields}>>>",
    )
    key = F.struct(*KEY)
    block = F.size(F.filter(blocks, lambda b: F.get(b, F.lit(0)) <= key))
    inside = F.size(F.filter(F.get(blocks, block - 1), lambda b: b <= key))
    return F.when(block == 0, 0).otherwise((block - 1) * step + inside)


def _quantiles(sample: list[tuple], parts: int) -> list[tuple]:
    """Keys that cut a sorted sample of (weight, key..) into ``parts`` of equal weight."""
    total, seen, cuts = sum(r[0] for r in sample), 0.0, []  # a key may come twice
    for row in sample:
        if seen >= total * (len(cuts) + 1) / parts and len(cuts) < parts - 1:
            cuts.append(tuple(row[1:]))
            while seen >= total * (len(cuts) + 1) / parts and len(cuts) < parts - 1:
                cuts.append(cuts[-1])  # one heavy row can fill several ranges
        seen += row[0]
    return cuts


def _ordered(keys: set[tuple]) -> list[tuple]:
    """Spark's order of the keys: nulls first."""
    return sorted(keys, key=lambda k: tuple((v is not None, v if v is not None else 0) for v in k))


def splitters(
    rows: DataFrame, total: int, ranges: int = 512, per_range: int = 16, overfull: float = 2.0, rounds: int = 6
) -> tuple[list[tuple], list[tuple[int, int, int]]]:
    """Boundaries of near-equal ranges, and (range, bytes, rows) of each range that has rows.

    A row is sampled with a chance in proportion to its size, so about ``ranges *
    per_range`` keys come to the driver whatever the input's size. Weighted quantiles of
    the sample are the boundaries. Ranges over ``overfull`` times the mean are sampled
    again on their own and split, until none is left that a boundary can split.
    """
    goal = total / ranges
    bounds: list[tuple] = []
    filled = [(0, total, 2)]
    for round_ in range(rounds):
        over = {r: b for r, b, n in filled if b > overfull * goal and n > 1}
        if not over:
            break
        draw = (F.xxhash64(*KEY, F.lit(round_)).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53)))
        rate = per_range / goal
        sample = (
            rows.withColumn("range", range_of(bounds, rows.schema))
            .where(F.col("range").isin(list(over)) & (draw < F.col("size") * F.lit(rate)))
            .select("range", F.greatest(F.col("size").cast("double"), F.lit(1 / rate)).alias("weight"), *KEY)
            .orderBy(*KEY)
            .collect()
        )
        by_range: dict[int, list[tuple]] = {}
        for row in sample:
            by_range.setdefault(row[0], []).append(tuple(row[1:]))
        new = set(bounds)
        for r, part in by_range.items():
            new.update(_quantiles(part, max(2, ceil(over[r] / goal))))
        if len(new) == len(bounds):
            break
        bounds = _ordered(new)
        filled = [
            tuple(r)
            for r in rows.groupBy(range_of(bounds, rows.schema).alias("range"))
            .agg(F.sum("size"), F.count(F.lit(1)))
            .collect()
        ]
    return bounds, sorted(filled)


def shard_by_splitters(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranges: int = 512,
    per_range: int = 16,
) -> DataFrame:
    """Put every row of ``docs`` into one of ``shards`` shards of near-equal bytes.

    Rows are ordered by (checksum of the text, id), so that copies lie side by side and a
    shard holds a mix of all sources. Sampled splitters cut that order into ranges that
    tasks sort on their own; exact byte counts of the ranges then give each row its place
    in the whole, and the shard whose share of the bytes holds the row's middle. Shards
    differ by at most one row's size, whatever was sampled.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, law (``bytes``), shard, slot
    (0.. without gaps in each shard) and grown_shard (null). A null text has no bytes and
    checksum 0; a null id sorts first; repeated rows each get their own slot; an empty
    table gives no rows. Other columns are ignored.
    """
    rows = keyed_rows(docs, id_col, text_col)
    total = rows.agg(F.sum("size")).first()[0] or 0
    bounds, filled = splitters(rows, total, ranges, per_range) if total else ([], [])
    bytes_before, rows_before, b, n = [0] * (len(bounds) + 1), [0] * (len(bounds) + 1), 0, 0
    at = {r: (size, count) for r, size, count in filled}
    for r in range(len(bounds) + 1):
        bytes_before[r], rows_before[r] = b, n
        b, n = b + at.get(r, (0, 0))[0], n + at.get(r, (0, 0))[1]
    inside = Window.partitionBy("range").orderBy(*KEY)
    start = lambda values: F.get(F.from_json(F.lit(json.dumps(values)), "array<bigint>"), F.col("range"))
    placed = durable(
        rows.withColumn("range", range_of(bounds, rows.schema))
        .withColumn("upto", F.sum("size").over(inside) + start(bytes_before))
        .withColumn("number", F.row_number().over(inside) - 1 + start(rows_before))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.expr(f"cast(least({shards} - 1, ((2 * upto - size) * {shards}) div {max(1, 2 * total)}) as int)").alias("shard"),
            "number",
        )
    )
    firsts = dict(placed.groupBy("shard").agg(F.min("number")).collect())
    first = F.get(F.array(*[F.lit(firsts.get(s, 0)).cast("long") for s in range(shards)]), F.col("shard"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("number") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: CRC-32 of a text in SQL: the table from its rule, then one lookup per byte.
CRC_TABLE_SQL = (
    "crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), "
    "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"
)


def crc_sql(text: str, lookup: str = "t") -> str:
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {data}), "
        f"lambda c, b: xor(c >> 8, {lookup}[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295)"
    )


@query(f"""
WITH {CRC_TABLE_SQL},
r AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
             CAST({crc_sql("coalesce(text, '')")} AS BIGINT) AS text_crc32 FROM documents, crc_table),
w AS (SELECT *, sum(size) OVER o AS upto, sum(size) OVER () AS total
      FROM r WINDOW o AS (ORDER BY text_crc32, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, CAST(least(7, ((2 * upto - size) * 8) // (2 * total)) AS INTEGER) AS shard FROM w)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY text_crc32, doc_id NULLS FIRST, upto) - 1 AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM s
""")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes."""
    return shard_by_splitters(table(spark, sf_dir, "documents"), shards=8)

"""Filters and exact duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where every listed column is present."""
    return df.dropna(subset=list(cols))


def fill_missing_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing texts as empty strings; the rows stay."""
    return df.fillna("", subset=list(cols))


def min_length_filter(df: DataFrame, col: str, n: int = 150) -> DataFrame:
    """Rows whose text has at least ``n`` characters; apply after cleaning."""
    return df.where(F.length(col) >= n)


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """The row with the lowest ordinal per key; missing equals missing.

    Spark turns the rank filter into a group limit before the shuffle, so each task
    sends one row per key however many copies it holds. Sorting goes by hash first and
    by the whole key after it: cheap on long texts, and still exact.
    """
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(ordinal)
    return (
        df.withColumn("_copy", F.row_number().over(window)).where("_copy = 1").drop("_copy")
    )


def dedupe_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``(rows_before, rows_after, dropped)`` for a dedupe on ``keys``.

    Copies are counted per key before the shuffle.
    """
    per_key = df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
    ).withColumn("dropped", F.col("rows_before") - F.col("rows_after"))

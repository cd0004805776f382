"""Counts, rates and gap tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(value, n)``, most frequent first; missing values are left out."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
    return counts.agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def value_shares(df: DataFrame, col: str, decimals: int = 1) -> DataFrame:
    """``(value, pct)``: percent of the rows that have a value."""
    present = df.where(F.col(col).isNotNull())
    total = present.agg(F.count("*")).scalar()
    counts = present.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("_n"))
    pct = F.bround(F.col("_n") * 100.0 / total, decimals)
    return counts.orderBy(F.desc("_n"), "value").select("value", pct.alias("pct"))


def _long_means(df: DataFrame, flags: Sequence[str], ids: Sequence[str]) -> DataFrame:
    return df.unpivot(list(ids), list(flags), "flag", "_mean")


def flag_frequency(df: DataFrame, flags: Sequence[str], top: int = 10) -> DataFrame:
    """``(flag, pct)`` of the ``top`` most frequent flags."""
    means = df.agg(*[F.avg(f).alias(f) for f in flags])
    return (
        _long_means(means, flags, [])
        .select("flag", (F.col("_mean") * 100).alias("pct"))
        .orderBy(F.desc("pct"), "flag")
        .limit(top)
    )


def rate_by_group(df: DataFrame, group: str, flags: Sequence[str]) -> DataFrame:
    """``(group, n, flag, pct)``: percent of each group's rows that set each flag."""
    means = df.groupBy(F.col(group).alias("group")).agg(
        F.count("*").alias("n"), *[F.avg(f).alias(f) for f in flags]
    )
    return _long_means(means, flags, ["group", "n"]).select(
        "group", "n", "flag", (F.col("_mean") * 100).alias("pct")
    )


def rate_gap(rates: DataFrame, a: str, b: str) -> DataFrame:
    """``(flag, gap)``: rate in group ``a`` minus rate in group ``b``, in points."""
    pct = {g: F.max(F.when(F.col("group") == g, F.col("pct"))) for g in (a, b)}
    return (
        rates.where(F.col("group").isin(a, b))
        .groupBy("flag")
        .agg((pct[a] - pct[b]).alias("gap"))
    )


def gap_shift(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(flag, old_gap, new_gap, verdict)``: whether the sign of a gap holds."""
    joined = old.select("flag", F.col("gap").alias("old_gap")).join(
        new.select("flag", F.col("gap").alias("new_gap")), "flag"
    )
    same = F.signum("old_gap") == F.signum("new_gap")
    return joined.withColumn("verdict", F.when(same, "holds").otherwise("reversed"))


def class_balance_eligibility(
    df: DataFrame, flags: Sequence[str], min_count: int = 15
) -> DataFrame:
    """``(flag, pos, neg)`` of flags with at least ``min_count`` rows on both sides."""
    sums = df.agg(F.count("*").alias("_n"), *[F.sum(f).alias(f) for f in flags])
    return (
        sums.unpivot("_n", list(flags), "flag", "pos")
        .select("flag", "pos", (F.col("_n") - F.col("pos")).alias("neg"))
        .where((F.col("pos") >= min_count) & (F.col("neg") >= min_count))
    )


def skill_frequencies(df: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """``(keys.., rank, flag, pct, n, n_rows)`` of flags set at least once per key.

    ``pct`` is a whole percent rounded half to even; ranks go by share, then by name.
    """
    sums = df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), *[F.sum(f).alias(f) for f in flags]
    )
    long = sums.unpivot([*keys, "n_rows"], list(flags), "flag", "n").where("n > 0")
    by_share = Window.partitionBy(*keys).orderBy(F.desc("n"), "flag")
    return long.select(
        *keys,
        F.row_number().over(by_share).alias("rank"),
        "flag",
        F.bround(F.col("n") / F.col("n_rows") * 100, 0).cast("int").alias("pct"),
        "n",
        "n_rows",
    )


def band_by_f1(df: DataFrame, strong: float = 0.60, mid: float = 0.30) -> DataFrame:
    """``(flag, f1, band, rank)``: bands by F1, ranked within each band.

    One row per flag comes in, so ranking a band in one task is a small sort.
    """
    band = F.when(F.col("f1") >= strong, "strong").when(F.col("f1") >= mid, "mid")
    window = Window.partitionBy("band").orderBy(F.desc("f1"), "flag")
    return (
        df.select("flag", "f1")
        .withColumn("band", band.otherwise("weak"))
        .withColumn("rank", F.row_number().over(window))
    )

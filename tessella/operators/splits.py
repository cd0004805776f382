"""Seeded stratified splits, folds and class weights.

Rows of a class are ordered by the MD5 of seed and id; splits and folds are ranges of
that order. Only the few cut points are looked up, by way of a histogram of the hash,
so neither a class nor the row payload is shuffled or sorted whole.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame, Window, functions as F

MAX_CLASSES = 10_000
HASH_HEX = 15  # hex digits of the order key, which fit a long
BUCKET_ROWS = 5_000


def class_counts(df: DataFrame, label: str, most: int = MAX_CLASSES) -> dict:
    """Rows per class on the driver; refuses null classes and more than ``most`` of them."""
    rows = df.groupBy(label).agg(F.count("*").alias("n")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{label} has more than {most} classes")
    if any(r[label] is None for r in rows):
        raise ValueError(f"{label} has null classes: drop these rows first")
    return dict(sorted((r[label], r.n) for r in rows))


def index_labels(df: DataFrame, col: str, out: str = "label") -> tuple[DataFrame, list[str]]:
    """Add alphabetical class codes; also return the labels in code order."""
    model = StringIndexer(
        inputCol=col, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="error"
    ).fit(df)
    return model.transform(df), list(model.labels)


def split_quotas(counts: dict, test: float) -> dict:
    """Test rows per class: ceil(test * n) shared out by largest remainder."""
    n = sum(counts.values())
    n_test = math.ceil(test * n)
    exact = {c: n_test * size / n for c, size in counts.items()}
    quotas = {c: math.floor(x) for c, x in exact.items()}
    by_remainder = sorted(counts, key=lambda c: (quotas[c] - exact[c], c))
    for c in by_remainder[: n_test - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


def _order_key(id_col: str, seed: int) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    number = F.conv(F.substring(digest, 1, HASH_HEX), 16, 10).cast("bigint")
    return F.struct(number.alias("h"), F.col(id_col).alias("id"))


def _cuts(
    df: DataFrame, label: str, id_col: str, seed: int, positions: dict[object, Sequence[int]], n: int
) -> DataFrame:
    """``(label, zeros, cuts)``: the order keys at the given 1-based positions per class.

    ``zeros`` counts the positions that lie before the first row. What reaches the driver
    are classes x cuts rows, and `class_counts` has bounded the classes. ``n``, the number
    of rows, sets how fine the histogram is, so a bucket holds about as many rows at any size.
    """
    spark = df.sparkSession
    key = _order_key(id_col, seed)
    bits = min(4 * HASH_HEX - 1, max(1, (n // BUCKET_ROWS).bit_length()))
    bucket = F.shiftright(F.col("key.h"), 4 * HASH_HEX - bits)
    keyed = df.select(label, key.alias("key")).withColumn("bucket", bucket)
    kinds = {f.name: f.dataType.simpleString() for f in keyed.schema}

    def small(rows, schema):
        return F.broadcast(spark.createDataFrame(rows, f"`{label}` {kinds[label]}, {schema}"))

    targets = small(
        [(c, int(p)) for c, ps in positions.items() for p in sorted(set(ps)) if p > 0],
        "position bigint",
    )
    upto = F.sum("n").over(Window.partitionBy(label).orderBy("bucket"))
    histogram = keyed.groupBy(label, "bucket").agg(F.count("*").alias("n"))
    below = F.col("upto") - F.col("n")
    located = (
        histogram.withColumn("upto", upto)
        .join(targets, label)
        .where((F.col("position") <= F.col("upto")) & (F.col("position") > below))
        .select(label, "bucket", (F.col("position") - below).alias("nth"), "position")
        .collect()
    )
    in_bucket = Window.partitionBy(label, "bucket").orderBy("key")
    buckets = small(sorted({(r[label], r.bucket) for r in located}), "bucket bigint")
    wanted = small([tuple(r) for r in located], "bucket bigint, nth bigint, position bigint")
    found = {
        (r[label], r.position): r.key
        for r in keyed.join(buckets, [label, "bucket"])
        .withColumn("nth", F.row_number().over(in_bucket))
        .join(wanted, [label, "bucket", "nth"])
        .select(label, "position", "key")
        .collect()
    }
    rows = [
        (c, sum(p <= 0 for p in ps), [found[c, p] for p in ps if p > 0])
        for c, ps in positions.items()
    ]
    return small(rows, f"zeros int, cuts array<{kinds['key']}>")


def _ranges(df: DataFrame, label: str, id_col: str, seed: int, positions: dict, n: int) -> DataFrame:
    """Add ``_range``: how many of the class's cut points lie before the row."""
    key = _order_key(id_col, seed)
    passed = F.size(F.filter("cuts", lambda c: key > c))
    return (
        df.join(_cuts(df, label, id_col, seed, positions, n), label)
        .withColumn("_range", (F.col("zeros") + passed).cast("int"))
        .select(*df.columns, "_range")
    )


def stratified_split(
    df: DataFrame, label: str, id_col: str, test: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: exactly the quota of every class, chosen by seeded hash order."""
    counts = class_counts(df, label)
    cuts = {c: [q] for c, q in split_quotas(counts, test).items()}
    ranged = _ranges(df, label, id_col, seed, cuts, sum(counts.values()))
    return ranged.withColumn("is_test", F.col("_range") == 0).drop("_range")


def stratified_folds(
    df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42
) -> DataFrame:
    """Add ``fold`` 0..k-1; fold sizes within a class differ by at most one."""
    counts = class_counts(df, label)
    positions = {c: [j * (n // k) + min(j, n % k) for j in range(1, k)] for c, n in counts.items()}
    ranged = _ranges(df, label, id_col, seed, positions, sum(counts.values()))
    return ranged.withColumnRenamed("_range", "fold")


def class_weights(counts: dict, label: str) -> Column:
    """The weight n / (classes * n_class) of a row's class."""
    n, k = sum(counts.values()), len(counts)
    pairs = [F.lit(part) for c, size in counts.items() for part in (c, n / (k * size))]
    return F.try_element_at(F.create_map(*pairs), F.col(label))


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Add the balancing weight of each row's class."""
    return df.withColumn(out, class_weights(class_counts(df, label), label))

"""Classification metrics as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import durable


def _ratio(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion_matrix(
    pred: DataFrame, labels: Sequence, y: str = "y", p: str = "p"
) -> DataFrame:
    """``(y, p, n)`` with a row for every pair of labels."""
    kind = pred.schema[y].dataType.simpleString()
    empty = pred.sparkSession.createDataFrame(
        [(a, b, 0) for a in labels for b in labels], f"y {kind}, p {kind}, n bigint"
    )
    counts = pred.groupBy(F.col(y).alias("y"), F.col(p).cast(kind).alias("p")).agg(
        F.count("*").alias("n")
    )
    return counts.unionByName(empty).groupBy("y", "p").agg(F.sum("n").alias("n"))


def confusion_pct(cm: DataFrame) -> DataFrame:
    """``(y, p, n, pct)``: percent of each true class."""
    row = F.sum("n").over(Window.partitionBy("y"))
    return cm.withColumn("pct", F.try_divide(F.col("n") * 100.0, row))


def per_class_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by.., label, precision, recall, f1, support)`` from ``(by.., y, p, n)``.

    A class that is neither true nor predicted anywhere is not listed; an empty
    denominator scores 0.
    """
    zero = F.lit(0).cast("bigint")
    hits = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(
            F.col("y").alias("label"), F.col("n").alias("is"), zero.alias("said"), hits.alias("tp")
        ),
        F.struct(
            F.col("p").alias("label"), zero.alias("is"), F.col("n").alias("said"), zero.alias("tp")
        ),
    )
    sums = (
        counts.select(*by, F.inline(sides))
        .groupBy(*by, "label")
        .agg(F.sum("is").alias("support"), F.sum("said").alias("said"), F.sum("tp").alias("tp"))
        .where("support + said > 0")
    )
    return sums.select(
        *by,
        "label",
        _ratio(F.col("tp"), F.col("said")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("support") + F.col("said")).alias("f1"),
        "support",
    )


def classification_report(cm: DataFrame) -> DataFrame:
    """``(label, precision, recall, f1, support)`` per class plus both averages."""
    scores = per_class_scores(cm).withColumn("label", F.col("label").cast("string"))
    cols = ["precision", "recall", "f1"]
    macro = scores.agg(*[F.avg(c).alias(c) for c in cols], F.sum("support").alias("support"))
    weighted = scores.agg(
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in cols],
        F.sum("support").alias("support"),
    )
    return (
        scores.unionByName(macro.withColumn("label", F.lit("macro avg")))
        .unionByName(weighted.withColumn("label", F.lit("weighted avg")))
        .select("label", *cols, "support")
    )


def accuracy_macro_weighted(cm: DataFrame) -> DataFrame:
    """One row ``(accuracy, macro_f1, weighted_f1)``.

    Accuracy is the support-weighted recall.
    """
    return per_class_scores(cm).agg(
        _ratio(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        _ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
    )


def binary_metrics(pred: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "p") -> DataFrame:
    """``(by.., n_positive, n_negative, f1, precision, recall, accuracy)`` for label 1."""
    tp = F.count_if((F.col(y) == 1) & (F.col(p) == 1))
    pos, said = F.count_if(F.col(y) == 1), F.count_if(F.col(p) == 1)
    return pred.groupBy(*by).agg(
        pos.alias("n_positive"),
        F.count_if(F.col(y) == 0).alias("n_negative"),
        _ratio(2 * tp, pos + said).alias("f1"),
        _ratio(tp, said).alias("precision"),
        _ratio(tp, pos).alias("recall"),
        _ratio(F.count_if(F.col(y) == F.col(p)), F.count("*")).alias("accuracy"),
    )


def majority_baseline(pred: DataFrame, by: Sequence[str] = (), y: str = "y") -> DataFrame:
    """``(by.., baseline)``: accuracy of always answering the larger class."""
    share = F.avg(F.col(y).cast("double"))
    return pred.groupBy(*by).agg(F.greatest(share, 1 - share).alias("baseline"))


def roc_auc_ovr(scores: DataFrame) -> DataFrame:
    """``(label, auc, support)`` per class plus rows ``macro`` and ``weighted``.

    Takes ``(label, score, positive)``, one row per text and class. Exact, ties counted
    half. Equal scores are merged first; the merged rows are range-partitioned by class and
    score into as many ranges as the session shuffles to, and each range's running count of
    negatives starts at the sum of the ranges below. A class without positives or negatives has
    no value, and then neither have the means.
    """
    merged = scores.groupBy("label", "score").agg(
        F.sum(F.col("positive").cast("bigint")).alias("pos"),
        F.sum(1 - F.col("positive").cast("bigint")).alias("neg"),
    )
    parts = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = durable(
        merged.repartitionByRange(parts, "label", "score").withColumn("range", F.spark_partition_id())
    )
    before = Window.partitionBy("label").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("label", "range")
        .agg(F.sum("neg").alias("_neg"))
        .select("label", "range", F.coalesce(F.sum("_neg").over(before), F.lit(0)).alias("below"))
    )
    inside = (
        Window.partitionBy("label", "range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    )
    # Classes and ranges at most: stored, so that Spark knows how few they are.
    placed = dealt.withColumn("_in", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(
        durable(offsets), ["label", "range"]
    )
    wins = F.sum(F.col("pos") * (F.col("below") + F.col("_in") + F.col("neg") / 2))
    per_class = placed.groupBy("label").agg(
        F.try_divide(wins, F.sum("pos") * F.sum("neg")).alias("auc"), F.sum("pos").alias("support")
    ).withColumn("label", F.col("label").cast("string"))
    complete = F.count("auc") == F.count("*")
    means = per_class.agg(
        F.when(complete, F.avg("auc")).alias("macro"),
        F.when(
            complete, F.try_divide(F.sum(F.col("auc") * F.col("support")), F.sum("support"))
        ).alias("weighted"),
        F.sum("support").alias("support"),
    )
    return per_class.unionByName(
        means.unpivot("support", ["macro", "weighted"], "label", "auc")
    ).select("label", "auc", "support")


def cv_summary(cv: DataFrame) -> DataFrame:
    """``(candidate, position, mean, std, folds)``; population deviation, folds in order."""
    return cv.groupBy("candidate", "position").agg(
        F.avg("macro_f1").alias("mean"),
        F.stddev_pop("macro_f1").alias("std"),
        F.transform(
            F.sort_array(F.collect_list(F.struct("fold", "macro_f1"))), lambda s: s["macro_f1"]
        ).alias("folds"),
    )


def select_best(cv: DataFrame) -> DataFrame:
    """The candidate with the highest mean; a tie goes to the one listed first."""
    summary = cv_summary(cv).select("candidate", "position", "mean")
    return summary.orderBy(F.desc("mean"), "position").limit(1).select("candidate", "mean")


def model_comparison(cv: DataFrame, test: DataFrame) -> DataFrame:
    """``(candidate, position, mean, std)`` beside the test metrics known per candidate."""
    summary = cv_summary(cv).drop("folds")
    return summary.join(test, "candidate", "left").orderBy("position")

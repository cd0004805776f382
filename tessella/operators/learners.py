"""Learners, cross-validation and ranked classification on ML vectors."""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import NamedTuple, Protocol

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from .evaluation import per_class_scores
from .linear import LOGISTIC, SOFTMAX, SQUARED_HINGE, Fit, LinearModel, balanced, solve, store_rows
from .splits import class_counts, class_weights


class Classifier(Protocol):
    """Anything that adds ``prediction`` and a score vector per row."""

    def transform(self, df: DataFrame) -> DataFrame: ...


def in_threads(spark, task: Callable, items: Sequence, threads: int) -> list:
    """Submit independent Spark jobs side by side; Spark schedules their tasks."""
    with ThreadPool(min(threads, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(task), items)


def fit_naive_bayes(df: DataFrame, features: str = "features", label: str = "label") -> Model:
    """Multinomial naive Bayes; the features must not be negative."""
    return NaiveBayes(
        modelType="multinomial", smoothing=1.0, featuresCol=features, labelCol=label
    ).fit(df)


def _counts_without(df: DataFrame, label: str, folds: Sequence[int | None]) -> dict[int | None, dict[int, int]]:
    """Rows per class that are not in each fold."""
    by = [label] if list(folds) == [None] else [label, "fold"]
    class_counts(df, label)  # refuses null and too many classes
    rows = df.groupBy(*by).agg(F.count("*").alias("n")).collect()
    found = {fold: defaultdict(int) for fold in folds}
    for r in rows:
        for fold in folds:
            found[fold][int(r[label])] += r.n if fold is None or r.fold != fold else 0
    return {fold: dict(sorted(counts.items())) for fold, counts in found.items()}


def fit_logreg_folds(
    df: DataFrame,
    folds: Sequence[int | None],
    features: str = "features",
    label: str = "label",
    c: float = 1.0,
    max_iter: int = 2000,
    family: str = "multinomial",
    tol: float = 1e-5,
) -> list[LinearModel]:
    """`fit_logreg` without each of the folds of the ``fold`` column (None: on all rows), in one batch."""
    counts = _counts_without(df, label, folds)
    rows = store_rows(df, features, [label], None if list(folds) == [None] else "fold")
    kind = SOFTMAX if family == "multinomial" else LOGISTIC
    classes = tuple(range(rows.n_codes)) if kind == SOFTMAX else (1,)
    fits = [Fit(0, fold, balanced(counts[fold]), classes) for fold in folds]
    found = solve(rows, kind, fits, c, 0.0, tol, max_iter)
    return [LinearModel(kind, s.weights.T, s.intercepts, features) for s in found]


def fit_logreg(df: DataFrame, **settings) -> LinearModel:
    """Class-balanced logistic regression; ``c`` is the inverse penalty of the summed loss, the intercept is free."""
    return fit_logreg_folds(df, [None], **settings)[0]


def fit_linear_svm_folds(
    df: DataFrame,
    folds: Sequence[int | None],
    features: str = "features",
    label: str = "label",
    c: float = 0.5,
    max_iter: int = 5000,
    tol: float = 1e-5,
) -> list[LinearModel]:
    """`fit_linear_svm` without each of the folds (None: on all rows): all classes and folds in one batch."""
    counts = _counts_without(df, label, folds)
    rows = store_rows(df, features, [label], None if list(folds) == [None] else "fold")
    codes = range(rows.n_codes)
    fits = [
        Fit(0, fold, {k: balanced(counts[fold]).get(code, 1.0) if k == code else 1.0 for k in codes}, (code,))
        for fold in folds
        for code in codes
    ]
    found = solve(rows, SQUARED_HINGE, fits, c, 1.0, tol, max_iter)
    models = []
    for i in range(len(folds)):
        own = found[i * rows.n_codes : (i + 1) * rows.n_codes]
        weights, intercepts = np.stack([s.weights[:, 0] for s in own]), np.array([s.intercepts[0] for s in own])
        models.append(LinearModel(SQUARED_HINGE, weights, intercepts, features))
    return models


def fit_linear_svm(df: DataFrame, **settings) -> LinearModel:
    """Class-balanced one-vs-rest linear SVM on squared hinge loss, with a penalised intercept.

    In each binary problem the class has its balancing weight and the rest weighs 1.
    """
    return fit_linear_svm_folds(df, [None], **settings)[0]


def fit_random_forest(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    trees: int = 200,
    depth: int = 30,
    seed: int = 42,
) -> Model:
    """Random forest with fixed class weights; 30 is the deepest tree Spark grows.

    Each row's node in every tree is kept between passes instead of being walked to again from
    the root, which grows the same trees.
    """
    weighted = df.withColumn("weight", class_weights(class_counts(df, label), label))
    return RandomForestClassifier(
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        featuresCol=features,
        labelCol=label,
        weightCol="weight",
        cacheNodeIds=True,
    ).fit(weighted)


class Candidate(NamedTuple):
    """A named way to fit a model on a table; tables are fitted in the order listed.

    ``fit_folds(df, folds)`` fits without each fold at once, where the learner can.
    """

    name: str
    fit: Callable[[DataFrame], Classifier]
    fit_folds: Callable[[DataFrame, Sequence[int]], Sequence[Classifier]] | None = None


def cross_validate(
    df: DataFrame,
    candidates: Sequence[Candidate],
    k: int,
    label: str = "label",
    threads: int = 4,
) -> DataFrame:
    """``(candidate, position, fold, macro_f1)`` over the ``fold`` column.

    Each fit is a distributed job over the stored features, or one for all folds of a
    learner with ``fit_folds``; the held-out counts of all fits are scored together.
    """
    batched = {i: c.fit_folds(df, range(k)) for i, c in enumerate(candidates) if c.fit_folds}

    def held_out_counts(run: tuple[int, int]) -> DataFrame:
        position, fold = run
        candidate = candidates[position]
        model = batched[position][fold] if position in batched else candidate.fit(df.where(F.col("fold") != fold))
        pred = model.transform(df.where(F.col("fold") == fold))
        counts = pred.groupBy(F.col(label).alias("y"), F.col("prediction").alias("p"))
        return counts.agg(F.count("*").alias("n")).select(
            F.lit(candidate.name).alias("candidate"),
            F.lit(position).alias("position"),
            F.lit(fold).alias("fold"),
            "y",
            "p",
            "n",
        )

    runs = [(position, fold) for position in range(len(candidates)) for fold in range(k)]
    counts = in_threads(df.sparkSession, held_out_counts, runs, threads)
    by = ["candidate", "position", "fold"]
    scores = per_class_scores(functools.reduce(DataFrame.unionByName, counts), by)
    return scores.groupBy(*by).agg(F.avg("f1").alias("macro_f1"))


def fit_final_and_score(
    candidate: Candidate, train: DataFrame, test: DataFrame
) -> tuple[Classifier, DataFrame]:
    """Refit on all training rows and predict the test rows."""
    model = candidate.fit(train)
    return model, model.transform(test)


def score_column(pred: DataFrame) -> str:
    """The column ranking classes: probabilities where a model has them."""
    return "probability" if "probability" in pred.columns else "rawPrediction"


def classify_ranked(
    model: Classifier, df: DataFrame, id_col: str, labels: Sequence[str]
) -> DataFrame:
    """``(id, rank, label, score)``: all classes per text by decision score.

    Equal scores keep class order. Ranking happens within the row.
    """
    pred = model.transform(df)
    names = F.array(*[F.lit(name) for name in labels])
    scored = F.transform(
        vector_to_array(score_column(pred)),
        lambda s, i: F.struct(s.alias("score"), (-i).alias("order"), F.get(names, i).alias("label")),
    )
    ranked = pred.select(id_col, F.sort_array(scored, asc=False).alias("_ranked"))
    return ranked.select(id_col, F.posexplode("_ranked").alias("_pos", "_r")).select(
        id_col,
        (F.col("_pos") + 1).alias("rank"),
        F.col("_r.label").alias("label"),
        F.col("_r.score").alias("score"),
    )

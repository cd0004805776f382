"""Queries: classification metrics on rule predictions over the labelled texts."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, functions as F

from .. import operators as op
from ..operators.evaluation import per_class_scores
from .base import query, table, texts

_JOINED = "documents d JOIN labels l ON d.doc_id = l.doc_id"
# Languages stand in for classes: the true class is `lang`, the guess a routing rule.
_GUESS = """CASE WHEN contains(lower(text), ' der ') OR contains(lower(text), ' und ') THEN 'de'
  WHEN contains(lower(text), ' les ') OR contains(lower(text), ' et ') THEN 'fr'
  WHEN contains(lower(text), ' el ') OR contains(lower(text), ' los ') THEN 'es' ELSE 'en' END"""
_LANGS = ["de", "en", "es", "fr"]
_CELLS = f"""
pred AS (SELECT doc_id, lang AS y, {_GUESS} AS p FROM documents),
labels4 AS (SELECT unnest(['de', 'en', 'es', 'fr']) AS label),
cm AS (
  SELECT a.label AS y, b.label AS p, count(pred.doc_id) AS n
  FROM labels4 a CROSS JOIN labels4 b LEFT JOIN pred ON pred.y = a.label AND pred.p = b.label
  GROUP BY a.label, b.label)
"""
_SCORES = f"""
{_CELLS},
sides AS (
  SELECT label, (SELECT sum(n) FROM cm WHERE y = label AND p = label) AS tp,
    (SELECT sum(n) FROM cm WHERE y = label) AS support, (SELECT sum(n) FROM cm WHERE p = label) AS said
  FROM labels4),
scores AS (
  SELECT label, coalesce(tp::DOUBLE / nullif(said, 0), 0) AS precision,
    coalesce(tp::DOUBLE / nullif(support, 0), 0) AS recall,
    coalesce(2 * tp::DOUBLE / nullif(support + said, 0), 0) AS f1, support
  FROM sides WHERE support + said > 0)
"""


def _guesses(spark, sf_dir):
    lowered = F.lower("text")

    def has(*words):
        return functools.reduce(lambda a, b: a | b, [lowered.contains(f" {w} ") for w in words])

    guess = (
        F.when(has("der", "und"), "de")
        .when(has("les", "et"), "fr")
        .when(has("el", "los"), "es")
        .otherwise("en")
    )
    return texts(spark, sf_dir).select("doc_id", F.col("lang").alias("y"), guess.alias("p"))


def _cm(spark, sf_dir):
    return op.confusion_matrix(_guesses(spark, sf_dir), _LANGS)


@query(f"WITH {_CELLS} SELECT y, p, n FROM cm")
def confusion_matrix(spark, sf_dir):
    return _cm(spark, sf_dir)


@query(f"""
WITH {_CELLS}
SELECT y, p, n, round(n * 100.0::DOUBLE / nullif(sum(n) OVER (PARTITION BY y), 0), 6) AS pct FROM cm""")
def confusion_pct(spark, sf_dir):
    return op.confusion_pct(_cm(spark, sf_dir)).withColumn("pct", F.round("pct", 6))


@query(f"""
WITH {_SCORES},
report AS (
  SELECT label, precision, recall, f1, support FROM scores
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scores
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
    sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM scores)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM report""")
def classification_report(spark, sf_dir):
    report = op.classification_report(_cm(spark, sf_dir))
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(f"""
WITH {_SCORES}
SELECT round((SELECT count(*) FILTER (y = p) / count(*) FROM pred), 6) AS accuracy,
  round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1
FROM scores""")
def accuracy_macro_weighted(spark, sf_dir):
    scores = op.accuracy_macro_weighted(_cm(spark, sf_dir))
    return scores.select(*[F.round(c, 6).alias(c) for c in scores.columns])


# How much of a text the class's commonest word takes up, as a score per class.
_WORDS = {"de": "er ", "en": "th", "es": "os", "fr": "le"}


def _class_scores(spark, sf_dir) -> DataFrame:
    rows = [
        F.struct(
            F.lit(lang).alias("label"),
            ((F.length("text") - F.length(F.replace(F.col("text"), F.lit(w), F.lit(""))))
             / (F.length("text") + 1)).alias("score"),
            (F.col("lang") == lang).cast("int").alias("positive"),
        )
        for lang, w in _WORDS.items()
    ]
    return texts(spark, sf_dir).select(F.inline(F.array(*rows)))


_AUC_ROWS = " UNION ALL ".join(
    f"SELECT '{lang}' AS label, (length(text) - length(replace(text, '{w}', '')))::DOUBLE "
    f"/ (length(text) + 1) AS score, lang = '{lang}' AS positive FROM documents"
    for lang, w in _WORDS.items()
)


@query(f"""
WITH long AS ({_AUC_ROWS}),
ranked AS (
  SELECT label, positive, rank() OVER (PARTITION BY label ORDER BY score)
    + (count(*) OVER (PARTITION BY label, score) - 1) / 2 AS r FROM long),
sums AS (
  SELECT label, sum(r) FILTER (positive) AS s, count(*) FILTER (positive) AS n1,
    count(*) FILTER (NOT positive) AS n0 FROM ranked GROUP BY label),
aucs AS (SELECT label, (s - n1 * (n1 + 1) / 2) / (n1 * n0) AS auc, n1 AS support FROM sums)
SELECT label, round(auc, 6) AS auc, support FROM aucs
UNION ALL SELECT 'macro', round(avg(auc), 6), CAST(sum(support) AS BIGINT) FROM aucs
UNION ALL SELECT 'weighted', round(sum(auc * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM aucs""")
def roc_auc_ovr(spark, sf_dir):
    return op.roc_auc_ovr(_class_scores(spark, sf_dir)).withColumn("auc", F.round("auc", 6))


# Three rules guessing the quality label, scored over five groups of texts as folds.
_RULES = {"long": "n_chars >= 800", "worded": "contains(lower(text), 'the')", "always": "true"}
_CV = f"""
pred AS ({' UNION ALL '.join(
    f"SELECT '{name}' AS candidate, {i} AS position, CAST(d.doc_id % 5 AS INTEGER) AS fold, "
    f"quality AS y, CAST(({rule}) AS INTEGER) AS p FROM {_JOINED}"
    for i, (name, rule) in enumerate(_RULES.items()))}),
sides AS (
  SELECT candidate, position, fold, label, count(*) FILTER (y = label AND p = label) AS tp,
    count(*) FILTER (y = label) + count(*) FILTER (p = label) AS total
  FROM pred, (SELECT unnest([0, 1]) AS label) GROUP BY ALL),
cv AS (
  SELECT candidate, position, fold, avg(2 * tp::DOUBLE / total) AS macro_f1
  FROM sides WHERE total > 0 GROUP BY candidate, position, fold),
summary AS (
  SELECT candidate, position, avg(macro_f1) AS mean, stddev_pop(macro_f1) AS std,
    list(round(macro_f1, 6) ORDER BY fold) AS folds FROM cv GROUP BY candidate, position)
"""


def _quality_guesses(spark, sf_dir):
    labelled = texts(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    rules = {
        "long": F.col("n_chars") >= 800,
        "worded": F.lower("text").contains("the"),
        "always": F.lit(True),
    }
    rows = [
        F.struct(F.lit(name).alias("candidate"), F.lit(i).alias("position"), rule.cast("int").alias("p"))
        for i, (name, rule) in enumerate(rules.items())
    ]
    return labelled.select(
        F.pmod("doc_id", F.lit(5)).cast("int").alias("fold"),
        F.col("quality").alias("y"),
        F.inline(F.array(*rows)),
    )


def _cv(spark, sf_dir):
    by = ["candidate", "position", "fold"]
    counts = _quality_guesses(spark, sf_dir).groupBy(*by, "y", "p").agg(F.count("*").alias("n"))
    return per_class_scores(counts, by).groupBy(*by).agg(F.avg("f1").alias("macro_f1"))


@query(f"""
WITH {_CV}
SELECT candidate, position, round(mean, 6) AS mean, round(std, 6) AS std,
  array_to_string(list_transform(folds, lambda f: printf('%.6f', f)), ' ') AS folds FROM summary""")
def cv_summary(spark, sf_dir):
    summary = op.cv_summary(_cv(spark, sf_dir))
    shown = F.transform("folds", lambda f: F.format_string("%.6f", f))
    return summary.withColumns(
        {"mean": F.round("mean", 6), "std": F.round("std", 6), "folds": F.array_join(shown, " ")}
    )


@query(f"""
WITH {_CV} SELECT candidate, round(mean, 6) AS mean FROM summary ORDER BY summary.mean DESC, position LIMIT 1""")
def select_best(spark, sf_dir):
    return op.select_best(_cv(spark, sf_dir)).withColumn("mean", F.round("mean", 6))


@query(f"""
WITH {_CV},
test AS (SELECT candidate, avg(CAST(y = p AS INTEGER)) AS accuracy FROM pred GROUP BY candidate)
SELECT s.candidate, s.position, round(mean, 6) AS mean, round(std, 6) AS std, round(accuracy, 6) AS accuracy
FROM summary s LEFT JOIN test t ON s.candidate = t.candidate""")
def model_comparison(spark, sf_dir):
    hit = (F.col("y") == F.col("p")).cast("int")
    test = _quality_guesses(spark, sf_dir).groupBy("candidate").agg(F.avg(hit).alias("accuracy"))
    compared = op.model_comparison(_cv(spark, sf_dir), test)
    return compared.withColumns({c: F.round(c, 6) for c in ("mean", "std", "accuracy")})

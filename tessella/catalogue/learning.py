"""Queries: learners, cross-validation and interpretation, with language as the class.

All run with the published settings. SQL can follow naive Bayes exactly, so each composite
is checked with it; the composite with the published learners stands beside it under the
suffix ``_published``. The coefficients of logistic regression and of the SVM are checked by the
moments that only their optimum meets.
"""

from __future__ import annotations

import functools

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from .. import operators as op
from ..operators.learners import Candidate
from ..operators.splits import class_weights
from ..plans import (
    Settings,
    analyse_postings,
    build_features,
    echo_robustness,
    engineered_only,
    engineered_only_cv,
    feature_ablation,
    published_candidates,
    skill_cv,
    skill_loo,
    skill_prediction,
    train_and_evaluate,
    train_role_model,
)
from .base import (
    AREA_CODE,
    ECHOES,
    EDGE,
    FLAGS,
    SPACE,
    TAXONOMY,
    TITLE,
    counts_sql,
    flags_sql,
    grams_sql,
    posts,
    query,
    table,
    texts,
    title,
    tokens_sql,
)
from .features import stripped_sql
from .retrieval import retrieved_sql, skills_sql

SETTINGS = Settings(taxonomy=TAXONOMY, years_pattern=AREA_CODE)
NAIVE_BAYES = Candidate("MultinomialNB", functools.partial(op.fit_naive_bayes, features="tfidf"))


def _features(spark, sf_dir):
    return build_features(texts(spark, sf_dir), "doc_id", "text", "lang", SETTINGS)


# All rows train here.
def _unsplit(spark, sf_dir):
    return build_features(
        texts(spark, sf_dir), "doc_id", "text", "lang", SETTINGS, hold_out=False
    )


_WEIGHTED = f"""
{counts_sql('counts', 'documents', 'doc_id, lang')},
stats AS (SELECT term, count(*) AS df, sum(tf) AS tf FROM counts GROUP BY term),
vocab AS (
  SELECT * FROM stats WHERE df >= 5 AND df <= 0.6 * (SELECT count(*) FROM documents)
  ORDER BY tf DESC, term LIMIT {SETTINGS.size}),
raw AS (
  SELECT doc_id, lang, term,
    (1 + ln(c.tf)) * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w
  FROM counts c JOIN vocab USING (term)),
weighted AS (
  SELECT doc_id, lang, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM raw)
"""
_GROUPS = {
    g: ["skill_" + e.name for e in TAXONOMY if e.group == g]
    for g in dict.fromkeys(e.group for e in TAXONOMY)
}
_SCALED = " + ".join(
    f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0)"
    for c in SETTINGS.engineered
)


_ENGINEERED = rf"""
flags AS (SELECT doc_id, text, lower(text) AS l, {flags_sql('lower(text)')} FROM documents),
engineered AS (
  SELECT *, {' + '.join(FLAGS)} AS n_skills_total,
    {', '.join(f"{' + '.join(names)} AS group_{g}_count" for g, names in _GROUPS.items())},
    CAST(regexp_matches(l, 'bachelor|b\.?s{EDGE}|undergraduate degree') AS INTEGER) AS mentions_bachelor,
    CAST(regexp_matches(l, 'master|m\.?s{EDGE}|msc{EDGE}') AS INTEGER) AS mentions_master,
    CAST(regexp_matches(l, 'ph\.?d|doctorate') AS INTEGER) AS mentions_phd,
    coalesce(TRY_CAST(regexp_extract(text, '{AREA_CODE}', 1) AS INTEGER), 0) AS years_experience_required,
    length(text) AS description_length, len(regexp_extract_all(text, '[^{SPACE}]+')) AS word_count
  FROM flags)
"""


@query(rf"""
WITH {_WEIGHTED},{_ENGINEERED},
scaled AS (SELECT doc_id, {_SCALED} AS s FROM engineered),
text_sums AS (SELECT doc_id, sum(w) AS s, sum(w * w) AS sq FROM weighted GROUP BY doc_id)
SELECT doc_id, CAST((SELECT count(*) FROM vocab) + {len(SETTINGS.engineered)} AS INTEGER) AS width,
  round(coalesce(t.s, 0) + scaled.s, 6) AS total, round(coalesce(t.sq, 0), 6) AS text_norm
FROM scaled LEFT JOIN text_sums t USING (doc_id)""")
def assemble(spark, sf_dir):
    def total(col, f=lambda w: w):
        return F.round(F.aggregate(f"{col}.values", F.lit(0.0), lambda acc, w: acc + f(w)), 6)

    # Places that a sparse vector leaves out are zeros and add nothing.
    rows = _unsplit(spark, sf_dir).table.select(
        F.col("id").alias("doc_id"), F.unwrap_udt("features").alias("features"), F.unwrap_udt("tfidf").alias("tfidf")
    )
    return rows.select(
        "doc_id",
        F.coalesce("features.size", F.size("features.values")).alias("width"),
        total("features").alias("total"),
        total("tfidf", lambda w: w * w).alias("text_norm"),
    )


_NB_SCORES = f"""
{_WEIGHTED},
mass AS (SELECT lang, term, sum(w) AS m FROM weighted GROUP BY lang, term),
totals AS (SELECT lang, sum(m) AS m FROM mass GROUP BY lang),
langs AS (
  SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS label,
    ln(count(*) + 1) - ln((SELECT count(*) + 4 FROM documents)) AS prior
  FROM documents GROUP BY lang),
theta AS (
  SELECT t.lang, v.term, ln((coalesce(m.m, 0) + 1) / (t.m + (SELECT count(*) FROM vocab))) AS th
  FROM totals t CROSS JOIN vocab v LEFT JOIN mass m ON m.lang = t.lang AND m.term = v.term),
likelihood AS (
  SELECT w.doc_id, th.lang, sum(w.w * th.th) AS ll FROM weighted w JOIN theta th USING (term) GROUP BY ALL),
scores AS (
  SELECT d.doc_id, l.lang, l.label, prior + coalesce(ll, 0) AS score
  FROM documents d CROSS JOIN langs l LEFT JOIN likelihood k ON k.doc_id = d.doc_id AND k.lang = l.lang)
"""


@query(f"""
WITH {_NB_SCORES}
SELECT d.doc_id, CAST(langs.label AS DOUBLE) AS label, CAST(arg_max(scores.label, score) AS DOUBLE) AS prediction
FROM documents d JOIN langs USING (lang) JOIN scores ON scores.doc_id = d.doc_id
GROUP BY d.doc_id, langs.label""")
def fit_naive_bayes(spark, sf_dir):
    rows = _unsplit(spark, sf_dir).table
    pred = op.fit_naive_bayes(rows, "tfidf").transform(rows)
    return pred.select(F.col("id").alias("doc_id"), "label", "prediction")


@query(f"""
WITH {_NB_SCORES},
shares AS (
  SELECT doc_id, lang AS label, exp(score) / sum(exp(score)) OVER (PARTITION BY doc_id) AS share
  FROM (SELECT doc_id, lang, score - max(score) OVER (PARTITION BY doc_id) AS score FROM scores))
SELECT doc_id AS id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY share DESC, label) AS INTEGER) AS rank,
  label, round(share, 6) AS score
FROM shares""")
def classify_ranked_naive_bayes(spark, sf_dir):
    features = _unsplit(spark, sf_dir)
    model = op.fit_naive_bayes(features.table, "tfidf")
    ranked = op.classify_ranked(model, features.table, "id", features.labels)
    return ranked.withColumn("score", F.round("score", 6))


@query(f"""
WITH {_WEIGHTED},
folds AS (SELECT unnest(range(5)) AS fold),
mass AS (
  SELECT fold, lang, term, sum(w) AS m FROM weighted JOIN folds ON doc_id % 5 <> fold GROUP BY ALL),
totals AS (SELECT fold, lang, sum(m) AS m FROM mass GROUP BY ALL),
priors AS (
  SELECT fold, lang, ln(count(*) + 1) - ln(sum(count(*)) OVER (PARTITION BY fold) + 4) AS prior
  FROM documents JOIN folds ON doc_id % 5 <> fold GROUP BY fold, lang),
theta AS (
  SELECT t.fold, t.lang, v.term,
    ln((coalesce(m.m, 0) + 1) / (t.m + (SELECT count(*) FROM vocab))) AS th
  FROM totals t CROSS JOIN vocab v
  LEFT JOIN mass m ON m.fold = t.fold AND m.lang = t.lang AND m.term = v.term),
likelihood AS (
  SELECT w.doc_id, th.lang, sum(w.w * th.th) AS ll
  FROM weighted w JOIN theta th ON th.term = w.term AND th.fold = w.doc_id % 5 GROUP BY ALL),
pred AS (
  SELECT d.doc_id, p.fold, any_value(d.lang) AS y, arg_max(p.lang, prior + coalesce(ll, 0)) AS p
  FROM documents d JOIN priors p ON p.fold = d.doc_id % 5
  LEFT JOIN likelihood k ON k.doc_id = d.doc_id AND k.lang = p.lang GROUP BY d.doc_id, p.fold),
sides AS (
  SELECT fold, label, count(*) FILTER (y = label AND p = label) AS tp,
    count(*) FILTER (y = label) + count(*) FILTER (p = label) AS total
  FROM pred, (SELECT DISTINCT lang AS label FROM documents) GROUP BY fold, label)
SELECT 'MultinomialNB' AS candidate, 0 AS position, fold, round(avg(2 * tp::DOUBLE / total), 6) AS macro_f1
FROM sides WHERE total > 0 GROUP BY fold""")
def cross_validate_naive_bayes(spark, sf_dir):
    rows = _unsplit(spark, sf_dir).table.select("id", "label", "tfidf")
    folded = rows.withColumn("fold", F.pmod("id", F.lit(5)).cast("int"))
    cv = op.cross_validate(folded, [NAIVE_BAYES], 5)
    return cv.withColumn("macro_f1", F.round("macro_f1", 6))



def _order(column: str = "doc_id", seed: int = SETTINGS.seed) -> str:
    return f"substr(md5('{seed}:' || {column}), 1, 15), {column}"


def _split_sql(name: str = "split") -> str:
    """``(doc_id, lang, is_test)``: the quota of each class, in the order of the seeded digest."""
    return f"""
{name}_n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
{name}_x AS (
  SELECT lang, n, ceil({SETTINGS.test} * (SELECT count(*) FROM documents)) * n / (SELECT count(*) FROM documents) AS x
  FROM {name}_n),
{name}_q AS (
  SELECT lang, floor(x) + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, lang)
    <= ceil({SETTINGS.test} * (SELECT count(*) FROM documents)) - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS q
  FROM {name}_x),
{name} AS (
  SELECT doc_id, d.lang, row_number() OVER (PARTITION BY d.lang ORDER BY {_order()}) <= q AS is_test
  FROM documents d JOIN {name}_q USING (lang))"""


def _weights_sql(text: str = "text", name: str = "w") -> str:
    """``(doc_id, lang, is_test, term, w)``: weights under the vocabulary of the training rows."""
    return f"""
{counts_sql(f"{name}_counts", "documents", "doc_id, lang", text)},
{name}_stats AS (
  SELECT term, count(*) AS df, sum(tf) AS tf FROM {name}_counts JOIN split USING (doc_id) WHERE NOT is_test GROUP BY term),
{name}_n AS (SELECT count(*) AS n FROM split WHERE NOT is_test),
{name}_vocab AS (
  SELECT * FROM {name}_stats, {name}_n WHERE df >= {SETTINGS.min_df} AND df <= {SETTINGS.max_df} * n
  ORDER BY tf DESC, term LIMIT {SETTINGS.size}),
{name}_raw AS (
  SELECT doc_id, c.lang, is_test, c.term, (1 + ln(c.tf)) * (ln((1 + n) / (1 + df)) + 1) AS w
  FROM {name}_counts c JOIN {name}_vocab USING (term) JOIN split USING (doc_id)),
{name} AS (
  SELECT doc_id, lang, is_test, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM {name}_raw)"""


def _scores_sql(rows: str, weights: str, name: str) -> str:
    """``(run, doc_id, y, lang, label, score)``: naive Bayes fitted on the ``rows(run, doc_id, lang, fitted)``
    that are, and applied to the others."""
    return f"""
{name}_mass AS (
  SELECT run, r.lang, term, sum(w) AS m FROM {rows} r JOIN {weights} USING (doc_id) WHERE fitted GROUP BY ALL),
{name}_totals AS (SELECT run, lang, sum(m) AS m FROM {name}_mass GROUP BY ALL),
{name}_langs AS (
  SELECT run, lang, row_number() OVER (PARTITION BY run ORDER BY lang) - 1 AS label,
    ln(count(*) FILTER (fitted) + 1) - ln(sum(count(*) FILTER (fitted)) OVER (PARTITION BY run) + 4) AS prior
  FROM {rows} GROUP BY run, lang),
{name}_theta AS (
  SELECT t.run, t.lang, v.term, ln((coalesce(m.m, 0) + 1) / (t.m + (SELECT count(*) FROM {weights}_vocab))) AS th
  FROM {name}_totals t CROSS JOIN {weights}_vocab v
  LEFT JOIN {name}_mass m ON m.run = t.run AND m.lang = t.lang AND m.term = v.term),
{name}_likelihood AS (
  SELECT r.run, w.doc_id, th.lang, sum(w.w * th.th) AS ll
  FROM {rows} r JOIN {weights} w USING (doc_id) JOIN {name}_theta th ON th.term = w.term AND th.run = r.run
  WHERE NOT fitted GROUP BY ALL),
{name} AS (
  SELECT r.run, r.doc_id, r.lang AS y, l.lang, l.label, prior + coalesce(ll, 0) AS score
  FROM {rows} r JOIN {name}_langs l ON l.run = r.run
  LEFT JOIN {name}_likelihood k ON k.run = r.run AND k.doc_id = r.doc_id AND k.lang = l.lang
  WHERE NOT fitted)"""


def _folds_sql(name: str = "folds") -> str:
    """``(run, doc_id, lang, fitted)`` of the training rows, for each of the stratified folds."""
    k = SETTINGS.folds
    return f"""
{name}_placed AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_order()}) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM split WHERE NOT is_test),
{name}_of AS (
  SELECT doc_id, lang, CASE WHEN i < (n % {k}) * (n // {k} + 1) THEN i // (n // {k} + 1)
    ELSE n % {k} + (i - (n % {k}) * (n // {k} + 1)) // greatest(n // {k}, 1) END AS fold FROM {name}_placed),
{name} AS (
  SELECT r.run, doc_id, lang, fold <> r.run AS fitted FROM {name}_of, (SELECT unnest(range({k})) AS run) r)"""


def _macro_sql(scores: str, name: str) -> str:
    """``(run, macro_f1)`` of the best label per row."""
    return f"""
{name}_pred AS (SELECT run, doc_id, any_value(y) AS y, arg_max(lang, score) AS p FROM {scores} GROUP BY run, doc_id),
{name}_sides AS (
  SELECT run, label, count(*) FILTER (y = label AND p = label) AS tp,
    count(*) FILTER (y = label) + count(*) FILTER (p = label) AS total
  FROM {name}_pred, (SELECT DISTINCT lang AS label FROM documents) GROUP BY run, label),
{name} AS (SELECT run, avg(2 * tp::DOUBLE / total) AS macro_f1 FROM {name}_sides WHERE total > 0 GROUP BY run)"""


_HELD_OUT = f"""
{_split_sql()},{_weights_sql()},
held AS (SELECT 0 AS run, doc_id, lang, NOT is_test AS fitted FROM split),{_scores_sql("held", "w", "s")}"""
def _said_moments(model, rows, c: float = 1.0):
    """Per class and feature: the class-weighted sum of the feature times the class's fitted probability,
    plus the pull of the penalty; then the same sums for the intercepts.

    At the only optimum of the penalised log loss, and nowhere else, these equal the sums over
    the rows that are of the class.
    """
    counts = op.class_counts(rows, "label")
    weighted = rows.withColumn("weight", class_weights(counts, "label"))
    scored = model.transform(weighted).withColumn("shares", vector_to_array("probability"))
    said = [F.col("weight") * F.get("shares", F.lit(i)) for i in range(len(counts))]
    sums = scored.agg(
        *[F.sum(x).alias(f"n_{i}") for i, x in enumerate(said)],
        *[Summarizer.mean(F.col("features"), x).alias(f"m_{i}") for i, x in enumerate(said)],
    ).first()
    return [(sums[f"m_{i}"].toArray() * sums[f"n_{i}"] + model.weights[i] / c, sums[f"n_{i}"]) for i in range(len(said))]


_SCALED_TRAIN = " UNION ALL ".join(
    f"SELECT lang, '{c}' AS feature, sum(coalesce(({c} - m) / nullif(d, 0), 0)) AS total FROM train_rows, "
    f"(SELECT avg({c}) AS m, stddev_pop({c}) AS d FROM train_rows) GROUP BY lang"
    for c in SETTINGS.engineered
)


def _moments_sql() -> str:
    """``sums(lang, feature, total)`` of every feature over the training rows of a class, and ``balance(lang, weight, n)``."""
    return f"""
{_split_sql()},{_weights_sql()},{_ENGINEERED},
train_rows AS (SELECT s.lang, e.* FROM engineered e JOIN split s USING (doc_id) WHERE NOT is_test),
sizes AS (SELECT lang, count(*) AS n FROM train_rows GROUP BY lang),
balance AS (SELECT lang, (SELECT sum(n) FROM sizes) / ((SELECT count(*) FROM sizes) * n::DOUBLE) AS weight, n FROM sizes),
found AS (SELECT lang, term AS feature, sum(w) AS total FROM w WHERE NOT is_test GROUP BY ALL),
sums AS (
  SELECT b.lang, v.term AS feature, coalesce(f.total, 0) AS total
  FROM balance b CROSS JOIN w_vocab v LEFT JOIN found f ON f.lang = b.lang AND f.feature = v.term
  UNION ALL {_SCALED_TRAIN}
  UNION ALL SELECT lang, '(intercept)', n FROM balance)"""


def _moment_rows(spark, features, moments):
    """``(class, feature, moment)`` of the sums per class and their intercepts."""
    rows = [
        (label, name, round(float(x), 3) + 0.0)
        for label, (sums, total) in zip(features.labels, moments, strict=True)
        for name, x in [*zip(features.names, sums, strict=True), ("(intercept)", total)]
    ]
    return spark.createDataFrame(rows, "class string, feature string, moment double")


@query(f"""
WITH {_moments_sql()}
SELECT lang AS class, feature, round(weight * total, 3) + 0.0 AS moment FROM sums JOIN balance USING (lang)""")
def fit_logreg(spark, sf_dir):
    """The moments of every feature in every class under the fitted probabilities.

    SQL takes them from the rows' own classes; they agree only if every coefficient is at the optimum.
    """
    features = _features(spark, sf_dir)
    model = op.fit_logreg(features.train, tol=1e-10)
    return _moment_rows(spark, features, _said_moments(model, features.train))


def _bounded_moments(model, rows, c: float = 0.5):
    """Per class and feature: the weighted sum of the feature times the margin, which counts as 1 or -1
    where it is beyond that on the row's own side, plus the pull of the penalty; the same for the intercepts.

    At the only optimum of the squared hinge loss, and nowhere else, these equal the weighted
    sums with 1 for the rows of the class and -1 for the others.
    """
    counts = op.class_counts(rows, "label")
    scored = rows.withColumn("balance", class_weights(counts, "label"))
    scored = model.transform(scored).withColumn("margins", vector_to_array("rawPrediction"))
    own = [F.col("label") == k for k in range(len(counts))]
    margin = [F.get("margins", F.lit(k)) for k in range(len(counts))]
    values = [
        F.when(is_own, F.col("balance") * F.least(m, F.lit(1.0))).otherwise(F.greatest(m, F.lit(-1.0)))
        for is_own, m in zip(own, margin, strict=True)
    ]
    # The summarizer takes no negative weights, so both signs are summed apart.
    signed = {f"{sign}_{k}": F.greatest(v * factor, F.lit(0.0)) for sign, factor in (("up", 1), ("down", -1)) for k, v in enumerate(values)}
    sums = scored.agg(
        *[F.sum(x).alias(f"n_{name}") for name, x in signed.items()],
        *[Summarizer.mean(F.col("features"), x).alias(f"m_{name}") for name, x in signed.items()],
    ).first()

    def total(k, part=lambda name: sums[f"n_{name}"]):
        return part(f"up_{k}") - part(f"down_{k}")

    def vectors(name):
        return sums[f"m_{name}"].toArray() * sums[f"n_{name}"]

    return [
        (total(k, vectors) + model.weights[k] / (2 * c), total(k) + model.intercepts[k] / (2 * c))
        for k in range(len(counts))
    ]


@query(f"""
WITH {_moments_sql()}
SELECT a.lang AS class, feature,
  round(sum(CASE WHEN s.lang = a.lang THEN a.weight * total ELSE -total END), 3) + 0.0 AS moment
FROM balance a CROSS JOIN sums s GROUP BY ALL""")
def fit_linear_svm(spark, sf_dir):
    """The moments of every feature in every class under the fitted margins.

    SQL takes them from the rows' own classes; they agree only if every coefficient is at the optimum.
    """
    features = _features(spark, sf_dir)
    model = op.fit_linear_svm(features.train, tol=1e-10)
    return _moment_rows(spark, features, _bounded_moments(model, features.train))


@query()
def fit_random_forest(spark, sf_dir):
    features = _features(spark, sf_dir)
    forest = Candidate("RandomForest", op.fit_random_forest)
    pred = op.fit_final_and_score(forest, features.train, features.test)[1]
    return pred.select(F.col("id").alias("doc_id"), "label", "prediction")


@query(f"""
WITH {_split_sql()},{_weights_sql()},{_folds_sql()},{_scores_sql("folds", "w", "s")},{_macro_sql("s", "f")}
SELECT 'MultinomialNB' AS candidate, 0 AS position, CAST(run AS INTEGER) AS fold, round(macro_f1, 6) AS macro_f1 FROM f""")
def cross_validate(spark, sf_dir):
    features = _features(spark, sf_dir)
    cv = op.cross_validate(features.train_folds(), [NAIVE_BAYES], SETTINGS.folds)
    return cv.withColumn("macro_f1", F.round("macro_f1", 6))


@query()
def cross_validate_published(spark, sf_dir):
    features = _features(spark, sf_dir)
    return op.cross_validate(features.train_folds(), published_candidates(), SETTINGS.folds)


@query(f"""
WITH {_HELD_OUT},
pred AS (SELECT doc_id, any_value(y) AS y, arg_max(lang, score) AS p FROM s GROUP BY doc_id),
cells AS (
  SELECT label, count(*) FILTER (y = label AND p = label) AS tp, count(*) FILTER (p = label) AS said,
    count(*) FILTER (y = label) AS support
  FROM pred, (SELECT DISTINCT lang AS label FROM documents) GROUP BY label),
scored AS (
  SELECT label, coalesce(tp::DOUBLE / nullif(said, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(support, 0), 0) AS recall,
    coalesce(2 * tp::DOUBLE / nullif(support + said, 0), 0) AS f1, support FROM cells WHERE support + said > 0)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM scored
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM scored
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scored""")
def fit_final_and_score(spark, sf_dir):
    features = _features(spark, sf_dir)
    pred = op.fit_final_and_score(NAIVE_BAYES, features.train, features.test)[1]
    names = F.array(*[F.lit(n) for n in features.labels])
    named = pred.select(
        F.get(names, F.col("label").cast("int")).alias("y"), F.get(names, F.col("prediction").cast("int")).alias("p")
    )
    report = op.classification_report(op.confusion_matrix(named, features.labels))
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query()
def fit_final_and_score_published(spark, sf_dir):
    return train_and_evaluate(_features(spark, sf_dir))["report"]


@query(f"""
WITH {_HELD_OUT},
shares AS (
  SELECT doc_id, lang AS label, exp(score) / sum(exp(score)) OVER (PARTITION BY doc_id) AS share
  FROM (SELECT doc_id, lang, score - max(score) OVER (PARTITION BY doc_id) AS score FROM s))
SELECT doc_id AS id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY share DESC, label) AS INTEGER) AS rank,
  label, round(share, 6) AS score FROM shares""")
def classify_ranked(spark, sf_dir):
    features = _features(spark, sf_dir)
    model = NAIVE_BAYES.fit(features.train)
    ranked = op.classify_ranked(model, features.test, "id", features.labels)
    return ranked.withColumn("score", F.round("score", 6))


@query()
def classify_ranked_published(spark, sf_dir):
    features = _features(spark, sf_dir)
    return op.classify_ranked(op.fit_linear_svm(features.train), features.test, "id", features.labels)


@query("""
SELECT * FROM (VALUES ('tfidf_only', true, true), ('combined', true, true)) t(features, in_range, adds_up)""")
def feature_ablation_(spark, sf_dir):
    """Which runs there are, that their means are shares, and that the gains add up."""
    rows = op.durable(feature_ablation(_features(spark, sf_dir), op.fit_logreg))
    base = rows.where("features = 'tfidf_only'").select("mean").scalar()
    return rows.select(
        "features",
        ((F.col("mean") > 0.5) & (F.col("mean") <= 1)).alias("in_range"),
        (F.abs(F.col("mean") - base - F.col("delta")) < 1e-9).alias("adds_up"),
    )


@query()
def feature_ablation_published(spark, sf_dir):
    return feature_ablation(_features(spark, sf_dir))


@query(f"""
SELECT 'LogisticRegression' AS candidate, 0 AS position, CAST(fold AS INTEGER) AS fold, true AS in_range
FROM range({SETTINGS.folds}) r(fold)""")
def engineered_only_cv_(spark, sf_dir):
    cv = engineered_only_cv(texts(spark, sf_dir), "doc_id", "text", "lang", SETTINGS)
    return cv.select("candidate", "position", "fold", F.col("macro_f1").between(0.25, 1).alias("in_range"))


@query()
def engineered_only_cv_published(spark, sf_dir):
    return engineered_only_cv(texts(spark, sf_dir), "doc_id", "text", "lang", SETTINGS)


@query(f"""
WITH {_split_sql()},{_folds_sql()},{_weights_sql()},{_weights_sql(stripped_sql(), "v")},
{_scores_sql("folds", "w", "sw")},{_macro_sql("sw", "fw")},{_scores_sql("folds", "v", "sv")},{_macro_sql("sv", "fv")},
facts AS (
  SELECT count(*) FILTER (text IS DISTINCT FROM {stripped_sql()}) AS n_changed, count(*) AS n_rows FROM documents)
SELECT 'original' AS text, round(avg(macro_f1), 6) AS mean, round(stddev_pop(macro_f1), 6) AS std,
  any_value(n_changed) AS n_changed, any_value(n_rows) AS n_rows FROM fw, facts
UNION ALL SELECT 'stripped', round(avg(macro_f1), 6), round(stddev_pop(macro_f1), 6),
  any_value(n_changed), any_value(n_rows) FROM fv, facts""")
def echo_robustness_(spark, sf_dir):
    rows = echo_robustness(texts(spark, sf_dir), "doc_id", "text", "lang", ECHOES, SETTINGS, NAIVE_BAYES.fit)
    return rows.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query()
def echo_robustness_published(spark, sf_dir):
    return echo_robustness(texts(spark, sf_dir), "doc_id", "text", "lang", ECHOES, SETTINGS)


_RATES = f"""
WITH flagged AS (SELECT lang, {flags_sql('lower(text)')} FROM documents),
rates AS ({' UNION ALL '.join(f"SELECT lang, '{f}' AS feature, avg({f}) AS weight FROM flagged GROUP BY lang" for f in FLAGS)})
SELECT lang AS class, rank, feature, round(weight, 6) AS weight FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY weight DESC, feature) AS INTEGER) AS rank FROM rates)
WHERE rank <= {{n}}"""


def _top_rates(spark, sf_dir, n: int):
    """The operator on a matrix that SQL knows as well: the share of each class with each flag."""
    flagged = op.tag_flags(texts(spark, sf_dir), ["text"], TAXONOMY)
    rates = flagged.groupBy("lang").agg(*[F.avg(f).alias(f) for f in FLAGS]).orderBy("lang").collect()
    weights = [[r[f] for f in FLAGS] for r in rates]
    top = op.top_weights(spark, weights, [r.lang for r in rates], FLAGS, n)
    return top.withColumn("weight", F.round("weight", 6))


@query(f"""
WITH {_NB_SCORES},
ranked AS (SELECT lang, term, round(th, 9) AS th, row_number() OVER (PARTITION BY lang ORDER BY round(th, 9) DESC, term) AS rank FROM theta)
SELECT lang AS class, CAST(rank AS INTEGER) AS rank, term AS feature, round(th, 6) AS weight FROM ranked WHERE rank <= 15""")
def top_terms_per_class(spark, sf_dir):
    """The largest coefficients of a fitted naive Bayes model; equal ones to nine decimals by name."""
    features = _unsplit(spark, sf_dir)
    weights = op.fit_naive_bayes(features.table, "tfidf").theta.toArray().round(9)
    top = op.top_weights(spark, weights, features.labels, features.names[: weights.shape[1]])
    return top.withColumn("weight", F.round("weight", 6))


@query()
def top_terms_per_class_published(spark, sf_dir):
    features = _features(spark, sf_dir)
    return op.top_terms_per_class(spark, op.fit_logreg(features.train), features.labels, features.names)


@query(_RATES.replace("{n}", "10"))
def top_signals_per_class(spark, sf_dir):
    return _top_rates(spark, sf_dir, 10)


@query()
def top_signals_per_class_published(spark, sf_dir):
    return engineered_only(texts(spark, sf_dir), "doc_id", "text", "lang", SETTINGS)["top_signals"]


def _analysed(spark, sf_dir, **learner):
    """All four tables of the analysis in one shape."""
    # Index and model take the same words, so these are made once.
    docs = op.durable(op.tokenize(posts(spark, sf_dir), "description", SETTINGS.stop_words))
    index = op.build_index(docs, "doc_id", "role_category", "description", stop_words=SETTINGS.stop_words, tokens="tokens")
    model = train_role_model(docs, "doc_id", "description", "role_category", SETTINGS, tokens="tokens", **learner)
    pasted = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    tables = analyse_postings(index, model, docs, "doc_id", pasted, taxonomy=TAXONOMY)

    def section(name, item, value):
        return tables[name].select(
            "query_id", F.lit(name).alias("section"), F.col("rank").cast("int").alias("rank"), item.alias("item"),
            F.round(value.cast("double"), 6).alias("value"),
        )

    rows = [
        section("classified", F.col("label"), F.col("score")),
        section("retrieved", F.col("doc").cast("string"), F.col("similarity")),
        section("skills", F.col("flag"), F.col("pct")),
        section("gap", F.concat_ws(" ", "status", "flag"), F.col("pct")),
    ]
    return functools.reduce(lambda a, b: a.unionByName(b), rows)


_ALL_FITTED = f"""
w AS (SELECT * FROM weighted), w_vocab AS (SELECT * FROM vocab),
item_counts_tok AS (SELECT item_id, {tokens_sql('text')} AS tok FROM benchmark),
item_counts_all AS (SELECT item_id, unnest({grams_sql('tok')}) AS term FROM item_counts_tok),
item_counts AS (SELECT item_id, term, count(*) AS tf FROM item_counts_all GROUP BY ALL),
item_raw AS (
  SELECT item_id, term, (1 + ln(c.tf)) * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w
  FROM item_counts c JOIN vocab USING (term)),
item_w AS (SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS w FROM item_raw),
item_ll AS (SELECT item_id, lang, sum(w.w * th.th) AS ll FROM item_w w JOIN theta th USING (term) GROUP BY ALL),
item_scores AS (
  SELECT b.item_id, l.lang, prior + coalesce(ll, 0) AS score FROM benchmark b CROSS JOIN langs l
  LEFT JOIN item_ll k ON k.item_id = b.item_id AND k.lang = l.lang),
item_shares AS (
  SELECT item_id, lang, exp(score) / sum(exp(score)) OVER (PARTITION BY item_id) AS share
  FROM (SELECT item_id, lang, score - max(score) OVER (PARTITION BY item_id) AS score FROM item_scores)),
classified AS (
  SELECT item_id AS query_id, lang AS label, share,
    CAST(row_number() OVER (PARTITION BY item_id ORDER BY share DESC, lang) AS INTEGER) AS rank FROM item_shares)
"""


@query(f"""
WITH {_NB_SCORES}, {_ALL_FITTED},
asked AS (SELECT query_id, label AS lang, text FROM classified JOIN benchmark ON item_id = query_id WHERE rank = 1),
{retrieved_sql(25, 'g')}, {skills_sql('g')},
own AS (SELECT item_id AS query_id, {flags_sql('lower(text)')} FROM benchmark),
own_long AS ({' UNION ALL '.join(f"SELECT query_id, '{f}' AS flag, {f} AS has FROM own" for f in FLAGS)}),
gaps AS (
  SELECT query_id, CASE WHEN has = 1 THEN 'present' ELSE 'missing' END AS status, rank AS place, flag, pct
  FROM g_freq JOIN own_long USING (query_id, flag) WHERE pct >= 15),
placed AS (
  SELECT query_id, status, CAST(row_number() OVER (PARTITION BY query_id, status ORDER BY place) AS INTEGER) AS rank,
    flag, pct FROM gaps)
SELECT query_id, 'classified' AS section, rank, label AS item, round(share, 6) AS value FROM classified
UNION ALL SELECT query_id, 'retrieved', rank, CAST(doc AS VARCHAR), round(similarity, 6) FROM g_retrieved
UNION ALL SELECT query_id, 'skills', rank, flag, pct::DOUBLE FROM g_freq
UNION ALL SELECT query_id, 'gap', rank, status || ' ' || flag, pct::DOUBLE FROM placed WHERE rank <= 10""")
def analyse_postings_(spark, sf_dir):
    return _analysed(spark, sf_dir, fit=NAIVE_BAYES.fit)


@query()
def analyse_postings_published(spark, sf_dir):
    return _analysed(spark, sf_dir)


def _titled(spark, sf_dir):
    docs = texts(spark, sf_dir).withColumn("job_title", title())
    flagged = op.tag_flags(docs, ["text"], TAXONOMY)
    return op.durable(flagged.select("doc_id", "job_title", "lang", *FLAGS))


def _eligible(titled) -> list[str]:
    found = {r.flag for r in op.class_balance_eligibility(titled, FLAGS).collect()}
    return [f for f in FLAGS if f in found]


_ELIGIBLE = "(SELECT least(sum({f}), count(*) - sum({f})) FROM flagged) >= 15"


@query(f"""
WITH flagged AS (SELECT doc_id, {flags_sql('lower(text)')} FROM documents)
{' UNION ALL '.join(f"SELECT '{f}' AS flag, doc_id AS id, {f} AS y, true AS predicted FROM flagged WHERE {_ELIGIBLE.format(f=f)}" for f in FLAGS)}""")
def skill_cv_(spark, sf_dir):
    """Every eligible flag of every row, and that it has one prediction."""
    titled = _titled(spark, sf_dir)
    pred = skill_cv(titled, "doc_id", "job_title", "lang", _eligible(titled))
    return pred.select("flag", "id", "y", F.col("p").isin(0, 1).alias("predicted"))


@query()
def skill_cv_published(spark, sf_dir):
    titled = _titled(spark, sf_dir)
    return skill_cv(titled, "doc_id", "job_title", "lang", _eligible(titled))


def _loo_sql() -> str:
    """``loo(flag, id, y, p)``: naive Bayes per flag from total counts minus the row's own counts."""
    parts = []
    for f in FLAGS:
        parts.append(f"""
SELECT '{f}' AS flag, r.doc_id AS id, {f} AS y, CAST(
  ln((n1 - {f})::DOUBLE / (n - 1)) + coalesce(s1, 0) - coalesce(used, 0) * ln(m1 - {f} * coalesce(len, 0) + words - coalesce(lone, 0))
  > ln((n - n1 - 1 + {f})::DOUBLE / (n - 1)) + coalesce(s0, 0)
    - coalesce(used, 0) * ln(m - m1 - (1 - {f}) * coalesce(len, 0) + words - coalesce(lone, 0)) AS INTEGER) AS p
FROM flagged r LEFT JOIN (
  SELECT doc_id, sum(tf) AS len, sum(tf) FILTER (total > tf) AS used, count(*) FILTER (total = tf) AS lone,
    sum(tf * ln(pos - {f} * tf + 1)) FILTER (total > tf) AS s1,
    sum(tf * ln(total - pos - (1 - {f}) * tf + 1)) FILTER (total > tf) AS s0
  FROM counts JOIN (SELECT term, sum(tf) AS total, sum(tf * {f}) AS pos FROM counts GROUP BY term) USING (term)
  GROUP BY doc_id) s ON s.doc_id = r.doc_id,
  (SELECT sum(tf) AS m, sum(tf * {f}) AS m1, count(DISTINCT term) AS words FROM counts),
  (SELECT count(*) AS n, sum({f}) AS n1 FROM flagged)
WHERE {_ELIGIBLE.format(f=f)}""")
    flags = ", ".join(FLAGS)
    return f"""
flagged AS (SELECT doc_id, lang, {TITLE} AS job_title, {flags_sql('lower(text)')} FROM documents),
words_of AS (
  SELECT doc_id, {flags}, unnest(list_append({tokens_sql('job_title')}, chr(1) || lang)) AS term FROM flagged),
counts AS (SELECT doc_id, {flags}, term, count(*) AS tf FROM words_of GROUP BY ALL),
loo AS ({' UNION ALL '.join(parts)})"""


@query(f"WITH {_loo_sql()} SELECT * FROM loo")
def skill_loo_(spark, sf_dir):
    titled = _titled(spark, sf_dir)
    return skill_loo(titled, "doc_id", "job_title", _eligible(titled), "lang")


@query(f"""
WITH {_loo_sql()},
cells AS (
  SELECT flag, count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 1) AS pos,
    count(*) FILTER (p = 1) AS said, count(*) FILTER (y = p) AS same, count(*) AS n FROM loo GROUP BY flag),
scored AS (
  SELECT flag, pos AS n_positive, n - pos AS n_negative, coalesce(2.0::DOUBLE * tp / nullif(pos + said, 0), 0) AS f1,
    coalesce(tp::DOUBLE / nullif(said, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(pos, 0), 0) AS recall,
    same::DOUBLE / n AS accuracy, greatest(pos, n - pos)::DOUBLE / n AS baseline FROM cells),
banded AS (SELECT *, CASE WHEN f1 >= 0.6 THEN 'strong' WHEN f1 >= 0.3 THEN 'mid' ELSE 'weak' END AS band FROM scored)
SELECT flag, n_positive, n_negative, round(f1, 6) AS f1, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(accuracy, 6) AS accuracy, round(baseline, 6) AS baseline, band,
  CAST(row_number() OVER (PARTITION BY band ORDER BY f1 DESC, flag) AS INTEGER) AS rank FROM banded""")
def skill_prediction_(spark, sf_dir):
    tables = skill_prediction(_titled(spark, sf_dir), "doc_id", "job_title", "lang", FLAGS)
    joined = tables["metrics"].join(tables["bands"].drop("f1"), "flag")
    shares = ("f1", "precision", "recall", "accuracy", "baseline")
    return joined.withColumns({c: F.round(c, 6) for c in shares})

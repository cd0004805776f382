"""Training, selection and evaluation of the role classifier and the skill classifiers."""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..operators import evaluation as ev
from ..operators.features import (
    echo_change_count,
    engineered_features,
    engineered_names,
    one_hot,
    strip_label_echo,
)
from ..operators.interpretation import top_signals_per_class, top_terms_per_class
from ..operators.linear import LOGISTIC, Fit, LinearModel, balanced, solve, store_rows
from ..operators.learners import (
    Candidate,
    Classifier,
    in_threads,
    cross_validate,
    fit_final_and_score,
    fit_linear_svm,
    fit_linear_svm_folds,
    fit_logreg,
    fit_logreg_folds,
    fit_naive_bayes,
    fit_random_forest,
    score_column,
)
from ..operators.analytics import band_by_f1, class_balance_eligibility
from ..operators.splits import class_counts, index_labels, stratified_folds, stratified_split
from ..operators.vectorise import (
    StandardiseModel,
    TermTable,
    TfidfModel,
    append_values,
    as_vectors,
    assemble,
    fit_tfidf,
    ngrams_1_2,
    standardise,
    term_counts,
    tokenize,
)
from ..rules import DEGREE_PATTERNS, ROLE_TAXONOMY, STOP_WORDS, TITLE_ECHOES, YEARS_PATTERN, Entry
from ..session import durable


@dataclass(frozen=True)
class Settings:
    """Rules and sizes of the feature pipeline; the defaults are the published ones."""

    taxonomy: Sequence[Entry] = field(default_factory=lambda: ROLE_TAXONOMY)
    degrees: Mapping[str, str] = field(default_factory=lambda: DEGREE_PATTERNS)
    years_pattern: str = YEARS_PATTERN
    stop_words: Sequence[str] = field(default_factory=lambda: STOP_WORDS)
    size: int | None = 6000
    min_df: int = 5
    max_df: float = 0.6
    test: float = 0.2
    folds: int = 5
    seed: int = 42

    @property
    def engineered(self) -> list[str]:
        return engineered_names(self.taxonomy, self.degrees)


@dataclass(frozen=True)
class Features:
    """A stored feature table and what is needed to build the same for other texts.

    ``table`` has ``id, label, is_test, tfidf``, the engineered columns standardised on
    the training rows, and ``features``, the two put together.
    """

    table: DataFrame
    labels: list[str]
    tfidf: TfidfModel | TermTable
    scaler: StandardiseModel
    settings: Settings

    @property
    def train(self) -> DataFrame:
        return self.table.where(~F.col("is_test"))

    @property
    def test(self) -> DataFrame:
        return self.table.where("is_test")

    @property
    def names(self) -> list[str]:
        return [*self.tfidf.terms, *self.settings.engineered]

    def train_folds(self) -> DataFrame:
        """Training rows with their fold, stored: every fit scans finished vectors only."""
        s = self.settings
        vectors = self.train.select("id", "label", "tfidf", "features")
        return durable(stratified_folds(vectors, "label", "id", s.folds, s.seed))

    def of(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``(id, tfidf, .., features)`` of new texts under the fitted models."""
        texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        table = as_vectors(_weighted(_described(texts, self.settings), self.tfidf), ["tfidf"])
        return _assembled(table, self.scaler, self.settings)


def _described(texts: DataFrame, settings: Settings) -> DataFrame:
    return engineered_features(
        texts if "tokens" in texts.columns else tokenize(texts, "text", settings.stop_words),
        "text",
        settings.taxonomy,
        settings.degrees,
        settings.years_pattern,
    )


def _weighted(described: DataFrame, model: TfidfModel | TermTable) -> DataFrame:
    return model.transform(described, "tokens", pairs=True).drop("text", "tokens")


def _assembled(table: DataFrame, scaler: StandardiseModel, settings: Settings) -> DataFrame:
    return assemble(scaler.transform(table), ["tfidf", *settings.engineered])


def build_features(
    df: DataFrame, id_col: str, text_col: str, label_col: str, settings: Settings | None = None,
    hold_out: bool = True, tokens: str | None = None,
) -> Features:
    """Split, fit the vocabulary and the scaler on the training rows, store the features.

    One pass over the texts: their words and engineered columns are stored, and labels,
    split, vocabulary and weights read only the columns they need of that table. Without
    ``hold_out`` every row trains. ``tokens`` names the column of a stored ``df`` that has the words
    of the text, without the stop words of the settings, if there is one; they aren't stored again.
    """
    settings = settings or Settings()
    words = [F.col(tokens).alias("tokens")] if tokens else []
    rows = df.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("_class"), *words
    ).dropna(subset=["text", "_class"])
    described = _described(rows, settings)
    if not tokens:
        described = durable(described.drop("text"))
    indexed, labels = index_labels(described, "_class")
    indexed = indexed.drop("_class")
    if hold_out:
        split = stratified_split(indexed, "label", "id", settings.test, settings.seed)
    else:
        split = indexed.withColumn("is_test", F.lit(False))
    model = fit_tfidf(
        split.where(~F.col("is_test")),
        "tokens",
        min_df=settings.min_df,
        max_df=settings.max_df,
        size=settings.size,
        pairs=True,
    )
    table = as_vectors(_weighted(split, model), ["tfidf"])
    scaler = standardise(table.where(~F.col("is_test")), settings.engineered)
    return Features(_assembled(table, scaler, settings), labels, model, scaler, settings)


def published_candidates(
    trees: int = 200, depth: int = 30, max_iter: int | None = None
) -> list[Candidate]:
    """The four learners compared, in their published order and settings.

    ``max_iter`` overrides the published limits of logistic regression and SVM.
    """
    limit = {} if max_iter is None else {"max_iter": max_iter}
    return [
        Candidate("MultinomialNB", functools.partial(fit_naive_bayes, features="tfidf")),
        Candidate(
            "LogisticRegression", functools.partial(fit_logreg, **limit), functools.partial(fit_logreg_folds, **limit)
        ),
        Candidate(
            "LinearSVM", functools.partial(fit_linear_svm, **limit), functools.partial(fit_linear_svm_folds, **limit)
        ),
        Candidate("RandomForest", functools.partial(fit_random_forest, trees=trees, depth=depth)),
    ]


def test_scores(pred: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``(label, score, positive)`` rows for the AUC of a prediction table."""
    names = F.array(*[F.lit(name) for name in labels])
    pairs = F.transform(
        vector_to_array(score_column(pred)),
        lambda s, i: F.struct(
            F.get(names, i).alias("label"),
            s.alias("score"),
            (F.col("label") == i).cast("int").alias("positive"),
        ),
    )
    return pred.select(F.inline(pairs))


def _test_metrics(pred: DataFrame, labels: Sequence[str]) -> dict[str, DataFrame]:
    scored = durable(
        pred.select(
            F.get(F.array(*[F.lit(n) for n in labels]), F.col("label").cast("int")).alias("y"),
            F.get(F.array(*[F.lit(n) for n in labels]), F.col("prediction").cast("int")).alias("p"),
            "label",
            F.col(score_column(pred)).alias("rawPrediction"),
        )
    )
    cm = ev.confusion_matrix(scored, labels)
    return {
        "confusion": ev.confusion_pct(cm),
        "report": ev.classification_report(cm),
        "summary": ev.accuracy_macro_weighted(cm),
        "auc": ev.roc_auc_ovr(test_scores(scored, labels)),
    }


def train_and_evaluate(
    features: Features, candidates: Sequence[Candidate] | None = None
) -> dict[str, DataFrame]:
    """Cross-validate, refit the winner, score the test rows once, explain with logreg.

    Returns tables ``cv, cv_summary, best, confusion, report, summary, auc,
    logreg_summary, logreg_auc, top_terms``, and ``comparison`` of the candidates beside the test metrics known,
    ``classes`` (rows per class and side) and ``shapes`` (rows and columns per side).
    """
    candidates = list(candidates or published_candidates())
    cv = durable(
        cross_validate(features.train_folds(), candidates, features.settings.folds)
    )
    best_name = ev.select_best(cv).first()["candidate"]
    by_name = {c.name: c for c in candidates}
    _, pred = fit_final_and_score(by_name[best_name], features.train, features.test)
    logreg, logreg_pred = fit_final_and_score(
        by_name.get("LogisticRegression", Candidate("LogisticRegression", fit_logreg)),
        features.train,
        features.test,
    )
    logreg_tables = _test_metrics(logreg_pred, features.labels)
    tables = _test_metrics(pred, features.labels)
    known = tables["summary"].withColumn("candidate", F.lit(best_name))
    if best_name != "LogisticRegression":
        other = logreg_tables["summary"].withColumn("candidate", F.lit("LogisticRegression"))
        known = known.unionByName(other)
    sides = features.table.groupBy("label", "is_test").agg(F.count("*").alias("n"))
    names = F.array(*[F.lit(n) for n in features.labels])
    return {
        "comparison": ev.model_comparison(cv, known),
        "classes": sides.select(F.get(names, F.col("label").cast("int")).alias("class"), "is_test", "n"),
        "shapes": sides.groupBy("is_test")
        .agg(F.sum("n").alias("n_rows"))
        .withColumn("n_features", F.lit(len(features.names))),
        "cv": cv,
        "cv_summary": ev.cv_summary(cv),
        "best": ev.select_best(cv),
        **tables,
        "logreg_summary": logreg_tables["summary"],
        "logreg_auc": logreg_tables["auc"],
        "top_terms": top_terms_per_class(
            cv.sparkSession, logreg, features.labels, features.names
        ),
    }


#: The batched form of each learner that has one.
_FOLDED = {fit_linear_svm: fit_linear_svm_folds, fit_logreg: fit_logreg_folds}


def feature_ablation(features: Features, fit: Callable[..., Classifier] = fit_linear_svm) -> DataFrame:
    """``(features, mean, std, delta)``: a learner on text only and on text plus engineered.

    ``delta`` is the gain over text only.
    """
    folded = _FOLDED.get(fit)
    runs = [
        Candidate(name, functools.partial(fit, features=column), folded and functools.partial(folded, features=column))
        for name, column in [("tfidf_only", "tfidf"), ("combined", "features")]
    ]
    cv = durable(cross_validate(features.train_folds(), runs, features.settings.folds))
    summary = ev.cv_summary(cv)
    base = summary.where("position = 0").select("mean").scalar()
    return summary.select(
        F.col("candidate").alias("features"), "mean", "std", (F.col("mean") - base).alias("delta")
    )


def engineered_only(
    df: DataFrame, id_col: str, text_col: str, label_col: str, settings: Settings | None = None,
    fit: Callable[[DataFrame], Classifier] = fit_logreg,
) -> dict[str, DataFrame]:
    """A linear learner on the engineered columns alone, over all rows.

    Returns ``cv`` and ``top_signals``.
    """
    settings = settings or Settings()
    rows = df.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("_class")
    ).dropna(subset=["text", "_class"])
    indexed, labels = index_labels(rows, "_class")
    table = durable(
        engineered_features(
            indexed, "text", settings.taxonomy, settings.degrees, settings.years_pattern
        ).drop("text", "_class")
    )
    scaled = standardise(table, settings.engineered).transform(table)
    vectors = assemble(scaled, settings.engineered).select("id", "label", "features")
    folded = durable(stratified_folds(vectors, "label", "id", settings.folds, settings.seed))
    cv = cross_validate(folded, [Candidate("LogisticRegression", fit, _FOLDED.get(fit))], settings.folds)
    return {
        "cv": cv,
        "top_signals": top_signals_per_class(
            df.sparkSession, fit(folded), labels, settings.engineered
        ),
    }


def engineered_only_cv(*args, **kwargs) -> DataFrame:
    """``(candidate, position, fold, macro_f1)`` of `engineered_only`."""
    return engineered_only(*args, **kwargs)["cv"]


def echo_robustness(
    df: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    phrases: Mapping[str, Sequence[str]] = TITLE_ECHOES,
    settings: Settings | None = None,
    fit: Callable[[DataFrame], Classifier] = fit_linear_svm,
) -> DataFrame:
    """``(text, mean, std, n_changed, n_rows)``: a learner on full and on echo-stripped texts."""
    settings = settings or Settings()
    rows = df.dropna(subset=[text_col, label_col])
    stripped = strip_label_echo(rows, text_col, label_col, phrases, "_stripped")
    summaries = []
    for name, column in [("original", text_col), ("stripped", "_stripped")]:
        features = build_features(stripped, id_col, column, label_col, settings)
        cv = cross_validate(features.train_folds(), [Candidate(name, fit, _FOLDED.get(fit))], settings.folds)
        summaries.append(ev.cv_summary(cv).select(F.col("candidate").alias("text"), "mean", "std"))
    changed = echo_change_count(stripped, text_col, "_stripped").first()
    return summaries[0].unionByName(summaries[1]).withColumns(
        {"n_changed": F.lit(changed["n_changed"]), "n_rows": F.lit(changed["n_rows"])}
    )


def skill_cv(
    df: DataFrame,
    id_col: str,
    title: str,
    category: str,
    flags: Sequence[str],
    k: int = 5,
    seed: int = 42,
    stop_words: Sequence[str] = STOP_WORDS,
    size: int | None = None,
    max_iter: int = 1000,
    threads: int = 4,
) -> DataFrame:
    """``(flag, id, y, p)``: every row predicted from its title by a model not fitted on it.

    Per fold the title vocabulary is fitted on the other rows and the features are
    stored once; then one balanced logistic regression for each flag, all of them in one
    batch that shares every pass over the rows. Without a ``size`` the vocabulary may
    have any number of words: it stays a table, of which a fit holds a weight per word.
    """
    values = list(class_counts(df.where(F.col(category).isNotNull()), category))
    hot = {f"_is_{v}": f"_hot_{i}" for i, v in enumerate(values)}
    fold = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(k)).cast("int")
    rows = one_hot(df, category, values, "_is_").withColumnsRenamed(hot).select(
        F.col(id_col).alias("id"),
        F.col(title).alias("text"),
        fold.alias("fold"),
        *hot.values(),
        *flags,
    )
    terms = ngrams_1_2(tokenize(rows, "text", stop_words))

    def features_of(j: int) -> DataFrame:
        model = fit_tfidf(
            terms.where(F.col("fold") != j), min_df=1, max_df=1.0, size=size, sublinear=False
        )
        joined = append_values(model.transform(terms), list(hot.values()))
        return as_vectors(joined.select("id", "fold", "features", *flags), ["features"])

    def predictions_of(j: int, table: DataFrame) -> DataFrame:
        """All flags of a fold, fitted together; a flag that has one class only predicts that class."""
        counts = table.where(F.col("fold") != j).agg(F.count("*"), *[F.sum(f) for f in flags]).first()
        sides = [{0: counts[0] - ones, 1: ones} for ones in counts[1:]]
        stored = store_rows(table, "features", flags, "fold", apart=True)
        fits = [Fit(i, j, balanced(side), (1,)) for i, side in enumerate(sides)]
        solved = solve(stored, LOGISTIC, fits, 1.0, 0.0, max_iter=max_iter)
        model = LinearModel(
            LOGISTIC,
            np.stack([s.weights[:, 0] for s in solved]),
            np.array([s.intercepts[0] if all(side.values()) else side[1] - 0.5 for s, side in zip(solved, sides, strict=True)]),
        )
        scored = table.where(F.col("fold") == j).withColumn("_margins", model.margins())
        rows = [
            F.struct(
                F.lit(f).alias("flag"),
                F.col(f).cast("int").alias("y"),
                (F.get("_margins", F.lit(i)) > 0).cast("int").alias("p"),
            )
            for i, f in enumerate(flags)
        ]
        # Stored at once: the driver then holds the weights of one fold and not of all.
        return durable(scored.select("id", F.inline(F.array(*rows))).select("flag", "id", "y", "p"))

    tables = in_threads(df.sparkSession, features_of, range(k), threads)
    # One after the other: a batch keeps the session busy, and the driver holds the weights of one.
    return functools.reduce(DataFrame.unionByName, [predictions_of(j, table) for j, table in enumerate(tables)])


def skill_loo(
    df: DataFrame,
    id_col: str,
    title: str,
    flags: Sequence[str],
    category: str | None = None,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """``(flag, id, y, p)``: exact leave-one-out by multinomial naive Bayes on title words.

    A ``category`` counts as one more word of its row. The model without a row is the
    total counts minus the row's own, so one pass scores every row for all flags. Words
    found only in the row leave its vocabulary too. The word table is joined once on the
    word; Spark splits the parts of frequent words. Its rows carry no flags: both of a
    flag's sums are made, and the row's own flag picks one after they are summed.
    """
    rows = tokenize(df, title, stop_words, "_words").select(
        F.col(id_col).alias("id"), F.col("_words").alias("words"), *flags,
        *([F.col(category).alias("_category")] if category else []),
    )
    if category:
        named = F.concat(F.lit("\x01"), F.col("_category"))
        rows = rows.withColumn(
            "words", F.when(named.isNull(), F.col("words")).otherwise(F.array_append("words", named))
        ).drop("_category")
    stats = term_counts(rows, flags, "words").groupBy("term").agg(
        F.sum("tf").alias("total"),
        *[F.sum(F.col("tf") * F.col(f)).alias(f"pos_{f}") for f in flags],
    )
    stats = durable(stats)
    sums = stats.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
        F.count("*").alias("words"),
        *[F.coalesce(F.sum(f"pos_{f}"), F.lit(0)).alias(f"pos_{f}") for f in flags],
    ).first()
    sizes = rows.agg(F.count("*").alias("n"), *[F.sum(f).alias(f) for f in flags]).first()

    shared = F.col("total") > F.col("tf")
    sides = {"one": lambda f: F.col(f"pos_{f}"), "zero": lambda f: F.col("total") - F.col(f"pos_{f}")}
    per_row = (
        term_counts(rows, ["id"], "words")
        .join(stats, "term")
        .groupBy("id")
        .agg(
            F.sum("tf").alias("len"),
            F.sum(F.when(shared, F.col("tf"))).alias("used"),
            F.count_if(~shared).alias("lone"),
            *[
                F.sum(F.when(shared, F.col("tf") * F.log(hits(f) - own * F.col("tf") + 1))).alias(f"{side}_{f}_{own}")
                for side, hits in sides.items()
                for f in flags
                for own in (0, 1)
            ],
        )
    )
    scored = rows.select("id", *flags).join(per_row, "id", "left").fillna(0)

    def score(side: str, flag: str):
        own = F.col(flag) if side == "one" else 1 - F.col(flag)
        n_class = sizes[flag] if side == "one" else sizes["n"] - sizes[flag]
        mass = sums[f"pos_{flag}"] if side == "one" else sums["total"] - sums[f"pos_{flag}"]
        prior = F.log((F.lit(n_class) - own) / (sizes["n"] - 1))
        spread = F.log(F.lit(mass) - own * F.col("len") + sums["words"] - F.col("lone"))
        likelihood = F.when(own == 1, F.col(f"{side}_{flag}_1")).otherwise(F.col(f"{side}_{flag}_0"))
        return prior + likelihood - F.col("used") * F.coalesce(spread, F.lit(0.0))

    predicted = F.array(
        *[
            F.struct(
                F.lit(f).alias("flag"),
                F.col(f).cast("int").alias("y"),
                (score("one", f) > score("zero", f)).cast("int").alias("p"),
            )
            for f in flags
        ]
    )
    return scored.select("id", F.inline(predicted)).select("flag", "id", "y", "p")


def skill_prediction(
    df: DataFrame,
    id_col: str,
    title: str,
    category: str,
    flags: Sequence[str],
    min_count: int = 15,
    predict: Callable[..., DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Which skills titles and categories tell: from eligible flags to bands of F1.

    Flags with ``min_count`` rows on both sides are predicted out of sample (by default
    leave-one-out; ``predict(df, id, title, category, flags)`` may be another way) and scored beside
    the larger class's share. Returns ``eligible, predictions, metrics, bands``.
    """
    eligible = durable(class_balance_eligibility(df, flags, min_count))
    chosen = {r.flag for r in eligible.collect()}  # flags are columns, so they are few
    learnt = [f for f in flags if f in chosen]
    if not learnt:
        raise ValueError(f"no flag has {min_count} rows on both sides")
    if predict is None:
        pred = skill_loo(df, id_col, title, learnt, category)
    else:
        pred = predict(df, id_col, title, category, learnt)
    pred = durable(pred)
    metrics = ev.binary_metrics(pred, ["flag"]).join(ev.majority_baseline(pred, ["flag"]), "flag")
    return {
        "eligible": eligible,
        "predictions": pred,
        "metrics": metrics,
        "bands": band_by_f1(metrics),
    }

"""Batch answers to skill questions and gap reports for pasted postings."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import classification
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.labels import KeywordRule
from ..operators.analytics import skill_frequencies
from ..operators.features import flag_names, own_flags, tag_flags
from ..operators.labelling import route_query
from ..operators.learners import Classifier, classify_ranked, fit_linear_svm
from ..operators.linear import LinearModel
from ..operators.retrieval import (
    Index,
    answer_top_skills,
    grounding_quotes,
    retrieve_topk,
    skill_gap,
    top_sources,
    with_documents,
)
from ..operators.vectorise import MAX_TERMS, StandardiseModel, TermTable, TfidfModel
from ..rules import QUESTION_DEFAULT, QUESTION_ROUTES, ROLE_TAXONOMY, Entry
from ..session import durable
from .training import Features, Settings, build_features

DOC_COLUMNS = ["job_title", "company", "description", "source"]


def answer_questions(
    index: Index,
    docs: DataFrame,
    doc: str,
    questions: DataFrame,
    k: int = 20,
    taxonomy: Sequence[Entry] = ROLE_TAXONOMY,
    routes: Sequence[KeywordRule] = QUESTION_ROUTES,
    default: str = QUESTION_DEFAULT,
) -> dict[str, DataFrame]:
    """Route ``questions`` ``(query_id, text)``, retrieve, and report as tables.

    Returns ``routed, retrieved, skills, quotes, sources``. ``docs`` needs the columns
    in ``DOC_COLUMNS``. The retrieved rows, ``k`` per question, are stored once.
    """
    routed = route_query(questions, "text", routes, default, out="group")
    found = durable(with_documents(retrieve_topk(index, routed, k), docs, doc, DOC_COLUMNS))
    flags = flag_names(taxonomy)
    freq = skill_frequencies(
        tag_flags(found, ["description"], taxonomy), ["query_id", "group"], flags
    )
    return {
        "routed": routed,
        "retrieved": found.select("query_id", "group", "rank", "doc", "similarity"),
        "skills": answer_top_skills(freq, index.sizes),
        "quotes": grounding_quotes(found),
        "sources": top_sources(found),
    }


@dataclass(frozen=True)
class RoleModel:
    """The classifier that is put to use: fitted on the whole corpus."""

    features: Features
    learner: Classifier

    def classify(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``(id, rank, label, score)``: all classes per text, best first."""
        table = self.features.of(df, id_col, text_col)
        return classify_ranked(self.learner, table, "id", self.features.labels)

    def save(self, path: str) -> None:
        """Write the model below ``path``; `load_role_model` reads it in any session.

        The training rows are not part of it.
        """
        f, spark = self.features, self.features.table.sparkSession
        facts = {
            "labels": f.labels,
            "settings": asdict(f.settings),
            "means": f.scaler.means,
            "deviations": f.scaler.deviations,
            "sublinear": f.tfidf.sublinear,
            "learner": type(self.learner).__name__,
        }
        spark.createDataFrame([(json.dumps(facts),)], "facts string").write.mode("overwrite").parquet(f"{path}/facts")
        if isinstance(f.tfidf, TermTable):
            terms = f.tfidf.vocab
        else:
            terms = spark.createDataFrame(
                [(t, i, w) for i, (t, w) in enumerate(zip(f.tfidf.terms, f.tfidf.idf, strict=True))],
                "term string, code int, idf double",
            )
        terms.write.mode("overwrite").parquet(f"{path}/terms")
        if isinstance(self.learner, LinearModel):
            self.learner.save(spark, f"{path}/learner")
        else:
            self.learner.write().overwrite().save(f"{path}/learner")


def load_role_model(spark: SparkSession, path: str) -> RoleModel:
    """A saved model; its features have an empty table, as the training rows are not kept."""
    facts = json.loads(spark.read.parquet(f"{path}/facts").first()[0])
    raw = facts["settings"]
    settings = Settings(**raw | {"taxonomy": [Entry(*e) for e in raw["taxonomy"]]})
    terms = spark.read.parquet(f"{path}/terms")
    if settings.size is None or settings.size > MAX_TERMS:
        tfidf = TermTable(terms, max(1, terms.count()), facts["sublinear"])
    else:
        rows = sorted(terms.collect(), key=lambda r: r.code)
        tfidf = TfidfModel([r.term for r in rows], [r.idf for r in rows], facts["sublinear"])
    scaler = StandardiseModel(facts["means"], facts["deviations"])
    features = Features(spark.range(0).toDF("id"), facts["labels"], tfidf, scaler, settings)
    if facts["learner"] == LinearModel.__name__:
        learner = LinearModel.load(spark, f"{path}/learner")
    else:
        learner = getattr(classification, facts["learner"]).load(f"{path}/learner")
    return RoleModel(features, learner)


def train_role_model(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    settings: Settings | None = None,
    fit: Callable[[DataFrame], Classifier] = fit_linear_svm,
    tokens: str | None = None,
) -> RoleModel:
    """Fit on all rows; the honest scores come from `training.train_and_evaluate`."""
    features = build_features(docs, id_col, text_col, label_col, settings, hold_out=False, tokens=tokens)
    return RoleModel(features, fit(features.table))


def analyse_postings(
    index: Index,
    model: RoleModel,
    docs: DataFrame,
    doc: str,
    postings: DataFrame,
    k: int = 25,
    taxonomy: Sequence[Entry] = ROLE_TAXONOMY,
) -> dict[str, DataFrame]:
    """Classify ``postings`` ``(query_id, text)``, retrieve in the predicted role, and
    report which common skills each text has or lacks.

    Returns ``classified, retrieved, skills, gap``.
    """
    classified = durable(
        model.classify(postings, "query_id", "text").withColumnRenamed("id", "query_id")
    )
    predicted = classified.where("rank = 1").select("query_id", F.col("label").alias("group"))
    queries = postings.join(predicted, "query_id").select("query_id", "group", "text")
    found = durable(
        with_documents(retrieve_topk(index, queries, k), docs, doc, ["description"])
    )
    flags = flag_names(taxonomy)
    freq = skill_frequencies(tag_flags(found, ["description"], taxonomy), ["query_id"], flags)
    own = own_flags(postings, "text", taxonomy).select("query_id", *flags)
    return {
        "classified": classified,
        "retrieved": found.select("query_id", "group", "rank", "doc", "similarity"),
        "skills": freq,
        "gap": skill_gap(freq, own, "query_id", flags),
    }

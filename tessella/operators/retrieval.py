"""Corpus, top-k retrieval within a category, and reports on what was retrieved."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.regex import SPACE
from ..functions.text import text_length
from ..rules import BASE_SOURCE, CATEGORY_ROLES, FRESH_SOURCE, STOP_WORDS
from ..session import durable
from .labelling import mapped_category
from .terms import Asked
from .vectorise import (
    pair_stats,
    per_group_tfidf,
    tokenize,
    top_per_group,
    top_vocabulary,
    weigh_per_group,
)

# Similarities closer than this many decimals are ties, ordered by the row ordinal.
SIMILARITY_DECIMALS = 9


def build_corpus(
    base: DataFrame,
    fresh: DataFrame,
    mapping: Mapping[str, str] = CATEGORY_ROLES,
    base_source: str = BASE_SOURCE,
    fresh_source: str = FRESH_SOURCE,
) -> DataFrame:
    """Cleaned postings and fresh ones by column name, with their ``source``.

    Fresh texts are taken as they are; attributes they lack are null.
    """
    category = mapped_category(F.col("category"), mapping)
    taken = fresh.select(
        "job_title",
        category.alias("role_category"),
        "company",
        "location",
        text_length(F.col("description_text")).alias("description_length"),
        F.col("description_text").alias("description"),
    )
    return base.withColumn("source", F.lit(base_source)).unionByName(
        taken.withColumn("source", F.lit(fresh_source)), allowMissingColumns=True
    )


@dataclass(frozen=True)
class Index:
    """Stored weights of every document, with one vocabulary per category.

    ``rows`` has ``(group, doc, weights)``, one row per document;
    ``vocab`` has ``(group, term, idf)`` and ``sizes`` ``(group, n_docs)``.
    """

    vocab: DataFrame
    rows: DataFrame
    sizes: DataFrame
    stop_words: Sequence[str]

    @property
    def docs(self) -> DataFrame:
        return self.rows.select("group", "doc")

    @property
    def weights(self) -> DataFrame:
        """``(group, doc, term, weight)``, opened inside the tasks that read the rows."""
        opened = self.rows.select("group", "doc", F.inline_outer("weights"))
        return opened.where("term is not null")

    def save(self, path: str) -> None:
        """Write the index below ``path``; `load_index` reads it in any session."""
        for name, df in [("vocab", self.vocab), ("rows", self.rows), ("sizes", self.sizes)]:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
        words = self.rows.sparkSession.createDataFrame([(list(self.stop_words),)], "words array<string>")
        words.write.mode("overwrite").parquet(f"{path}/stop_words")


def load_index(spark: SparkSession, path: str) -> Index:
    """A saved index."""
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    return Index(read("vocab"), read("rows"), read("sizes"), read("stop_words").first()[0])


def build_index(
    docs: DataFrame,
    doc: str,
    group: str,
    text: str,
    size: int = 5000,
    stop_words: Sequence[str] = STOP_WORDS,
    tokens: str | None = None,
) -> Index:
    """Index all categories in one job: vocabularies, then every document's weights.

    One pass over the texts, whose words are stored. Weights and norms are made in the document's
    row and stored once, so a batch of queries reads no text. ``tokens`` names the column of stored
    ``docs`` that has the words of the text, without these stop words, if there is one.
    """
    named = [F.col(group).alias("group"), F.col(doc).alias("doc"), F.col(tokens or text).alias("tokens")]
    words = docs.select(*named).where("group is not null")
    if not tokens:
        words = durable(tokenize(words, "tokens", stop_words))
    sizes = durable(words.groupBy("group").agg(F.count("*").alias("n_docs")))
    vocab = durable(top_vocabulary(pair_stats(words, "tokens", "group", size), sizes, "group", size))
    weighted = weigh_per_group(words, vocab, "group", "tokens", pairs=True).select("group", "doc", "weights")
    return Index(vocab, durable(weighted), sizes, stop_words)


def query_weights(index: Index, queries: DataFrame) -> DataFrame:
    """``(query_id, group, term, q_weight)`` of ``queries`` ``(query_id, group, text)``."""
    words = tokenize(queries, "text", index.stop_words)
    weights = per_group_tfidf(words, index.vocab, "group", "query_id", "tokens", pairs=True)
    return weights.withColumnRenamed("weight", "q_weight")


def _closest(rows: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """``(query_id, group, doc, similarity)``: the ``k`` closest documents of each task's rows."""
    asked, kinds = Asked(weights.toArrow()), {f.name: f.dataType for f in [*weights.schema, *rows.schema]}
    schema = StructType([StructField(c, kinds[c]) for c in ("query_id", "group", "doc")]).add("similarity", "double")
    return rows.select("group", "doc", "weights").mapInArrow(
        lambda batches: asked.closest(batches, k, SIMILARITY_DECIMALS), schema
    )


def _summed(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """``(query_id, group, doc, similarity)`` of all pairs that share a term, by a join on the term."""
    opened = rows.select("group", "doc", F.inline_outer("weights")).where("term is not null")
    similarity = F.round(F.sum(F.col("weight") * F.col("q_weight")), SIMILARITY_DECIMALS)
    joined = opened.join(weights, ["group", "term"])
    return joined.groupBy("query_id", "group", "doc").agg(similarity.alias("similarity"))


def retrieve_topk(index: Index, queries: DataFrame, k: int = 20, broadcast_rows: int = 1_000_000) -> DataFrame:
    """``(query_id, group, rank, doc, similarity)``: the ``k`` closest documents of the
    query's category by cosine; ties go to the lower document id.

    Documents sharing no term score 0 and fill up a short list. Only the first ``k``
    documents of a category can be needed for that, so the remaining zero pairs are
    never formed. The stored query weights go to every task while they are at most
    ``broadcast_rows`` (beyond, Spark joins by term). A document's weights are in one row, so
    its similarities are summed in the task that reads it, and only ``k`` rows per query
    leave the task. Documents whose id comes more than once are summed over their rows.
    """
    weights = durable(query_weights(index, queries))
    n_weights = weights.count()
    if n_weights <= broadcast_rows and weights.schema["group"].dataType == index.rows.schema["group"].dataType:
        by = ["group", "doc"]
        again = durable(index.rows.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1").select(*by))
        scored = _closest(index.rows, weights, k)
        if not again.isEmpty():
            same = functools.reduce(operator.and_, [F.col(f"r.{c}").eqNullSafe(F.col(f"a.{c}")) for c in by])
            of = lambda how: index.rows.alias("r").join(again.alias("a"), same, how)
            scored = _closest(of("left_anti"), weights, k).unionByName(_summed(of("left_semi"), F.broadcast(weights)))
    else:
        scored = _summed(index.rows, F.broadcast(weights) if n_weights <= broadcast_rows else weights)
    order = [F.desc("similarity"), F.col("doc")]
    hits = top_per_group(scored, ["query_id", "group"], order, k, "doc")
    first = top_per_group(index.docs, ["group"], [F.col("doc")], k, "doc")
    fill = (
        queries.select("query_id", "group")
        .join(first, "group")
        .select("query_id", "group", "doc", F.lit(0.0).alias("similarity"))
    )
    best = (
        hits.unionByName(fill)
        .groupBy("query_id", "group", "doc")
        .agg(F.max("similarity").alias("similarity"))
    )
    window = Window.partitionBy("query_id", "group").orderBy(*order)
    ranked = best.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return ranked.select("query_id", "group", "rank", "doc", "similarity")


def with_documents(
    retrieved: DataFrame, docs: DataFrame, doc: str, cols: Sequence[str]
) -> DataFrame:
    """Attach document columns to retrieved rows; only those documents are kept.

    The retrieved ids are stored first: Spark then sees that they are the small side and
    sends them to the texts, instead of shuffling the texts to them.
    """
    return durable(retrieved).join(docs.select(F.col(doc).alias("doc"), *cols), "doc")


def answer_top_skills(freq: DataFrame, sizes: DataFrame, n: int = 12) -> DataFrame:
    """``(query_id, group, rank, flag, pct, n, n_rows, n_docs)``: the first ``n`` skills,
    with how many rows were retrieved and how many the category has."""
    return freq.where(F.col("rank") <= n).join(sizes, "group")


def _strip(col: Column) -> Column:
    return F.regexp_replace(col, f"^[{SPACE}]+|[{SPACE}]+$", "")


def grounding_quotes(
    retrieved: DataFrame,
    n: int = 3,
    min_len: int = 60,
    width: int = 220,
    missing: str = "unlisted company",
) -> DataFrame:
    """``(query_id, quote, job_title, company, snippet)``: the start of the first ``n``
    retrieved texts that are long enough."""
    stripped = retrieved.withColumn("_text", _strip(F.coalesce("description", F.lit(""))))
    window = Window.partitionBy("query_id").orderBy("rank")
    snippet = F.concat(F.translate(F.substring("_text", 1, width), "\n", " "), F.lit("..."))
    return (
        stripped.where(F.length("_text") >= min_len)
        .withColumn("quote", F.row_number().over(window))
        .where(F.col("quote") <= n)
        .select(
            "query_id",
            "quote",
            "job_title",
            F.coalesce("company", F.lit(missing)).alias("company"),
            snippet.alias("snippet"),
        )
    )


def top_sources(retrieved: DataFrame, n: int = 5, missing: str = "unlisted") -> DataFrame:
    """``(query_id, rank, job_title, company, similarity, source)`` of the closest rows."""
    return retrieved.where(F.col("rank") <= n).select(
        "query_id",
        "rank",
        "job_title",
        F.coalesce("company", F.lit(missing)).alias("company"),
        F.round("similarity", 3).alias("similarity"),
        "source",
    )


def skill_gap(
    freq: DataFrame,
    own: DataFrame,
    key: str,
    flags: Sequence[str],
    min_pct: int = 15,
    n: int = 10,
) -> DataFrame:
    """``(key, status, rank, flag, pct)``: common skills the text has or lacks.

    ``freq`` comes from `skill_frequencies`, ``own`` holds the flags of each text; the
    limit applies to the rounded percent.
    """
    long = own.unpivot([key], list(flags), "flag", "has")
    status = F.when(F.col("has") == 1, "present").otherwise("missing")
    window = Window.partitionBy(key, "status").orderBy("_order")
    return (
        freq.where(F.col("pct") >= min_pct)
        .select(key, "flag", "pct", F.col("rank").alias("_order"))
        .join(long, [key, "flag"])
        .withColumn("status", status)
        .withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= n)
        .select(key, "status", "rank", "flag", "pct")
    )

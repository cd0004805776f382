"""A training corpus from raw documents: five stages, each stored before the next one reads it.

Low-quality documents go, one document of each near-duplicate group stays, documents that
hold benchmark items go, sources are mixed to their target weights, and what the mix takes
is dealt into shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessella.llm.decontaminate import without_leaks
from tessella.llm.mixing import mix_to_targets
from tessella.llm.near import near_duplicates
from tessella.llm.quality import classify_quality
from tessella.llm.registry import table
from tessella.llm.sharding import shard_by_splitters
from tessella.session import durable

THRESHOLD = 0.3
SHARDS = 8


def _unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until ``docs`` has no such column."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour vote doesn't reject."""
    (score,) = _unused(docs, "quality_score")
    scored = classify_quality(docs, table(spark, sf_dir, "labels"), score_col=score)
    return scored.where(F.col(score) >= THRESHOLD).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates; of repeated rows, one.

    Texts without words are in no group and all stay.
    """
    key, row, of, text, blank = _unused(docs, "text_key", "row", "kept_id", "kept_text", "kept_blank")
    found = near_duplicates(docs).where("first")
    kept = found.select(
        F.col("doc_id").alias(of), F.col("text_key").alias(text), (F.col("n_shingles") == 0).alias(blank)
    ).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(of)) & (F.col(key) == F.col(text))
    joined = docs.withColumn(key, F.xxhash64("text")).join(durable(kept), same)
    numbered = joined.withColumn(row, F.when(F.col(blank), F.monotonically_increasing_id()))
    return numbered.dropDuplicates(["doc_id", key, row]).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; those it doesn't take go."""
    key, of, text, source, times = _unused(docs, "text_key", "mixed_id", "mixed_text", "mixed_source", "mixed_times")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    mixed = mix_to_targets(keyed.select("doc_id", "text", "source", F.col(key).alias("text_key")), keep=["text_key"])
    copies = (
        mixed.groupBy(F.col("doc_id").alias(of), F.col("text_key").alias(text), F.col("source").alias(source))
        .agg(F.sum("copies").cast("int").alias(times))
        .where(F.col(times) > 0)
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col(of))
        & (F.col(key) == F.col(text))
        & F.col("source").eqNullSafe(F.col(source))
    )
    # Rows equal in id, text and source were summed into one.
    taken = keyed.join(durable(copies), same).dropDuplicates(["doc_id", key, "source"])
    return taken.withColumn(key, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and the slot of every row."""
    return shard_by_splitters(docs, shards=SHARDS)


STAGES = [
    ("quality", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The vote of the first stage can't be told in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs

"""From raw postings to analysis tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import (
    KeywordRule,
    PatternRule,
    clean_text,
    label_by_keywords,
    label_by_regex,
    parse_timestamp_utc,
    seniority_band,
    text_length,
)
from ..operators.cleaning import dedupe_keep_first, drop_missing
from ..operators.features import flag_names, tag_flags
from ..operators.labelling import drop_unlabelled
from ..rules import (
    KEYWORD_DEFAULT,
    KEYWORD_ROLES,
    LABELLED_COLUMNS,
    MIN_DESCRIPTION_CHARS,
    PATTERN_ROLES,
    POSTING_SKILLS,
    RAW_HEADERS,
    SENIORITY_RULES,
    TAGGED_COLUMNS,
    Entry,
)
from ..sources import normalise_columns


def tagged_postings(
    raw: DataFrame,
    ordinal: str,
    skills: Sequence[Entry] = POSTING_SKILLS,
    roles: Sequence[KeywordRule] = KEYWORD_ROLES,
    default: str = KEYWORD_DEFAULT,
) -> DataFrame:
    """Dedupe on title, company and city; parse the date; label; tag the skills."""
    kept = dedupe_keep_first(raw, ["job_title", "company", "city"], ordinal)
    labelled = kept.withColumns(
        {
            "post_date_parsed": parse_timestamp_utc(F.col("post_date")),
            "role_category": label_by_keywords(F.col("job_title"), roles, default),
        }
    )
    tagged = tag_flags(labelled, ["job_title", "summary", "body"], skills)
    return tagged.select(*TAGGED_COLUMNS, *flag_names(skills))


def _cleaned(raw: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    present = drop_missing(normalise_columns(raw, headers), ["description_raw", "job_title"])
    cleaned = present.withColumn("description", clean_text(F.col("description_raw")))
    return cleaned.drop("description_raw").withColumn(
        "description_length", text_length(F.col("description"))
    )


def labelled_postings(
    raw: DataFrame,
    ordinal: str,
    headers: Mapping[str, str] = RAW_HEADERS,
    roles: Sequence[PatternRule] = PATTERN_ROLES,
    seniority: Sequence[PatternRule] = SENIORITY_RULES,
    min_chars: int = MIN_DESCRIPTION_CHARS,
) -> DataFrame:
    """Clean, drop short and repeated descriptions, then label and drop the unlabelled.

    The first copy of a description decides its label, so the dedupe stays in front.
    Copies share their length, so short ones may go after the dedupe: in front of it the
    filter would be pushed below the cleaning and clean every text a second time.
    """
    copies = dedupe_keep_first(_cleaned(raw, headers), ["description"], ordinal)
    kept = copies.where(F.col("description_length") >= min_chars)
    title = F.col("job_title")
    labelled = drop_unlabelled(
        kept.withColumn("role_category", label_by_regex(title, roles)), "role_category"
    )
    return labelled.withColumn("seniority", seniority_band(title, seniority)).select(
        *LABELLED_COLUMNS
    )


def stage_report(
    raw: DataFrame,
    ordinal: str,
    headers: Mapping[str, str] = RAW_HEADERS,
    roles: Sequence[PatternRule] = PATTERN_ROLES,
    min_chars: int = MIN_DESCRIPTION_CHARS,
) -> DataFrame:
    """``(stage, rows)``: raw, cleaned, deduplicated, labelled; one shuffle of the texts."""
    copies = (
        _cleaned(raw, headers)
        .groupBy(F.xxhash64("description").alias("_hash"), "description")
        .agg(
            F.count("*").alias("n"),
            F.min_by("job_title", ordinal).alias("job_title"),
            F.max("description_length").alias("length"),
        )
    )
    long_enough = F.col("length") >= min_chars
    label = label_by_regex(F.col("job_title"), roles)
    counts = copies.agg(
        F.coalesce(F.sum(F.when(long_enough, F.col("n"))), F.lit(0)).alias("cleaned"),
        F.count_if(long_enough).alias("deduplicated"),
        F.count_if(long_enough & label.isNotNull()).alias("labelled"),
    )
    return (
        raw.agg(F.count("*").alias("rows"))
        .select(F.lit("raw").alias("stage"), "rows")
        .unionByName(counts.unpivot([], ["cleaned", "deduplicated", "labelled"], "stage", "rows"))
    )

"""Labelling steps on whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.labels import KeywordRule, label_by_keywords
from ..rules import QUESTION_DEFAULT, QUESTION_ROUTES


def drop_unlabelled(df: DataFrame, col: str) -> DataFrame:
    """Rows that carry a label."""
    return df.where(F.col(col).isNotNull())


def mapped_category(col: Column, mapping: Mapping[str, str]) -> Column:
    """Exact lookup; a key outside the mapping fails the job."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    unknown = F.raise_error(
        F.concat(F.lit("category without a mapping: "), F.coalesce(col, F.lit("null")))
    )
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), unknown)


def map_category(df: DataFrame, col: str, mapping: Mapping[str, str], out: str) -> DataFrame:
    """Add ``out``, the mapped category. The mapping is a literal, so nothing is joined."""
    return df.withColumn(out, mapped_category(F.col(col), mapping))


def route_query(
    df: DataFrame,
    col: str,
    rules: Sequence[KeywordRule] = QUESTION_ROUTES,
    default: str = QUESTION_DEFAULT,
    out: str = "category",
) -> DataFrame:
    """Add the category each question is about."""
    return df.withColumn(out, label_by_keywords(F.col(col), rules, default))

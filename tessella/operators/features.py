"""Taxonomy flags and engineered columns."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.regex import FLAGS, fold_case, search
from ..functions.text import extract_first_int, text_length, word_count
from ..rules import DEGREE_PATTERNS, ROLE_TAXONOMY, YEARS_PATTERN, Entry

_LOWER = "_lowered"


def flag_names(taxonomy: Sequence[Entry], prefix: str = "skill_") -> list[str]:
    return [prefix + e.name for e in taxonomy]


def _flags(taxonomy: Sequence[Entry], prefix: str, bounded: bool) -> dict[str, Column]:
    lowered = F.col(_LOWER)
    return {
        prefix + e.name: F.coalesce(search(lowered, e.pattern, bounded), F.lit(False)).cast("int")
        for e in taxonomy
    }


def tag_flags(
    df: DataFrame,
    text_cols: Sequence[str],
    taxonomy: Sequence[Entry],
    prefix: str = "skill_",
    bounded: bool = False,
) -> DataFrame:
    """One 0/1 column per entry over the joined texts; a missing text counts as empty.

    The text is lower-cased once and all flags come from one projection.
    """
    text = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols])
    lowered = df.withColumn(_LOWER, fold_case(text))
    return lowered.withColumns(_flags(taxonomy, prefix, bounded)).drop(_LOWER)


def own_flags(
    df: DataFrame, text_col: str, taxonomy: Sequence[Entry], prefix: str = "skill_"
) -> DataFrame:
    """The flags of each pasted text."""
    return tag_flags(df, [text_col], taxonomy, prefix)


def _total(names: Sequence[str]) -> Column:
    return functools.reduce(operator.add, [F.col(n) for n in names])


def n_hits_total(df: DataFrame, flags: Sequence[str], out: str = "n_skills_total") -> DataFrame:
    """Number of flags set."""
    return df.withColumn(out, _total(flags))


def group_counts(
    df: DataFrame, taxonomy: Sequence[Entry], prefix: str = "skill_"
) -> DataFrame:
    """Number of flags set per taxonomy group, as ``group_<name>_count``."""
    groups: dict[str, list[str]] = {}
    for e in taxonomy:
        groups.setdefault(e.group, []).append(prefix + e.name)
    return df.withColumns(
        {f"group_{g}_count": _total(names).cast("double") for g, names in groups.items()}
    )


def degree_flags(
    df: DataFrame, text_col: str, patterns: Mapping[str, str] = DEGREE_PATTERNS
) -> DataFrame:
    """One 0/1 column per named pattern."""
    lowered = df.withColumn(_LOWER, fold_case(F.coalesce(F.col(text_col), F.lit(""))))
    return lowered.withColumns(
        {name: search(F.col(_LOWER), p).cast("int") for name, p in patterns.items()}
    ).drop(_LOWER)


def taxonomy_features(
    df: DataFrame, text_col: str, taxonomy: Sequence[Entry] = ROLE_TAXONOMY
) -> DataFrame:
    """The flags, their total, and the count per group."""
    flagged = tag_flags(df, [text_col], taxonomy)
    return group_counts(n_hits_total(flagged, flag_names(taxonomy)), taxonomy)


def engineered_features(
    df: DataFrame,
    text_col: str,
    taxonomy: Sequence[Entry] = ROLE_TAXONOMY,
    degrees: Mapping[str, str] = DEGREE_PATTERNS,
    years_pattern: str = YEARS_PATTERN,
) -> DataFrame:
    """All engineered columns of a description; `engineered_names` lists them in order."""
    df = degree_flags(taxonomy_features(df, text_col, taxonomy), text_col, degrees)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.withColumns(
        {
            "years_experience_required": extract_first_int(text, years_pattern),
            "description_length": text_length(text),
            "word_count": word_count(text),
        }
    )


def engineered_names(
    taxonomy: Sequence[Entry] = ROLE_TAXONOMY, degrees: Mapping[str, str] = DEGREE_PATTERNS
) -> list[str]:
    groups = dict.fromkeys(e.group for e in taxonomy)
    return [
        *flag_names(taxonomy),
        "n_skills_total",
        *[f"group_{g}_count" for g in groups],
        *degrees,
        "years_experience_required",
        "description_length",
        "word_count",
    ]


def one_hot(df: DataFrame, col: str, values: Sequence[str], prefix: str) -> DataFrame:
    """One 0/1 column per value, ``<prefix><value>``; a missing category sets none."""
    return df.withColumns(
        {f"{prefix}{v}": F.coalesce(F.col(col) == v, F.lit(False)).cast("int") for v in values}
    )


def strip_label_echo(
    df: DataFrame,
    text_col: str,
    label_col: str,
    phrases: Mapping[str, Sequence[str]],
    out: str,
) -> DataFrame:
    """Blank out, in list order, the phrases listed for the row's own label.

    A label without phrases leaves the text as it is.
    """
    stripped = F.col(text_col)
    chain = F
    for label, patterns in phrases.items():
        text = F.col(text_col)
        for p in patterns:
            text = F.regexp_replace(text, FLAGS + p, " ")
        chain = chain.when(F.col(label_col) == label, text)
    return df.withColumn(out, chain.otherwise(stripped) if phrases else stripped)


def echo_change_count(df: DataFrame, before: str, after: str) -> DataFrame:
    """One row ``(n_changed, n_rows)``."""
    return df.agg(
        F.count_if(~F.col(before).eqNullSafe(F.col(after))).alias("n_changed"),
        F.count("*").alias("n_rows"),
    )


def pattern_inflation(df: DataFrame, text_col: str, terms: Sequence[str]) -> DataFrame:
    """Per term ``(term, unbounded, bounded)``: texts hit without and with word boundaries."""
    lowered = df.select(fold_case(F.coalesce(F.col(text_col), F.lit(""))).alias(_LOWER))
    counts = lowered.agg(
        *[
            F.struct(
                F.lit(t).alias("term"),
                F.count_if(search(F.col(_LOWER), t)).alias("unbounded"),
                F.count_if(search(F.col(_LOWER), t, bounded=True)).alias("bounded"),
            ).alias(f"t{i}")
            for i, t in enumerate(terms)
        ]
    )
    return counts.select(F.inline(F.array(*[f"t{i}" for i in range(len(terms))])))

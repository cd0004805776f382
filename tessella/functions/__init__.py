"""Column functions: text, patterns, labels and dates."""

from .labels import KeywordRule, PatternRule, label_by_keywords, label_by_regex, seniority_band
from .regex import fold_case, search
from .text import (
    clean_text,
    extract_first_int,
    text_length,
    tokens,
    with_bigrams,
    word_count,
)
from .times import parse_timestamp_utc

__all__ = [
    "KeywordRule",
    "PatternRule",
    "clean_text",
    "extract_first_int",
    "fold_case",
    "label_by_keywords",
    "label_by_regex",
    "parse_timestamp_utc",
    "search",
    "seniority_band",
    "text_length",
    "tokens",
    "with_bigrams",
    "word_count",
]

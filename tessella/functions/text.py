"""Column functions on free text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .regex import FLAGS, NOT_SPACE, SPACE, WORD

TOKEN = f"[{WORD}]{{2,}}"


def clean_text(col: Column) -> Column:
    """Drop links, collapse white space (no-break space included) and strip.

    A missing text becomes the empty string. Only runs other than one plain space
    are rewritten, which leaves most of a text untouched.
    """
    text = F.coalesce(col, F.lit(""))
    linkless = F.when(
        text.contains("http"), F.regexp_replace(text, f"http{NOT_SPACE}+", " ")
    ).otherwise(text)
    runs = f"[{SPACE}&&[^ ]][{SPACE}]*| [{SPACE}]+"
    return F.trim(F.regexp_replace(linkless, runs, " "))


def text_length(col: Column) -> Column:
    """Length in code points."""
    return F.length(col).cast("int")


def word_count(col: Column) -> Column:
    """Number of white-space separated words; 0 for an empty text."""
    return F.regexp_count(col, F.lit(f"{NOT_SPACE}+")).cast("int")


def extract_first_int(col: Column, pattern: str, default: int = 0) -> Column:
    """Group 1 of the first match as an integer, or ``default`` without a match."""
    digits = F.regexp_extract(col, FLAGS + pattern, 1)
    return F.coalesce(digits.try_cast("int"), F.lit(default))


def tokens(col: Column, stop_words: Sequence[str] = ()) -> Column:
    """Lower-cased words of two or more characters, stop words removed."""
    words = F.regexp_extract_all(F.lower(col), F.lit(TOKEN), F.lit(0))
    if not stop_words:
        return words
    return F.filter(words, lambda w: ~w.isin(list(stop_words)))


def with_bigrams(col: Column) -> Column:
    """The tokens followed by their adjacent pairs joined by a space."""
    n = F.greatest(F.size(col) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(col, F.lit(1), n),
        F.slice(col, F.lit(2), n),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.concat(col, pairs)

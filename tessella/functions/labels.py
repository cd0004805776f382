"""Ordered rules that turn a short text into one label."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, functions as F

from .regex import fold_case, search


class KeywordRule(NamedTuple):
    """``label`` where every word list in ``all_of`` has at least one substring hit."""

    label: str
    all_of: Sequence[Sequence[str]]


class PatternRule(NamedTuple):
    """``label`` where ``pattern`` is found and ``exclude`` is not."""

    label: str
    pattern: str
    exclude: str | None = None


def _first_match(branches: Sequence[tuple[Column, str]], default: str | None) -> Column:
    chain = F
    for condition, label in branches:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default).cast("string"))


def label_by_keywords(col: Column, rules: Sequence[KeywordRule], default: str) -> Column:
    """First rule whose substrings all occur in the lower-cased text, else ``default``.

    A missing text takes the default.
    """
    lowered = F.lower(col)
    branches = []
    for rule in rules:
        hit = F.lit(True)
        for words in rule.all_of:
            one_of = F.lit(False)
            for word in words:
                one_of = one_of | lowered.contains(word)
            hit = hit & one_of
        branches.append((hit, rule.label))
    return _first_match(branches, default)


def label_by_regex(col: Column, rules: Sequence[PatternRule]) -> Column:
    """First rule found in the text; an excluded rule falls through to the later ones.

    No match, or a missing text, gives null.
    """
    return _by_patterns(fold_case(col), rules)


def _by_patterns(lowered: Column, rules: Sequence[PatternRule]) -> Column:
    branches = []
    for rule in rules:
        hit = search(lowered, rule.pattern)
        if rule.exclude:
            hit = hit & ~search(lowered, rule.exclude)
        branches.append((hit, rule.label))
    return _first_match(branches, None)


def seniority_band(col: Column, rules: Sequence[PatternRule], default: str = "mid") -> Column:
    """Band of a title by the first rule found, else ``default``; the title is only lower-cased."""
    return F.coalesce(_by_patterns(F.lower(col), rules), F.lit(default))

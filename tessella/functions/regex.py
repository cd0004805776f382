"""Search patterns written for Python's ``re`` as Spark columns.

Texts are searched lower-cased. Most taxonomy entries are plain words, so an
alternation of literals becomes ``contains`` calls; only what needs a regex engine
goes through ``rlike``, behind a ``contains`` guard where the core is literal.
"""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column, functions as F

# White space as Python's str methods and ``\s`` see it, as a character class body.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# All other characters, printable ASCII first and the others as one inner class: Java tests in this
# order and reaches the first of many ranges through a call for each. A negated class
# would walk through every white-space range for each letter.
NOT_SPACE = (
    r"[!-~[\xa1-\x{167f}\x{1681}-\x{1fff}\x{200b}-\x{2027}\x{202a}-\x{202e}\x{2030}-\x{205e}"
    r"\x{2060}-\x{2fff}\x{3001}-\x{10ffff}\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f]]"
)
# Letters, digits and underscore as Python's ``\w`` sees them.
WORD = r"\p{L}\p{N}_"
# Case-insensitive, Unicode-aware matching in Java's engine.
FLAGS = "(?iuU)"

_META = set(".^$*+?{}[]()|")


def fold_case(col: Column) -> Column:
    """Lower-case, with the two letters ``re.I`` treats as plain i and s folded too."""
    return F.replace(F.replace(F.lower(col), F.lit("ı"), F.lit("i")), F.lit("ſ"), F.lit("s"))


def literal_of(pattern: str) -> str | None:
    """The text a pattern stands for when it holds no regex operator, else None."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            if i + 1 == len(pattern) or pattern[i + 1].isalnum():
                return None
            ch, i = pattern[i + 1], i + 1
        elif ch in _META:
            return None
        out.append(ch)
        i += 1
    return "".join(out)


def spellings(pattern: str, most: int = 16) -> list[str] | None:
    """All texts that a pattern of literals and optional single literals stands for, else None."""
    out = [""]
    for piece in re.findall(r"(?:\\[^a-zA-Z0-9]|[^\\])\??|\\.?", pattern, re.S):
        literal = literal_of(piece.removesuffix("?") if len(piece) > 1 else piece)
        if literal is None or len(out) > most:
            return None
        out = [o + x for o in out for x in ((literal, "") if len(piece) > 1 and piece.endswith("?") and piece != r"\?" else (literal,))]
    return out


def alternatives(pattern: str) -> list[str]:
    """Top-level alternatives; a pattern with groups or classes is kept whole."""
    if re.search(r"[(\[]", pattern):
        return [pattern]
    return re.split(r"(?<!\\)\|", pattern)


def _search_one(lowered: Column, pattern: str) -> Column:
    literal = literal_of(pattern)
    if literal is not None:
        return lowered.contains(literal.lower())
    found = lowered.rlike(FLAGS + pattern)
    cores = spellings(re.sub(r"^\\b|\\b$", "", pattern))
    if not cores or "" in cores:
        return found
    return functools.reduce(operator.or_, [lowered.contains(c.lower()) for c in cores]) & found


def search(lowered: Column, pattern: str, bounded: bool = False) -> Column:
    """True where ``pattern`` is found in a text already passed through `fold_case`.

    ``bounded`` asks for word boundaries on both sides of every alternative.
    """
    parts = alternatives(pattern)
    if bounded:
        parts = [rf"\b{p.removeprefix(chr(92) + 'b').removesuffix(chr(92) + 'b')}\b" for p in parts]
    return functools.reduce(operator.or_, [_search_one(lowered, p) for p in parts])

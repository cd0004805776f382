"""Offset-preserving deobfuscation: personal data in plain and disguised form."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .registry import query, table

KINDS = ["email", "ip", "card", "phone"]
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match that starts inside a run of digits would also start at the run's head.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, str, int]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """(start, kind, end) of all identifiers written plainly, leftmost and non-overlapping per kind."""
    found, last = [], 0
    for at in _DOMAIN.finditer(text) if "@" in text else ():
        head = text[last : at.start()].rpartition("@")[2]
        local = len(head) - len(head.rstrip(_LOCAL))
        if local:
            found.append((at.start() - local, "email", at.end()))
            last = at.end()
    for m in _IP.finditer(text):
        if all(len(part := p.lstrip("0")) < 4 and int(part or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), "ip", m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NO_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), "card", m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), "phone", m.end()))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


# Letters of other scripts that look like an ASCII letter.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "һ": "h", "ԛ": "q", "ԝ": "w", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i",
    "κ": "k", "τ": "t", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M",
    "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "․": ".", "。": ".", "·": ".", "‐": "-",
    "‑": "-", "‒": "-", " ": " ", " ": " ", " ": " ",
}
# Characters without width.
UNSEEN = "­​‌‍⁠﻿"
# Digits as they are spelled, from 0, in the languages of the texts.
SPELLED = [
    "zero one two three four five six seven eight nine",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
]


def _variants() -> dict[str, str]:
    """Look-alikes, and every wide, styled, circled or national form of an ASCII character, by its decomposition."""
    found = dict(LOOKALIKES)
    for first, last in ((0x2460, 0x2468), (0xFE50, 0xFE6B), (0xFF01, 0xFF5E), (0x1D400, 0x1D7FF)):
        for code in range(first, last + 1):
            plain = unicodedata.normalize("NFKC", chr(code))
            if len(plain) == 1 and " " < plain < "\x7f":
                found[chr(code)] = plain
    for code in range(0x80, 0x3000):
        if (value := unicodedata.decimal(chr(code), None)) is not None:
            found[chr(code)] = str(value)
    return found | dict.fromkeys(UNSEEN, "")


_PLAIN = _variants()
_ODD_LATIN = [c for c in _PLAIN if c <= "\xff"]


def _class(chars: list[str]) -> str:
    """A character class of ranges; long lists of single characters would be slow to search."""
    codes, spans = sorted(map(ord, chars)), []
    for code in codes:
        if spans and code == spans[-1][1] + 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans) + "]"


# Characters of the first plane and the others apart: only the first have a fast table.
_ODD = re.compile("|".join(_class([c for c in _PLAIN if (c > "\uffff") == high]) for high in (False, True)))


def _has_odd(text: str) -> bool:
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _ODD.search(text) is not None
    return any(c in text for c in _ODD_LATIN)
_DIGIT = {w: str(i) for line in SPELLED for i, w in enumerate(line.split())}
_OPEN, _CLOSE = r"\s{0,3}[(\[{<]\s{0,3}", r"\s{0,3}[)\]}>]\s{0,3}"
_AT, _DOT = "(?:at|arobase|arroba|klammeraffe|@)", r"(?:dot|point|punkt|punto|\.)"
_BARE_AT = r"(?:\s{1,3}(?:at|arobase|arroba|klammeraffe)\s{1,3}|_at_|\s{1,3}@\s{1,3})"
_LABEL = "[a-z0-9-]++"
_BRACKET_DOT = rf"{_OPEN}{_DOT}{_CLOSE}"
_WORD_DOT = r"\s{1,3}(?:dot|punkt|punto)\s{1,3}"
#: Dots that can be nothing else, and those that may also end a sentence.
_SURE_DOT = rf"(?:{_BRACKET_DOT}|{_WORD_DOT}|_dot_)"
_LOOSE_DOT = r"(?:\s{1,3}point\s{1,3}|\s{1,3}\.\s{0,3}(?=[a-z]))"
_BARE_DOT = rf"(?:{_WORD_DOT}|_dot_|{_LOOSE_DOT})"
#: Labels to the end of a domain, however many; after a plain dot a loose one is the end of a sentence.
_LABELS = rf"{_LABEL}(?:(?:{_SURE_DOT}|{_LOOSE_DOT}){_LABEL})*+(?:(?:{_SURE_DOT}|\.){_LABEL})*+"
#: at in brackets, then any kind of dots; or a bare at, then a disguised dot; or a plain at.
_ADDRESS = re.compile(
    rf"(?:(?<=[a-z0-9])(?:{_OPEN}{_AT}{_CLOSE})(?P<a>{_LABELS}))"
    rf"|(?:(?<=[a-z0-9])(?:{_BARE_AT})(?P<b>{_LABEL}(?:(?:{_BRACKET_DOT}|{_BARE_DOT}){_LABEL})++(?:(?:{_SURE_DOT}|\.){_LABEL})*+))"
    rf"|(?:@(?P<c>{_LABEL}(?:(?:{_BRACKET_DOT}|{_WORD_DOT}|\.){_LABEL})*+))"
)
_ANY_DOT = re.compile(rf"{_SURE_DOT}|{_LOOSE_DOT}|\.")
_DOTS = re.compile(rf"{_BRACKET_DOT}|{_BARE_DOT}")
#: A disguised dot of a local part, at the end of what is searched; none is longer than 24 characters.
_LOCAL_DOT, _LOCAL_DOT_LENGTH = re.compile(rf"(?<=[a-z0-9])(?:{_BRACKET_DOT}|{_WORD_DOT}|_dot_)\Z"), 24
_LOCAL_LOW = frozenset("abcdefghijklmnopqrstuvwxyz0123456789%+.-")
_LOCAL_ALL = _LOCAL_LOW | {"_"}
#: A bare at before a plain domain counts only after a local part with a dot, a digit or the like.
_SOFT_AT = [
    (word, re.compile(rf"{word}\s{{1,3}}(?={_LABEL}\.{_LABEL})")) for word in ("at", "arobase", "arroba", "klammeraffe", "@")
]
_BRACKET_AT = re.compile(rf"[(\[{{<]\s{{0,3}}{_AT}\s{{0,3}}[)\]}}>]")
_ADDRESS_LIKE = re.compile(r"[0-9._%+-]")
_IP_DOTS = re.compile(
    rf"(?<![0-9])[0-9]++(?:(?:{_BRACKET_DOT}|\s{{1,3}}(?:dot|point|punkt|punto)\s{{1,3}}|\.)[0-9]++){{3}}"
)
_WORD = "(?:" + "|".join(sorted(_DIGIT, key=len, reverse=True)) + ")"
_ITEM = rf"(?:{_WORD}\b|(?<![0-9])[0-9]++)"
#: A spelled digit and three more, spelled or not, next to each other; commas, hyphens and dots between them.
_NUMBER = re.compile(
    rf"(?:(?:plus[\s-]{{1,3}}|\+\s?)?{_ITEM}(?:(?:[\s,-]{{1,3}}|\s{{1,3}}(?:dot|point|punkt|punto)\s{{1,3}}){_ITEM}){{3,}})"
)
_SPELLED = re.compile(rf"{_WORD}\b")
_SPELLED_WORDS = frozenset(_DIGIT)
_PART = re.compile(rf"{_WORD}\b|[0-9]+|plus|\+|dot|point|punkt|punto")
#: A run of digits and signs with some letters O, I or l for digits; what counts of it is cut in `_lettered`.
_LETTERED = re.compile(r"(?<![A-Za-z0-9])[+0-9(][0-9OoIl().\x20-]++")
_FOR_DIGIT = {"O": "0", "o": "0", "I": "1", "l": "1"}
# Cheap signs that a search may find something.
_AT_HINTS = ["@", " at ", "_at_", "arobase", "arroba", "klammeraffe"]
_DOT_HINTS = [" dot ", "_dot_", "(dot", "[dot", "{dot", "<dot", "point", "punkt", "punto", "[.", "(.", "{.", "<.", "( ", "[ ", "{ ", " ."]
_STOPS = ",-.;:)!?\n\t"


def _spells(low: str) -> bool:
    for c in _STOPS:
        low = low.replace(c, " ")
    return not _SPELLED_WORDS.isdisjoint(low.split(" "))


def _lowered(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


Piece = tuple[int, int, int, int]


def _source(at: int, end: bool, changed: list[Piece], starts: list[int]) -> int:
    """Source offset of a normalised one; an edge inside a changed piece takes the whole piece."""
    i = bisect_right(starts, at - 1 if end else at) - 1
    if i < 0:
        return at
    t0, t1, s0, s1 = changed[i]
    if end:
        return s1 if at <= t1 else s1 + at - t1
    return s0 if at < t1 else s1 + at - t1


def _composed(first: list[Piece], second: list[Piece]) -> list[Piece]:
    """The pieces of both steps, from the second's text to the first's source; a piece of the first within one of the second goes into it."""
    if not first or not second:
        return second or first
    starts, out, i, shift = [c[0] for c in first], [], 0, 0
    for t0, t1, m0, m1 in second:
        while i < len(first) and first[i][1] <= m0:
            a, b, s0, s1 = first[i]
            out.append((a + shift, b + shift, s0, s1))
            i += 1
        while i < len(first) and first[i][0] < m1:
            i += 1
        out.append((t0, t1, _source(m0, False, first, starts), _source(m1, True, first, starts)))
        shift = t1 - m1
    return out + [(a + shift, b + shift, s0, s1) for a, b, s0, s1 in first[i:]]


def transduce(text: str) -> tuple[str, list[Piece]]:
    """The normalised text and the pieces that changed: (start, end) there and (start, end) here.

    Characters are normalised first, words and signs in what that gives.
    """
    changed: list[Piece] = []
    if _has_odd(text):
        text, changed = _rewritten(text, [(m.start(), m.end(), _PLAIN[m[0]]) for m in _ODD.finditer(text)])
    normal, more = _rewritten(text, _disguises(text))
    return normal, _composed(changed, more)


def _run_start(low: str, floor: int, end: int, chars: frozenset[str]) -> int:
    """Where the run of ``chars`` that stops at ``end`` starts, not before ``floor``."""
    while end > floor and low[end - 1] in chars:
        end -= 1
    return end


def _local_dots(low: str, floor: int, end: int) -> Iterator[tuple[int, int]]:
    """The disguised dots of the local part that stops at ``end``, from the last one back to its start."""
    while True:
        at = _run_start(low, floor, end, _LOCAL_LOW)
        dot = None
        while at < end and not (dot := _LOCAL_DOT.search(low, max(floor, at - _LOCAL_DOT_LENGTH), at)):
            if at == floor or low[at - 1] != "_":
                return
            at = _run_start(low, floor, at - 1, _LOCAL_LOW)
        if not dot:
            return
        yield dot.span()
        end = dot.start()


def _lettered(text: str) -> Iterator[tuple[int, int]]:
    """Numbers of ten characters or more, seven of them digits, in which letters may stand for digits."""
    for m in _LETTERED.finditer(text):
        run = m[0]
        if text[m.end() : m.end() + 1].isalpha() and text[m.end()].isascii():
            run = run.rstrip("0123456789OoIl")  # the end of the run starts a word
        run = run.rstrip("(). -")
        if len(run) >= 10 and sum(map(run.count, "0123456789")) >= 7:
            yield m.start(), m.start() + len(run)


def _disguises(text: str) -> list[tuple[int, int, str]]:
    """Spelled and lettered digits and disguised at and dot signs: start, end and what they stand for."""
    pieces: list[tuple[int, int, str]] = []
    low = _lowered(text)
    for m in _NUMBER.finditer(low) if _spells(low) else ():
        if m.start() and low[m.start() - 1].isalnum() or not _SPELLED.search(m[0]):
            continue
        at = m.start()
        for p in _PART.finditer(low, m.start(), m.end()):
            between = low[at : p.start()]
            word = _DIGIT.get(p[0]) or (p[0] if p[0].isdigit() else "+" if p[0] in ("plus", "+") else ".")
            # Blanks and commas between the digits go; hyphens stay.
            pieces.append((at, p.end(), ("-" if "-" in between else "") + word))
            at = p.end()
    for start, end in _lettered(text):
        pieces += [(i, i + 1, _FOR_DIGIT[text[i]]) for i in range(start, end) if text[i] in _FOR_DIGIT]
    dots = any(hint in low for hint in _DOT_HINTS)
    if dots and any(hint in low for hint in _AT_HINTS) or _BRACKET_AT.search(low):
        floor = 0
        for m in _ADDRESS.finditer(low):
            domain = m.lastgroup
            if not _ANY_DOT.search(low, m.start(domain), m.end(domain)):
                continue
            if domain != "c":
                pieces.append((m.start(), m.start(domain), "@"))
            pieces += [(a, b, ".") for a, b in _local_dots(low, floor, m.start())]
            pieces += [(d.start(), d.end(), ".") for d in _DOTS.finditer(low, m.start(domain), m.end(domain))]
            floor = m.end()
    for m in _IP_DOTS.finditer(low) if dots else ():
        pieces += [(d.start(), d.end(), ".") for d in _DOTS.finditer(low, m.start(), m.end())]
    for word, pattern in _SOFT_AT:
        floor = 0
        for m in pattern.finditer(low) if word in low else ():
            end = m.start()
            while end > floor and m.start() - end < 4 and low[end - 1].isspace():
                end -= 1
            if 0 < m.start() - end < 4:
                start = _run_start(low, floor, end, _LOCAL_ALL)
                if _ADDRESS_LIKE.search(low, start, end):
                    pieces.append((end, m.end(), "@"))
            floor = m.end()
    return pieces


def _rewritten(text: str, pieces: list[tuple[int, int, str]]) -> tuple[str, list[Piece]]:
    """``text`` with its pieces replaced, the first of those that overlap, and the pieces that changed."""
    if not pieces:
        return text, []
    out, changed, here, there = [], [], 0, 0
    for start, end, new in sorted(pieces):
        if start < here:
            continue  # within a piece that was rewritten already
        out.append(text[here:start])
        there += start - here
        out.append(new)
        changed.append((there, there + len(new), start, end))
        there, here = there + len(new), end
    out.append(text[here:])
    return "".join(out), changed


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and the spans that only the normalised text shows, in the text's own offsets."""
    plain = plain_spans(text)
    normal, changed = transduce(text)
    if not changed:
        return plain, []
    starts, added, known = [c[0] for c in changed], [], set(plain)

    for start, kind, end in plain_spans(normal):
        lo = bisect_right(starts, start)
        if not (lo < len(starts) and starts[lo] < end or lo and changed[lo - 1][1] > start):
            continue  # nothing in it was disguised
        span = (_source(start, False, changed, starts), kind, _source(end, True, changed, starts))
        if span not in known:
            added.append(span)
    return plain, added


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in sorted(spans, key=lambda x: (x[0], KINDS.index(x[1]), x[2])))


_FIELDS = [f"n_{k}" for k in KINDS] + ["n_disguised"]


_FOUND_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in _FIELDS) + ",base:string,spans:string>"


def _found(texts: pa.Array) -> pa.Array:
    numbers, bases, spans = [], [], []
    for text in texts.to_pylist():
        plain, added = all_spans(text or "")
        numbers.append([sum(k == kind for _, k, _ in plain) for kind in KINDS] + [len(added)])
        bases.append(_joined(plain))
        spans.append(_joined(plain + added))
    columns = list(zip(*numbers, strict=True)) or [()] * len(_FIELDS)
    return pa.StructArray.from_arrays(
        [pa.array(c, pa.int64()) for c in columns] + [pa.array(bases, pa.string()), pa.array(spans, pa.string())],
        [*_FIELDS, "base", "spans"],
    )


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data in every whole text: plain spans and those behind a disguise.

    A text is searched twice: as it is, and after transducers have normalised look-alike
    characters, spelled digits and disguised at and dot signs. Spans of the second search
    that hold something normalised are mapped back to the characters they came from. Local
    parts, domains and numbers are taken whole, of any length and number of labels.

    Returns doc_id, n_email, n_ip, n_card, n_phone (plain spans), n_disguised (added
    spans), base (plain spans as kind:start:end in code points, end exclusive, by start, then kind, comma-joined)
    and spans (all of them). Null and empty texts have none; each row is judged on its
    own, repeated rows alike; an empty table gives no rows. Where two pieces of a disguise
    overlap, the one that starts first counts, then the shorter. A text of any length is searched whole,
    in time that grows with its length. Other columns are ignored.
    """
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.arrow_udf(_found, _FOUND_TYPE).asNondeterministic()(F.col(f"`{text_col}`")).alias("f"))
    return found.select("doc_id", "f.*")


@query()
def op2_pii_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest of the plain spans, and all spans of every document."""
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_disguised", F.sha2("base", 256).alias("base_sha256"), "spans"
    )

"""Fill-in-middle transformation: documents as piece tables over a text and a sentinel buffer."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .registry import query, table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = PREFIX + SUFFIX + MIDDLE
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: The sections of each form in the order of its output, each after its sentinel.
ORDER = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
#: Hundredths of the documents that are cut, and of those that have the suffix first.
CUT, SUFFIX_FIRST = 90, 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


class Piece(NamedTuple):
    """A descriptor: a range of one of the immutable buffers. Bytes are never moved."""

    buffer: bytes
    start: int
    end: int


def cut(piece: Piece, *places: int) -> list[Piece]:
    """The pieces of ``piece`` between its start, the ``places`` in its buffer, and its end."""
    edges = [piece.start, *places, piece.end]
    return [Piece(piece.buffer, a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def streamed(pieces: Iterable[Piece]) -> Iterator[memoryview]:
    """The bytes the descriptors stand for, without a copy of the whole."""
    for buffer, start, end in pieces:
        yield memoryview(buffer)[start:end]


def digest(pieces: Iterable[Piece]) -> str:
    """SHA-256 of the bytes the descriptors stand for, in hex."""
    total = sha256()
    for part in streamed(pieces):
        total.update(part)
    return total.hexdigest()


def _mark(name: bytes) -> Piece:
    at = MARKS.index(name)
    return Piece(MARKS, at, at + len(name))


def arranged(sections: dict[bytes, Piece], form: str) -> list[Piece]:
    """The sections in the order of ``form``, each behind its sentinel."""
    return [piece for name in ORDER[form] for piece in (_mark(name), sections[name])]


def restored(output: bytes, form: str) -> list[Piece]:
    """The pieces of an output, put back into the order of the text.

    A sentinel is found where it stands first: no section holds one, and no part of one
    can join with a text to make another.
    """
    if form == PLAIN:
        return [Piece(output, 0, len(output))]
    first, second, third = ORDER[form]
    a = len(first)
    b = output.index(second, a)
    c = output.index(third, b + len(second))
    sections = {
        first: Piece(output, a, b),
        second: Piece(output, b + len(second), c),
        third: Piece(output, c + len(third), len(output)),
    }
    return [sections[name] for name in (PREFIX, MIDDLE, SUFFIX)]


def draws(doc_id: int | None, salt: str = "1") -> list[int]:
    """Four 32-bit numbers that the id and the salt decide."""
    found = sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(found[i : i + 4], "big") for i in range(0, 16, 4)]


def transformed(text: bytes, numbers: list[int], rate: int = CUT, suffix_first: int = SUFFIX_FIRST):
    """Token count, form, characters of prefix and middle, and the pieces of the output.

    A token is a run of ASCII letters or one other character, so its start is a lead byte
    that doesn't follow a letter as a letter.
    """
    data = np.frombuffer(text, np.uint8)
    lead, letter = (data & 0xC0) != 0x80, _LETTER[data]
    lead_and_first = lead.copy()
    lead_and_first[1:] &= ~(letter[1:] & letter[:-1])
    starts = np.flatnonzero(lead_and_first)
    n, whole = len(starts), Piece(text, 0, len(text))
    if not text or any(m in text for m in ORDER[PSM]) or numbers[2] % 100 >= rate:
        return n, PLAIN, None, None, [whole]
    places = [int(starts[i]) if i < n else len(text) for i in sorted(x % (n + 1) for x in numbers[:2])]
    form = SPM if numbers[3] % 100 < suffix_first else PSM
    sections = dict(zip((PREFIX, MIDDLE, SUFFIX), cut(whole, *places), strict=True))
    chars = [int(np.count_nonzero(lead[p.start : p.end])) for p in (sections[PREFIX], sections[MIDDLE])]
    return n, form, *chars, arranged(sections, form)


def _transform(rate: int, suffix_first: int, salt: str, outputs: bool):
    fields = ["n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256"]

    def run(ids: pa.Array, texts: pa.Array) -> pa.Array:
        rows = []
        for doc_id, text in zip(ids.to_pylist(), texts, strict=True):
            raw = text.as_buffer()
            raw = raw.to_pybytes() if raw is not None else b""
            n, form, prefix, middle, pieces = transformed(raw, draws(doc_id, salt), rate, suffix_first)
            output = b"".join(streamed(pieces))
            back = digest(restored(output, form))
            rows.append((n, form, prefix, middle, output if outputs else None, digest(pieces), back))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string()]
        columns = list(zip(*rows, strict=True)) or [()] * len(fields)
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], fields)

    kind = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:binary,output_sha256:string,restored_sha256:string>"
    return F.arrow_udf(run, kind).asNondeterministic()


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: int = CUT,
    suffix_first: int = SUFFIX_FIRST,
    salt: str = "1",
    outputs: bool = True,
) -> DataFrame:
    """Every whole text cut into prefix, middle and suffix and put in fill-in-middle order.

    A text becomes one descriptor over its immutable bytes; cutting splits it at token
    starts that the id decides, arranging permutes the pieces between descriptors over the
    sentinel buffer, and the digest streams them. The inverse permutation is read from the
    output alone. ``rate`` hundredths of the documents are cut, ``suffix_first``
    hundredths of those have the suffix first.

    Returns doc_id, n (tokens), form (plain, psm or spm), prefix_chars, middle_chars (code
    points, null if plain), output (null without ``outputs``), output_sha256 and
    restored_sha256, one row for each row. Null and empty texts and those that hold a
    sentinel are plain; a null id draws as an empty one; repeated rows are cut alike; an
    empty table gives no rows. A row is held whole in one task, with a few bytes for each
    of its own, and nothing else is; other columns are ignored.
    """
    run = _transform(rate, suffix_first, salt, outputs)
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), run(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("f"))
    return found.select("doc_id", "f.*").withColumn("output", F.col("output").cast("string"))


def restore_texts(outputs: DataFrame, output_col: str = "output", form_col: str = "form", to: str = "text") -> DataFrame:
    """Add the exact text behind each output of `fill_in_middle`; a null output has none."""

    def run(parts: pa.Array, forms: pa.Array) -> pa.Array:
        pairs = zip(parts.cast(pa.binary()).to_pylist(), forms.to_pylist(), strict=True)
        return pa.array([None if p is None else b"".join(streamed(restored(p, f))) for p, f in pairs], pa.binary())

    back = F.arrow_udf(run, "binary")(F.col(f"`{output_col}`"), F.col(f"`{form_col}`"))
    return outputs.withColumn(to, back.cast("string"))


@query("""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS x,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w FROM documents),
d AS (
  SELECT doc_id, t, w, len(w) AS n, ('0x' || substr(x, 1, 8))::BIGINT % (len(w) + 1) AS a,
    ('0x' || substr(x, 9, 8))::BIGINT % (len(w) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      OR ('0x' || substr(x, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
      WHEN ('0x' || substr(x, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT doc_id, t, n, form, array_to_string(w[1:least(a, b)], '') AS pre,
    array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS mid, array_to_string(w[greatest(a, b) + 1:], '') AS suf FROM d)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p""")
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, sizes and digests of every document's fill-in-middle output."""
    return fill_in_middle(table(spark, sf_dir, "documents"), outputs=False).drop("output")

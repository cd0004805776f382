"""Words of a text and their hashes, as arrays; the small helpers that tasks run on each row.

Words are the ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes. A word's hash is a polynomial in
random 64-bit values of its bytes, so equal words have equal hashes on every machine, and
all words of a text are hashed by one running sum.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_PIECE = 1 << 22  # bytes hashed at once; longer texts go piece by piece, cut at white space


def texts_of(column: pa.Array, step: int = 256) -> Iterator[bytes | None]:
    """The UTF-8 texts of a column, a few copied out of Arrow at a time."""
    for at in range(0, len(column), step):
        yield from column.slice(at, step).cast(pa.binary()).to_pylist()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
#: Separators of the looser words: every ASCII byte that is no letter or digit.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)])
_BYTES_LOWER = _BYTES[_LOWER]
_STEP = 0x5851F42D4C957F2D
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the step and of its inverse, modulo 2**64."""
    if len(_powers["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _STEP), ("down", pow(_STEP, -1, 1 << 64))):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            _powers[name] = np.multiply.accumulate(run)
    return _powers["up"], _powers["down"]


def spans(data: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~blank[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_hashes(text: bytes, lower: bool = False, blank: np.ndarray = BLANK) -> np.ndarray:
    """A 64-bit hash for each word of ``text``, in order."""
    found, at = [], 0
    while at < len(text):
        end = len(text)
        if end - at > _PIECE and (cut := _BLANK.search(text, at + _PIECE)):
            end = cut.start()
        data = np.frombuffer(text, np.uint8, end - at, at)
        starts, ends = spans(data, blank)
        up, down = _power(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_BYTES_LOWER if lower else _BYTES)[data] * down[: len(data)], out=sums[1:])
        found.append(_mix((sums[ends] - sums[starts]) * up[ends]))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; none if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * np.uint64(_STEP) + hashes[i : i + n]
    return _mix(total + np.uint64(size))


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """Sorted distinct shingles of the lower-cased words; a shorter text is one shingle."""
    hashes = word_hashes(text, lower=True)
    return np.unique(windows(hashes, min(size, len(hashes)))) if len(hashes) else hashes

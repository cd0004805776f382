"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from heapq import heappop, heappush
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .registry import query, table
from .words import MARKS, texts_of, windows, word_hashes

#: A leak is an item of which this share is covered by tiles of this many words or more.
SHARE, LEAST = 0.5, 5
BLOCK_MB = 8
#: Pairs of equal windows a task holds at once.
PAIRS = 1 << 19
_BITS = 20
_LEAKS_TYPE = "array<struct<item:int,covered:int,tiles:int>>"


def tokens(text: bytes | None) -> np.ndarray:
    """Hashes of the lower-cased words; ASCII punctuation only separates them."""
    return word_hashes(text or b"", lower=True, blank=MARKS)


def runs_of(pairs: np.ndarray) -> np.ndarray:
    """(item start, text start, windows) of the pairs that follow each other on a diagonal."""
    order = np.lexsort((pairs[:, 0], pairs[:, 1] - pairs[:, 0]))
    i, j = pairs[order, 0], pairs[order, 1]
    heads = np.r_[0, np.flatnonzero((np.diff(i) != 1) | (np.diff(j) != 1)) + 1]
    return np.stack([i[heads], j[heads], np.diff(np.r_[heads, len(i)])], 1)


def tile(runs: np.ndarray, n_item: int, n_text: int, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, text start, length) from runs of equal windows of ``least`` words.

    A run is one match. The longest match is marked; what is left of a match that overlaps
    a mark goes back while it has ``least`` words. Of equal ones the first in the item, then
    in the text, is marked.
    """
    order = np.lexsort((runs[:, 1], runs[:, 0], -runs[:, 2]))
    listed = ((-(n + least - 1), a, b) for a, b, n in map(np.ndarray.tolist, runs[order]))
    rest: list[tuple[int, int, int]] = []
    head = next(listed, None)
    item, text, tiles = np.zeros(n_item, bool), np.zeros(n_text, bool), []
    while head or rest:
        if rest and (head is None or rest[0] < head):
            size, a, b = heappop(rest)
        else:
            (size, a, b), head = head, next(listed, None)
        size = -size
        free = ~(item[a : a + size] | text[b : b + size])
        if free.all():
            item[a : a + size] = text[b : b + size] = True
            tiles.append((a, b, size))
            if item.all():
                break
            continue
        if np.count_nonzero(free) < least:
            continue
        edges = np.diff(np.r_[0, free.astype(np.int8), 0])
        for s, e in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
            if e - s >= least:
                heappush(rest, (-(e - s), a + s, b + s))
    return tiles


class Seeds:
    """All windows of a block of benchmark items, sorted by hash, behind a bit map; shorter items whole."""

    def __init__(self, texts: list[bytes], least: int) -> None:
        self.least, lists = least, [tokens(t) for t in texts]
        self.sizes = [len(t) for t in lists]
        found = [windows(t, least) for t in lists]
        self.natural = np.concatenate([*found, np.zeros(0, np.uint64)])
        owners = np.repeat(np.arange(len(found)), [len(f) for f in found])
        places = np.concatenate([*[np.arange(len(f)) for f in found], np.zeros(0, np.int64)])
        self.order = np.argsort(self.natural, kind="stable")
        self.hashes, self.owners, self.places = self.natural[self.order], owners[self.order], places[self.order]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[self.hashes >> np.uint64(64 - _BITS)] = True
        self.short: dict[bytes, list[int]] = {}
        for i, words in enumerate(lists):
            if 0 < len(words) < least:
                self.short.setdefault(words.tobytes(), []).append(i)

    def _edges(self, found: np.ndarray, at: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, item place, text place) of the first and of the last pair of each run, both in the runs' order.

        A pair is inside a run if the windows before and behind it are equal as well, so
        pairs are made some at a time and only the edges are kept.
        """
        edges = ([], [])
        ends = np.cumsum(n)
        start = 0
        while start < len(at):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, "right")))
            k = n[start:stop]
            row = np.repeat(lo[start:stop], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            where, owner, place, home = np.repeat(at[start:stop], k), self.owners[row], self.places[row], self.order[row]
            windows_of = np.asarray(self.sizes)[owner] - self.least + 1
            before = (place > 0) & (where > 0)
            before[before] = self.natural[home[before] - 1] == found[where[before] - 1]
            behind = (place + 1 < windows_of) & (where + 1 < len(found))
            behind[behind] = self.natural[home[behind] + 1] == found[where[behind] + 1]
            for kept, inner in zip(edges, (before, behind), strict=True):
                kept.append(np.stack([owner[~inner], place[~inner], where[~inner]], 1))
            start = stop
        both = [np.concatenate(e) for e in edges]
        return tuple(e[np.lexsort((e[:, 1], e[:, 2] - e[:, 1], e[:, 0]))] for e in both)

    def matches(self, text: bytes | None, share: float) -> list[tuple[int, int, int]]:
        """(item, words covered, tiles) of the items of which ``text`` holds ``share`` or more."""
        words = tokens(text)
        if len(words) < self.least:
            return [(i, len(words), 1) for i in self.short.get(words.tobytes(), [])]
        found = windows(words, self.least)
        at = np.flatnonzero(self.seen[found >> np.uint64(64 - _BITS)])
        lo, hi = np.searchsorted(self.hashes, found[at], "left"), np.searchsorted(self.hashes, found[at], "right")
        at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        if not len(at):
            return []
        first, last = self._edges(found, at, lo, n)
        runs = np.stack([first[:, 1], first[:, 2], last[:, 1] - first[:, 1] + 1], 1)
        cuts = np.flatnonzero(np.diff(first[:, 0])) + 1
        out = []
        for own in np.split(np.arange(len(runs)), cuts):
            item, mine = int(first[own[0], 0]), runs[own]
            steps = np.zeros(self.sizes[item] + 1, np.int64)
            np.add.at(steps, mine[:, 0], 1)
            np.add.at(steps, mine[:, 0] + mine[:, 2] + self.least - 1, -1)
            if np.count_nonzero(np.cumsum(steps)) < share * self.sizes[item]:
                continue  # no tiling covers more than all its seeds do
            tiles = tile(mine, self.sizes[item], len(words), self.least)
            total = sum(t[2] for t in tiles)
            if total >= share * self.sizes[item]:
                out.append((item, total, len(tiles)))
        return out


def _leaks_of(shared, share: float):
    """A function of texts: their matches with the items of one block."""

    def leaks(texts: pa.Array) -> pa.Array:
        seeds = Seeds.__new__(Seeds)
        seeds.__dict__.update(shared.value)
        found = [seeds.matches(t, share) for t in texts_of(texts)]
        kind = pa.list_(pa.struct([("item", pa.int32()), ("covered", pa.int32()), ("tiles", pa.int32())]))
        return pa.array([[dict(zip(("item", "covered", "tiles"), m, strict=True)) for m in f] for f in found], kind)

    return F.arrow_udf(leaks, _LEAKS_TYPE).asNondeterministic()


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str, least: int, block_mb: int):
    """The benchmark in blocks of about ``block_mb`` MB of text: (ids, seeds) one by one."""
    items = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text")).where(
        "text IS NOT NULL"
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, ceil(total / (block_mb << 20)))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield [r[0] for r in rows], Seeds([r[1].encode() for r in rows], least)


def benchmark_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    share: float = SHARE,
    least: int = LEAST,
    block_mb: int = BLOCK_MB,
) -> DataFrame:
    """(doc_id, item_id, covered, item_words, coverage, tiles) of the documents that hold a benchmark item.

    A document holds an item if greedy string tiling with tiles of ``least`` words or more
    covers ``share`` or more of the item's words, in whatever order its parts come. Words
    are lower-cased and stripped of punctuation. The benchmark is sent to the tasks in
    blocks of about ``block_mb`` MB of text, whatever its size; every document is scanned
    against each block, without a shuffle.

    An item of fewer than ``least`` words has no tile and is compared whole: a document
    holds it if it has just these words. Null and empty texts match nothing. Repeated
    documents each give their rows; repeated items are reported each. Of equally long
    matches the first in the item is marked. A text of any length is compared whole; a
    task holds its words, its longest matches and ``PAIRS`` pairs of equal windows.
    Without documents or items there are no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    item_type = benchmark.schema[item_col].dataType.simpleString()
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    result = None
    for item_ids, seeds in _blocks(benchmark, item_col, item_text_col, least, block_mb):
        leaks = _leaks_of(spark.sparkContext.broadcast(vars(seeds)), share)
        ids = spark.createDataFrame(
            [(i, r, n) for i, (r, n) in enumerate(zip(item_ids, seeds.sizes, strict=True))],
            f"item int, item_id {item_type}, item_words int",
        )
        part = source.select("doc_id", F.explode(leaks("text")).alias("m")).select("doc_id", "m.*")
        # At most block_mb of items lie behind this side.
        part = part.join(F.broadcast(ids), "item").select(
            "doc_id", "item_id", "covered", "item_words", (F.col("covered") / F.col("item_words")).alias("coverage"), "tiles"
        )
        result = part if result is None else result.unionByName(part)
    return result


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    share: float = SHARE,
    least: int = LEAST,
    block_mb: int = BLOCK_MB,
) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item, as ``benchmark_leaks`` finds them.

    Each row is judged where it is read: nothing is shuffled and all columns stay. Null
    and empty texts stay.
    """
    for _, seeds in _blocks(benchmark, item_col, item_text_col, least, block_mb):
        leaks = _leaks_of(docs.sparkSession.sparkContext.broadcast(vars(seeds)), share)
        docs = docs.where(F.size(leaks(F.col(f"`{text_col}`"))) == 0)
    return docs


@query()
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the share of it they hold."""
    return benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

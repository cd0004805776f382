"""Terms counted, weighted and compared inside the tasks, as numbers of Arrow batches.

A batch's terms are coded once; counts are runs of sorted codes and sums by code, so no
string is sorted and no lambda runs per term. Spark deals the rows and sums what tasks return.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

MANY = 1 << 18  # rows a task gathers before it keeps the first of each group
TERMS = 1 << 20  # terms that are coded and summed at a time, or those of one row
PAIRS = 1 << 22  # sums of pairs a task holds before it hands them on
ROWS = 1 << 20  # rows whose pairs are numbered at a time
CELLS = 1 << 22  # products and sums of documents by queries that are made at a time

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def row_numbers(lists: pa.Array) -> np.ndarray:
    """The row of every item of a column of lists."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
    return np.repeat(np.arange(len(sizes)), sizes)


def coded_terms(lists: pa.Array, pairs: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and code of every term, and the terms by code; null terms are left out.

    With ``pairs``, neighbours joined by a space are terms as well, for words that hold no space.
    """
    row, coded = row_numbers(lists), lists.flatten().dictionary_encode()
    code, words = np.asarray(pc.fill_null(coded.indices, -1), np.int64), coded.dictionary
    known = code >= 0
    if not pairs:
        return row[known], code[known], words
    n, both = len(words) + 1, known[1:] & known[:-1] & (row[1:] == row[:-1])
    grams = np.concatenate([code[known] * n, code[:-1][both] * n + code[1:][both] + 1])
    found, code = np.unique(grams, return_inverse=True)
    single = found % n == 0
    first, second = (words.take(pa.array(x)) for x in (found // n, np.maximum(found % n - 1, 0)))
    terms = pc.if_else(pa.array(single), first, pc.binary_join_element_wise(first, second, " "))
    return np.concatenate([row[known], row[:-1][both]]), code, terms


def counted(lists: pa.Array, pairs: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row, code and count of the different terms of each row, in this order, and the terms by code."""
    row, code, terms = coded_terms(lists, pairs)
    n = max(1, len(terms))
    found, counts = np.unique(row * n + code, return_counts=True)
    return found // n, found % n, counts, terms


def words_of(vocab: pa.Array) -> pa.Array:
    """The words of terms and pairs."""
    return pc.unique(pc.split_pattern(vocab, " ").flatten()) if len(vocab) else vocab


def sums_by_key(key: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys in order, the rows that hold each and how often it comes."""
    found = np.sort(key * max(1, rows) + row)
    # Runs of one key in one row, then runs of one key.
    starts = np.flatnonzero(np.r_[len(found) > 0, found[1:] != found[:-1]])
    key = found[starts] // max(1, rows)
    first = np.flatnonzero(np.r_[len(key) > 0, key[1:] != key[:-1]])
    return key[first], np.diff(np.r_[first, len(key)]), np.diff(np.r_[starts[first], len(found)])


def list_slices(lists: pa.Array) -> Iterator[tuple[int, int]]:
    """Starts and lengths of the rows that hold `TERMS` items at a time, but one row at least."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64))
    lo = 0
    while lo < len(lists):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + TERMS, "right")))
        yield lo, hi - lo
        lo = hi


def batch_stats(batches: Iterable[pa.RecordBatch], pairs: bool = False) -> Iterator[pa.RecordBatch]:
    """``(group, term, df, tf)`` of each batch of ``(group, terms)``, in parts of at most `TERMS` terms."""
    for batch in (whole.slice(*part) for whole in batches for part in list_slices(whole.column("terms"))):
        row, code, terms = coded_terms(batch.column("terms"), pairs)
        groups = batch.column("group").dictionary_encode(null_encoding="encode")
        n = max(1, len(terms))
        keys, df, tf = sums_by_key(np.asarray(groups.indices, np.int64)[row] * n + code, row, batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [groups.dictionary.take(pa.array(keys // n)), terms.take(pa.array(keys % n)), pa.array(df), pa.array(tf)],
            ["group", "term", "df", "tf"],
        )


def places(found: np.ndarray, among: np.ndarray) -> np.ndarray:
    """The place of each number in an ascending list, or -1."""
    if not len(among):
        return np.full(len(found), -1)
    at = np.searchsorted(among, found)
    return np.where(among[np.minimum(at, len(among) - 1)] == found, at, -1)


def word_numbers(lists: pa.Array, words: pa.Array) -> np.ndarray:
    """The place of every word of a column of lists among given ones, or -1."""
    coded = lists.flatten().dictionary_encode()
    known = np.asarray(pc.fill_null(pc.index_in(coded.dictionary, value_set=words), -1), np.int64)
    code = np.asarray(pc.fill_null(coded.indices, -1), np.int64)
    return np.r_[known, -1][code]


class Pairs:
    """Neighbours that are both among the words ``(group, term, least)`` of their group, counted as numbers.

    ``least`` is one number for a group: no pair that comes less often is wanted.
    A word of a group has a place, of at most 2^20; a pair is the first word's place times their number plus the second's.
    """

    def __init__(self, words: pa.Table):
        def coded(name):
            column = pa.chunked_array(words[name].chunks, words.schema.field(name).type).combine_chunks()
            found = column.dictionary_encode(null_encoding="encode")
            return np.asarray(found.indices, np.int64), found.dictionary

        (group, self.groups), (term, self.terms) = coded("group"), coded("term")
        self.keys, first = np.unique(group * len(self.terms) + term, return_index=True)
        self.least = np.asarray(words["least"], np.int64)[first]

    def counted(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``(pair, df, tf)`` of a task's ``(group, terms)``, a pair once for every `PAIRS` of them."""
        held, rows, kept = [], 0, 0

        def summed() -> np.ndarray:
            pair, df, tf = np.concatenate(held, axis=1)
            order = np.argsort(pair, kind="stable")
            starts = np.flatnonzero(np.r_[True, pair[order][1:] != pair[order][:-1]])
            return np.stack([pair[order][starts], np.add.reduceat(df[order], starts), np.add.reduceat(tf[order], starts)])

        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                held.append(self._counts(batch.slice(lo, ROWS)))
                rows += held[-1].shape[1]
                if rows > max(PAIRS, 2 * kept):
                    held = [summed()]
                    rows = kept = held[0].shape[1]
                    if kept > PAIRS:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, held[0])), ["pair", "df", "tf"])
                        held, rows, kept = [], 0, 0
        if rows:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, summed())), ["pair", "df", "tf"])

    def _counts(self, batch: pa.RecordBatch) -> np.ndarray:
        """Pairs of a batch, the rows that hold them and how often they come."""
        lists, n = batch.column("terms"), batch.num_rows
        row, word = row_numbers(lists), word_numbers(lists, self.terms)
        group = np.asarray(pc.fill_null(pc.index_in(batch.column("group"), value_set=self.groups), -1), np.int64)[row]
        at = places(np.where((word < 0) | (group < 0), -1, group * len(self.terms) + word), self.keys)
        both = (at[1:] >= 0) & (at[:-1] >= 0) & (row[1:] == row[:-1])
        return np.stack(sums_by_key(at[:-1][both] * len(self.keys) + at[1:][both], row[1:][both], n))

    def named(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``(group, term, df, tf)`` of ``(pair, df, tf)``."""
        n = max(1, len(self.terms))
        for batch in batches:
            first = np.asarray(batch.column("pair"), np.int64) // max(1, len(self.keys))
            batch = batch.filter(pa.array(np.asarray(batch.column("tf")) >= self.least[first]))
            pair = np.asarray(batch.column("pair"), np.int64)
            first, second = (self.keys[x] for x in np.divmod(pair, max(1, len(self.keys))))
            words = [self.terms.take(pa.array(x % n)) for x in (first, second)]
            group = self.groups.take(pa.array(first // n))
            term = pc.binary_join_element_wise(*words, " ")
            yield pa.RecordBatch.from_arrays([group, term, batch.column("df"), batch.column("tf")], ["group", "term", "df", "tf"])


def first_of(table: pa.Table, by: str, order: Sequence[tuple[str, str]], n: int) -> pa.Table:
    """The first ``n`` rows of each number ``by``, nulls before values."""
    table = table.take(pc.sort_indices(table, sort_keys=[(by, "ascending"), *order], null_placement="at_start"))
    own = np.asarray(table.column(by))
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    place = np.arange(len(own)) - np.repeat(starts, np.diff(np.r_[starts, len(own)]))
    return table.filter(pa.array(place < n))


def most_used(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """The ``n`` most used terms of each group among a task's ``(group, term, df, tf)``, equal ones by name."""
    held, rows, kept = [], 0, 0

    def cut(parts: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(parts).combine_chunks()
        codes = table.column("group").combine_chunks().dictionary_encode(null_encoding="encode").indices
        first = first_of(table.append_column("_g", codes), "_g", [("tf", "descending"), ("term", "ascending")], n)
        return first.drop_columns("_g")

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows > max(MANY, 2 * kept):
            held = cut(held).to_batches()
            rows = kept = sum(b.num_rows for b in held)
    if rows:
        yield from cut(held).to_batches()


class Places:
    """The places of terms in a vocabulary; with ``pairs``, of words that hold no space and of their pairs."""

    def __init__(self, vocab: pa.Array, pairs: bool = False):
        self.size, self.pairs, self.words = len(vocab), pairs, words_of(vocab) if pairs else vocab
        if pairs and len(vocab):
            parts, n = pc.split_pattern(vocab, " ", max_splits=1), len(self.words)
            paired = np.asarray(pc.list_value_length(parts)) == 2
            number = np.asarray(pc.fill_null(pc.index_in(parts.flatten(), value_set=self.words), -1), np.int64)
            starts = np.cumsum(1 + paired) - (1 + paired)
            self.single = np.full(n + 1, -1)
            self.single[number[starts[~paired]]] = np.flatnonzero(~paired)
            self.single[n] = -1
            first, second = number[starts[paired]], number[starts[paired] + 1]
            keys = np.where((first < 0) | (second < 0), -1, first * n + second)
            order = np.argsort(keys)
            self.keys, self.place = keys[order], np.r_[np.flatnonzero(paired)[order], -1]

    def counted(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, place and count of the different known terms of each row, in this order."""
        row, at = row_numbers(lists), word_numbers(lists, self.words)
        if self.pairs and self.size:
            both = (at[1:] >= 0) & (at[:-1] >= 0) & (row[1:] == row[:-1])
            pair = self.place[places(at[:-1][both] * len(self.words) + at[1:][both], self.keys)]
            row, at = np.concatenate([row, row[:-1][both]]), np.concatenate([self.single[at], pair])
        known, n = at >= 0, max(1, self.size)
        found, counts = np.unique(row[known] * n + at[known], return_counts=True)
        return found // n, found % n, counts


def weigh(lists: pa.Array, terms: Places, idf: np.ndarray, sublinear: bool) -> pa.Array:
    """Per row the L2-normalised weights as ``struct<type,size,indices,values>``, of at most `TERMS` terms at a time."""
    if len(parts := list(list_slices(lists))) > 1:
        return pa.concat_arrays([weigh(lists.slice(*part), terms, idf, sublinear) for part in parts])
    row, at, counts = terms.counted(lists)
    starts, weights = _normalised(row, at, counts, len(lists), idf, sublinear)
    n, lists_of = len(lists), lambda x: pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(x))
    size = pa.array(np.full(n, terms.size, np.int32))
    return pa.StructArray.from_arrays(
        [pa.array(np.zeros(n, np.int8)), size, lists_of(at.astype(np.int32)), lists_of(weights)],
        ["type", "size", "indices", "values"],
    )


def weigh_grouped(
    groups: pa.Array, lists: pa.Array, names: pa.Array, vocab: pa.Array, terms: Places, keys: np.ndarray, idf: np.ndarray
) -> pa.Array:
    """Per row the weights ``array<struct<term,weight>>`` under its group's vocabulary.

    ``keys`` holds the number of the group in ``names`` times the terms, plus the number of the term in
    ``vocab``, ascending, beside ``idf``.
    """
    row, term, counts = terms.counted(lists)
    group = np.asarray(pc.fill_null(pc.index_in(groups, value_set=names), -1), np.int64)[row]
    at = places(np.where(group < 0, -1, group * len(vocab) + term), keys)
    known = at >= 0
    starts, weights = _normalised(row[known], at[known], counts[known], len(lists), idf, False)
    return pa.ListArray.from_arrays(
        pa.array(starts, pa.int32()), pa.StructArray.from_arrays([vocab.take(pa.array(term[known])), pa.array(weights)], ["term", "weight"])
    )


def _normalised(row, at, counts, n: int, idf: np.ndarray, sublinear: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row starts and weights of terms ordered by row and place."""
    counts = counts.astype(float)
    raw = (1 + np.log(counts) if sublinear else counts) * idf[at]
    norms = np.sqrt(np.bincount(row, raw * raw, n))
    return np.r_[0, np.cumsum(np.bincount(row, minlength=n))], raw / norms[row]


class Asked:
    """The terms of a batch of queries, by group and term."""

    def __init__(self, weights: pa.Table):
        weights = weights.filter(pc.is_valid(weights["group"])).combine_chunks()

        def coded(name):
            column = weights[name].combine_chunks() if weights.num_rows else pa.array([], weights.schema.field(name).type)
            found = column.dictionary_encode(null_encoding="encode")
            return np.asarray(found.indices, np.int64), found.dictionary

        (group, self.groups), (query, self.queries), (term, self.terms) = map(coded, ("group", "query_id", "term"))
        # A pair is a query in a group.
        pairs, pair = np.unique(group * max(1, len(self.queries)) + query, return_inverse=True)
        self.pair_group, self.pair_query = pairs // max(1, len(self.queries)), pairs % max(1, len(self.queries))
        key = group * max(1, len(self.terms)) + term
        order = np.argsort(key, kind="stable")
        self.keys, self.starts, self.sizes = np.unique(key[order], return_index=True, return_counts=True)
        self.pair, self.weight = pair[order], np.asarray(weights["q_weight"], np.float64)[order]

    def closest(self, batches: Iterable[pa.RecordBatch], k: int, decimals: int) -> Iterator[pa.RecordBatch]:
        """``(query_id, group, doc, similarity)``: the ``k`` closest of a task's documents ``(group, doc, weights)``."""
        n, held = len(self.pair_group), None
        least = np.zeros(n)
        for batch in batches:
            for part in self._near(batch, least, k, decimals) if n else ():
                held = part if held is None else pa.concat_tables([held, part])
                held = first_of(held.combine_chunks(), "pair", [("similarity", "descending"), ("doc", "ascending")], k)
                pair, last = np.asarray(held["pair"]), np.asarray(held["similarity"])
                ends = np.flatnonzero(np.bincount(pair, minlength=n) >= k)
                least[ends] = last[np.searchsorted(pair, ends, "right") - 1]
        if held is not None:
            pair = np.asarray(held["pair"])
            columns = [
                self.queries.take(pa.array(self.pair_query[pair])), self.groups.take(pa.array(self.pair_group[pair])),
                held["doc"].combine_chunks(), held["similarity"].combine_chunks(),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "group", "doc", "similarity"])

    def _near(self, batch: pa.RecordBatch, least: np.ndarray, k: int, decimals: int) -> Iterator[pa.Table]:
        """Documents that may be among the ``k`` closest, of some rows at a time."""
        n, lists = len(self.pair_group), batch.column("weights")
        row, flat = row_numbers(lists), lists.flatten()
        group = np.asarray(pc.fill_null(pc.index_in(batch.column("group"), value_set=self.groups), -1), np.int64)[row]
        term = np.asarray(pc.fill_null(pc.index_in(flat.field("term"), value_set=self.terms), -1), np.int64)
        key = np.where((group < 0) | (term < 0), -1, group * len(self.terms) + term)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        row, at, weight = row[known], at[known], np.asarray(flat.field("weight"), np.float64)[known]
        sizes = self.sizes[at]
        work = np.cumsum(np.bincount(row, sizes, batch.num_rows) + n)
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(work, (work[lo - 1] if lo else 0) + CELLS, "right")))
            inside = slice(*np.searchsorted(row, [lo, hi]))
            many, ends = sizes[inside], np.cumsum(sizes[inside])
            place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at[inside]] - ends + many, many)
            cell = np.repeat(row[inside] - lo, many) * n + self.pair[place]
            products = np.repeat(weight[inside], many) * self.weight[place]
            shape = (hi - lo, n)
            shares = np.bincount(cell, minlength=shape[0] * n).reshape(shape) > 0
            found = np.bincount(cell, products, shape[0] * n).reshape(shape)
            found = np.floor(found * 10.0**decimals + 0.5) / 10.0**decimals
            bound = np.maximum(least, np.partition(found, -k, axis=0)[-k]) if shape[0] > k else least
            doc, pair = np.nonzero(shares & (found >= bound))
            if len(doc):
                yield pa.table({"pair": pair, "doc": batch.column("doc").take(pa.array(doc + lo)), "similarity": found[doc, pair]})
            lo = hi

"""Linear learners, many fits at once: every pass over the rows serves all of them.

Newton steps with conjugate gradients. The state of all fits, a weight per column and
output, is on the driver; a pass sends it to the tasks, which hold the rows as
sparse blocks, and sums what they return. Folds are masks on the loss, so
all folds and classes share one scan.
"""

from __future__ import annotations

import functools
import json
import math
import pickle
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import durable

LOGISTIC, SOFTMAX, SQUARED_HINGE = "logistic", "softmax", "squared_hinge"
ROWS = 1024  # of a block
GATHERED = 1 << 21  # numbers of all partitions' sums that may meet on the driver
FAN_IN = 32  # partitions a level of a larger sum takes
#: Weights of the fits that are solved together; more fits go batch by batch.
CELLS = 1 << 21
#: Columns filled in this share of the rows are stored as a dense block, the fullest first.
FILLED, DENSE = 0.25, 128
STEPS = (0.7, 0.5, 0.25, 0.1, 0.03, 0.01, 0.001)
#: Gradient, against that at zero, at which a fit on all folds is near enough to start those without one from.
NEAR = 1e-3
#: Dense columns of all outputs that are inverted as one, and conjugate gradient steps of a Newton step.
COUPLED, TURNS = 1024, 500

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Fit(NamedTuple):
    """One fit: a target column, the fold left out, the weight of each class, and the classes with an output."""

    target: int
    fold: int | None
    weights: dict[int, float]
    classes: tuple[int, ...]


def balanced(counts: dict[int, int]) -> dict[int, float]:
    """n / (classes * n_class) for each class that has rows."""
    filled = {c: n for c, n in counts.items() if n}
    return {c: sum(filled.values()) / (len(filled) * n) for c, n in filled.items()}


def sparse_rows(column: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row starts, column numbers and values of ML vectors, sparse or dense."""
    values, indices = column.field("values"), column.field("indices")
    sizes = np.asarray(pc.fill_null(pc.list_value_length(values), 0), np.int64)
    given = np.asarray(pc.fill_null(pc.list_value_length(indices), 0), np.int64)
    starts = np.r_[0, np.cumsum(sizes)]
    at = np.arange(starts[-1]) - np.repeat(starts[:-1], sizes)
    listed = np.repeat(np.asarray(column.field("type"), np.int64) == 0, sizes)
    flat = np.asarray(indices.flatten(), np.int64)
    at[listed] = flat if given.sum() == listed.sum() else flat[: listed.sum()]
    return starts, at, np.asarray(values.flatten(), np.float64)


def row_sums(products: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sum of each row's products; rows without any are zero."""
    out = np.zeros((len(starts) - 1, products.shape[1]))
    filled = np.flatnonzero(np.diff(starts))
    if len(filled):
        out[filled] = np.add.reduceat(products, starts[:-1][filled], axis=0)
    return out


class Block(NamedTuple):
    """Rows of sparse values, ``at`` places in the block's own ``cols``; the last dense column is 1.

    Every pass sends the blocks to the tasks' Python, so they hold each value once.
    """

    starts: np.ndarray
    at: np.ndarray
    values: np.ndarray
    cols: np.ndarray
    dense: np.ndarray
    targets: np.ndarray
    folds: np.ndarray
    lone: np.ndarray  # a row's sum of squares of the columns that no other row fills

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Rows x outputs, from ``weights`` with a line for each output; one output at a time keeps to plain vectors."""
        width = weights.shape[1] - self.dense.shape[1]
        out = self.dense @ weights[:, width:].T
        filled = np.flatnonzero(np.diff(self.starts))
        if len(filled):
            at, first, taken = self.at.astype(np.intp), self.starts[:-1][filled], np.empty(len(self.at))
            for j, own in enumerate(weights):
                np.take(own[self.cols], at, out=taken, mode="clip")
                taken *= self.values
                out[filled, j] += np.add.reduceat(taken, first)
        return out

    def pull(self, total: np.ndarray, parts: np.ndarray, width: int, squared: bool = False) -> None:
        """Add to ``total`` (columns x outputs) each column's sum of its values (or their squares) times the rows' ``parts``."""
        if len(self.cols):
            values = self.values**2 if squared else self.values
            at, lengths = self.at.astype(np.intp), np.diff(self.starts)
            sums = [np.bincount(at, np.repeat(own, lengths) * values, len(self.cols)) for own in parts.T]
            total[self.cols] += np.stack(sums, 1)
        if not squared:
            total[width:] += self.dense.T @ parts


_KINDS = {"starts": "i8", "at": "i4", "values": "f8", "cols": "i4", "dense": "f8", "targets": "i4", "folds": "i4", "lone": "f8"}


def _blocks(batch: pa.RecordBatch, slots: np.ndarray, dense: int, numbers: np.ndarray | None = None) -> Iterator[dict[str, bytes]]:
    """Stored blocks, with columns as their ``numbers``; those without one (-1) are apart, as ``cells``."""
    starts, at, values = sparse_rows(batch.column("features"))
    targets = np.stack([np.asarray(pc.cast(c, pa.int32())) for c in batch.column("targets").flatten()], 1)
    folds = np.asarray(batch.column("fold"), np.int32)
    for lo in range(0, len(folds), ROWS):
        hi = min(lo + ROWS, len(folds))
        span = slice(starts[lo], starts[hi])
        row = np.repeat(np.arange(hi - lo), np.diff(starts[lo : hi + 1]))
        a, v = at[span], values[span]
        full = np.zeros((hi - lo, dense + 1))
        full[:, -1] = 1
        inside = slots[a] >= 0
        full[row[inside], slots[a[inside]]] = v[inside]
        row, a, v = (x[~inside & (v != 0)] for x in (row, a, v))
        lone = np.zeros(len(a), bool) if numbers is None else numbers[a] < 0
        cells = row[lone], a[lone], v[lone]
        row, a, v = row[~lone], a[~lone] if numbers is None else numbers[a[~lone]], v[~lone]
        cols, places = np.unique(a, return_inverse=True)
        own = np.r_[0, np.cumsum(np.bincount(row, minlength=hi - lo))]
        parts = (own, places, v, cols, full, targets[lo:hi], folds[lo:hi], np.bincount(cells[0], cells[2] ** 2, hi - lo))
        stored = {k: np.ascontiguousarray(x, d).tobytes() for (k, d), x in zip(_KINDS.items(), parts, strict=True)}
        if numbers is not None:
            stored |= {k: x.astype(d).tobytes() for (k, d), x in zip(_CELLS.items(), cells, strict=True)}
        yield stored


#: The columns that no other row fills: only read for their weights, when the fits are found.
_CELLS = {"cell_row": "i4", "cell_col": "i4", "cell_value": "f8"}


def _opened(rows: Iterable[tuple], n_targets: int) -> Iterator[Block]:
    for row in rows:
        parts = {k: np.frombuffer(x, d) for (k, d), x in zip(_KINDS.items(), row, strict=True)}
        n = len(parts["folds"])
        parts["dense"], parts["targets"] = parts["dense"].reshape(n, -1), parts["targets"].reshape(n, n_targets)
        yield Block(**parts)


def _total(blocks: RDD, work: Callable[[Iterable[tuple], np.ndarray], None], size: int) -> np.ndarray:
    """The sum of the arrays of ``size`` to which ``work`` adds; tasks add their sums first where they are too large to meet on the driver."""

    # The weights inside it are sent once to each executor, and every copy goes when the pass is over.
    shared = blocks.context.broadcast(cloudpickle.dumps(work))

    def partial(rows):
        total = np.zeros(size)
        pickle.loads(shared.value)(rows, total)
        return [total]

    sums = blocks.mapPartitions(partial)
    try:
        if (parts := blocks.getNumPartitions()) * size > GATHERED:
            return sums.treeReduce(np.add, depth=max(2, math.ceil(math.log(parts, FAN_IN))))
        return functools.reduce(np.add, sums.collect())
    finally:
        shared.destroy()


def _filled(rows: DataFrame, width: int, least: float) -> np.ndarray:
    """Rows in which each column is not zero; 0 for columns filled in fewer than ``least``, which don't come to the driver."""

    def count(batches):
        total = np.zeros(width, np.int64)
        for batch in batches:
            _, at, values = sparse_rows(batch.column("features"))
            total += np.bincount(at[values != 0], minlength=width)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["col", "n"])

    counts = np.zeros(width, np.int64)
    summed = rows.mapInArrow(count, "col long, n long").groupBy("col").agg(F.sum("n").alias("n"))
    for r in summed.where(F.col("n") >= least).orderBy(F.desc("n"), "col").limit(DENSE).collect():
        counts[r.col] = r.n
    return counts


class Losses(NamedTuple):
    """The loss of some fits of one kind, on the rows of a block."""

    kind: str
    fits: list[Fit]
    n_codes: int
    c: float = 1.0

    def _shape(self) -> tuple[int, int]:
        return len(self.fits), len(self.fits[0].classes)

    def _rows(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Weights (rows x fits x 1) and signs or memberships (rows x fits x outputs)."""
        weights, said = [], []
        for fit in self.fits:
            code = block.targets[:, fit.target]
            table = np.array([fit.weights.get(c, 0.0) for c in range(self.n_codes)])
            weights.append(table[code] * (block.folds != (-1 if fit.fold is None else fit.fold)))
            said.append(code[:, None] == np.array(fit.classes)[None, :])
        is_class = np.stack(said, 1)
        return np.stack(weights, 1)[:, :, None], is_class if self.kind == SOFTMAX else np.where(is_class, 1.0, -1.0)

    def _shift(self, block: Block, w: np.ndarray, y: np.ndarray, s: np.ndarray) -> np.ndarray:
        """What a logistic row's lone columns add to its score at their best, given the rest of it: the root of
        u = y * r * p(-y * (s + u)), r being the row's weight times their sum of squares.

        Newton steps kept in a bracket, on a function that rises at least as fast as u.
        """
        r = self.c * w * block.lone[:, None, None]
        if self.kind != LOGISTIC or not r.any():
            return np.zeros_like(s)
        m, low, high = y * s, np.zeros_like(s), np.broadcast_to(r, s.shape).copy()
        u = r / (2 + 0.5 * r)
        for _ in range(100):
            p = 1 / (1 + np.exp(np.clip(m + u, -500, 500)))
            off = u - r * p
            low, high = np.where(off < 0, u, low), np.where(off > 0, u, high)
            step = u - off / (1 + r * p * (1 - p))
            step = np.where((step < low) | (step > high), (low + high) / 2, step)
            done = np.abs(step - u) <= 1e-14 * (1 + u)
            u = step
            if done.all():
                break
        return y * u

    def lone_weights(self, block: Block, flat: np.ndarray) -> np.ndarray:
        """Rows x outputs: the weight of a row's lone columns for each unit of their value."""
        w, y = self._rows(block)
        shift = self._shift(block, w, y, flat.reshape(len(flat), *self._shape())).reshape(flat.shape)
        return shift / np.where(block.lone > 0, block.lone, 1)[:, None]

    def _shares(self, s: np.ndarray) -> np.ndarray:
        raised = np.exp(s - s.max(2, keepdims=True))
        return raised / raised.sum(2, keepdims=True)

    def loss(self, block: Block, flat: np.ndarray) -> np.ndarray:
        """The sum over the rows, for each fit."""
        w, y = self._rows(block)
        s = flat.reshape(len(flat), *self._shape())
        if self.kind == SOFTMAX:
            top = s.max(2, keepdims=True)
            each = w[:, :, 0] * (top[:, :, 0] + np.log(np.exp(s - top).sum(2)) - (s * y).sum(2))
        elif self.kind == LOGISTIC:
            u = self._shift(block, w, y, s)
            price = u**2 / np.where(block.lone > 0, 2 * self.c * block.lone, 1)[:, None, None]
            each = (w * np.logaddexp(0, -y * (s + u)) + price)[:, :, 0]
        else:
            each = (w * np.maximum(0, 1 - y * s) ** 2)[:, :, 0]
        return each.sum(0)

    def slope(self, block: Block, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First derivative and the diagonal of the second by each score."""
        w, y = self._rows(block)
        s = flat.reshape(len(flat), *self._shape())
        if self.kind == SOFTMAX:
            p = self._shares(s)
            first, second = w * (p - y), w * p * (1 - p)
        elif self.kind == LOGISTIC:
            p = 1 / (1 + np.exp(np.clip(y * (s + self._shift(block, w, y, s)), -500, 500)))
            first, second = -w * y * p, w * p * (1 - p)
            second = second / (1 + self.c * block.lone[:, None, None] * second)
        else:
            short = np.maximum(0, 1 - y * s)
            first, second = -2 * w * y * short, 2 * w * (short > 0)
        return first.reshape(flat.shape), np.broadcast_to(second, s.shape).reshape(flat.shape)

    def together(self, length: int, dense: int) -> int:
        """Outputs that are preconditioned as one: all of a softmax of few classes, as no shift of all its scores changes the loss."""
        k = self._shape()[1]
        small = length * k * (k + 1) // 2 <= CELLS and k * dense <= COUPLED
        return k if self.kind == SOFTMAX and small else 1

    def seconds(self, block: Block, flat: np.ndarray, together: int) -> np.ndarray:
        """The second derivatives by each score, or by each two of the outputs taken ``together``: rows x (groups x pairs)."""
        if together == 1:
            return self.slope(block, flat)[1]
        w, _ = self._rows(block)
        p = self._shares(flat.reshape(len(flat), *self._shape()))
        a, b = np.triu_indices(together)
        return (w * p[:, :, a] * ((a == b) - p[:, :, b])).reshape(len(flat), -1)

    def curved(self, block: Block, flat: np.ndarray, along: np.ndarray) -> np.ndarray:
        """The second derivative times the scores ``along``."""
        if self.kind != SOFTMAX:
            return self.slope(block, flat)[1] * along
        w, _ = self._rows(block)
        p = self._shares(flat.reshape(len(flat), *self._shape()))
        v = along.reshape(p.shape)
        return (w * p * (v - (p * v).sum(2, keepdims=True))).reshape(flat.shape)


@dataclass(frozen=True)
class Solved:
    """Weights (columns x outputs) and intercepts of one fit, and the size of its gradient against that at zero."""

    weights: np.ndarray
    intercepts: np.ndarray
    gradient: float
    rounds: int


@dataclass(frozen=True)
class Rows:
    """Stored blocks of a table: read once for every pass. ``kept`` has the columns that the blocks number, if not all."""

    table: DataFrame
    width: int
    dense: np.ndarray
    n_targets: int
    n_codes: int
    kept: np.ndarray | None = None


def store_rows(df: DataFrame, features: str, targets: Sequence[str], fold: str | None = None, apart: bool = False) -> Rows:
    """Sparse blocks of ``df``; the targets hold class codes from 0. Refuses null codes and empty tables.

    ``apart`` keeps columns that a single row fills out of the passes, for logistic fits: their best weights follow
    from the rest of the row's score, so the loss is taken at these and no weight of them is searched for.
    """
    of = F.struct(*[F.col(t).cast("int").alias(f"t{i}") for i, t in enumerate(targets)])
    given = F.col(fold).cast("int") if fold else F.lit(-2)
    rows = df.select(F.unwrap_udt(features).alias("features"), of.alias("targets"), given.alias("fold"))
    most = [F.max(f"targets.t{i}") for i in range(len(targets))]
    facts = rows.agg(
        F.count(F.lit(1)), F.max(F.coalesce("features.size", F.size("features.values"))), F.greatest(F.lit(0), *most),
        F.max(F.exists(F.array("targets.*"), lambda t: t.isNull())),
    ).first()
    n, width, top, missing = facts
    if not n or missing:
        raise ValueError("no rows to fit on" if not n else "a target has null classes: drop these rows first")

    counts = _filled(rows, width, FILLED * n)
    dense = np.argsort(-counts, kind="stable")[:DENSE]
    dense = np.sort(dense[counts[dense] >= FILLED * n])
    slots = np.full(width, -1)
    slots[dense] = np.arange(len(dense))
    kept = numbers = None
    if apart:
        kept = np.union1d(_shared(rows, width), dense)
        numbers = np.full(width, -1, np.int32)
        numbers[kept] = np.arange(len(kept))

    shared = df.sparkSession.sparkContext.broadcast((slots.astype(np.int32), numbers))

    def pack(batches):
        slots, numbers = shared.value
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pylist(list(_blocks(batch, slots, len(dense), numbers)))

    table = durable(rows.mapInArrow(pack, ", ".join(f"{k} binary" for k in [*_KINDS, *(_CELLS if apart else [])])))
    shared.destroy()
    return Rows(table, width, dense if kept is None else np.searchsorted(kept, dense), len(targets), top + 1, kept)


def _shared(rows: DataFrame, width: int) -> np.ndarray:
    """The columns that more than one row fills."""

    def count(batches):
        total = np.zeros(width, np.int32)
        for batch in batches:
            _, at, values = sparse_rows(batch.column("features"))
            np.add.at(total, at[values != 0], 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.minimum(total[at], 2))], ["col", "n"])

    found = rows.mapInArrow(count, "col long, n int").groupBy("col").agg(F.sum("n").alias("n")).where("n > 1")
    return np.sort(np.asarray(found.select("col").toArrow()["col"], np.int64))


def solve(rows: Rows, kind: str, fits: Sequence[Fit], c: float, bias_penalty: float, tol: float = 1e-5, max_iter: int = 100) -> list[Solved]:
    """Minimise half the squared weights plus ``c`` times the weighted loss, for every fit.

    A fit is done when its gradient is ``tol`` of that at zero. Fits beyond `CELLS`
    weights are solved batch by batch. Fits that differ in their fold start from one on the
    rows of all folds, which has fewer outputs a pass; where they end does not depend on it.
    """
    if rows.kept is not None and kind != LOGISTIC:
        raise ValueError("columns of single rows are kept apart for logistic fits only")
    outputs, length = len(fits[0].classes), (rows.width if rows.kept is None else len(rows.kept)) + len(rows.dense) + 1
    together = Losses(kind, fits[:1], rows.n_codes).together(length, len(rows.dense) + 1)
    size = max(1, 2 * CELLS // (length * outputs * (together + 1)))
    alike = [_alike(fit) for fit in fits]
    order = sorted(range(len(fits)), key=lambda i: alike.index(alike[i]))
    # Passes are many and short: the blocks stay with the executors, and a lost one reads its share again.
    blocks = rows.table.select(*_KINDS).rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = {}
        for i in range(0, len(order), size):
            batch = Losses(kind, [fits[j] for j in order[i : i + size]], rows.n_codes, c)
            start = _start(rows, blocks, batch, c, bias_penalty, max(tol, NEAR), max_iter)
            solved = _newton(rows, blocks, batch, c, bias_penalty, tol, max_iter, start)
            if rows.kept is not None:
                solved = _whole(rows, batch, solved)
            found |= zip(order[i : i + size], solved, strict=True)
        return [found[j] for j in range(len(fits))]
    finally:
        blocks.unpersist()


def _alike(fit: Fit) -> tuple:
    """What fits have in common that differ in their fold and the sizes of their classes only."""
    return fit.target, tuple(sorted(c for c, w in fit.weights.items() if w)), fit.classes


def _whole(rows: Rows, losses: Losses, found: list[Solved]) -> list[Solved]:
    """The fits with the weights of the columns kept apart, a few fits at a time."""
    targets, d, done = rows.n_targets, rows.dense, []
    step = max(1, CELLS // rows.width)
    for i in range(0, len(found), step):
        part, own = losses._replace(fits=losses.fits[i : i + step]), found[i : i + step]
        near = np.concatenate([np.concatenate([s.weights, s.weights[d], s.intercepts[None]]) for s in own], axis=1)
        near[d] = 0
        shared = rows.table.sparkSession.sparkContext.broadcast(cloudpickle.dumps((part, np.ascontiguousarray(near.T))))

        def weigh(batch, shared=shared):
            losses, weights = pickle.loads(shared.value)
            for row in batch:
                cells = {k: np.frombuffer(x, kind) for (k, kind), x in zip(_CELLS.items(), row[len(_KINDS) :], strict=True)}
                for b in _opened([row[: len(_KINDS)]], targets):
                    if len(cells["cell_row"]):
                        each = losses.lone_weights(b, b.scores(weights))
                        yield cells["cell_col"], each[cells["cell_row"]] * cells["cell_value"][:, None]

        whole = np.zeros((rows.width, len(own)))
        whole[rows.kept] = np.concatenate([s.weights for s in own], axis=1)
        for col, weights in rows.table.rdd.map(tuple).mapPartitions(weigh).toLocalIterator():
            whole[col] = weights
        shared.destroy()
        done += [Solved(whole[:, j : j + 1].copy(), s.intercepts, s.gradient, s.rounds) for j, s in enumerate(own)]
    return done


def _start(rows: Rows, blocks: RDD, losses: Losses, c: float, bias_penalty: float, tol: float, max_iter: int) -> np.ndarray | None:
    """Weights near those of the fits, in their order: of one fit on all folds for each set of alike ones."""
    groups: dict[tuple, list[Fit]] = {}
    for fit in losses.fits:
        groups.setdefault(_alike(fit), []).append(fit)
    if 2 * len(groups) > len(losses.fits):
        return None
    k, at = len(losses.fits[0].classes), {g: i for i, g in enumerate(groups)}
    whole = Losses(losses.kind, [own[0]._replace(fold=None) for own in groups.values()], losses.n_codes, c)
    found = _newton(rows, blocks, whole, c, bias_penalty, tol, max_iter)
    near = np.concatenate([np.concatenate([s.weights, s.weights[rows.dense], s.intercepts[None]]) for s in found], axis=1)
    near[rows.dense] = 0
    return near[:, np.concatenate([at[_alike(fit)] * k + np.arange(k) for fit in losses.fits])]


def _newton(
    rows: Rows, blocks: RDD, losses: Losses, c: float, bias_penalty: float, tol: float, max_iter: int, start: np.ndarray | None = None
) -> list[Solved]:
    width, d, k = rows.width if rows.kept is None else len(rows.kept), len(rows.dense) + 1, len(losses.fits[0].classes)
    n_fits, length = len(losses.fits), width + d
    theta = np.zeros((length, n_fits * k))
    penalty = np.ones((length, 1))
    penalty[-1] = bias_penalty
    targets, g = rows.n_targets, losses.together(length, d)
    one, two = np.triu_indices(g)
    places = np.zeros((g, g), int)
    places[one, two] = places[two, one] = np.arange(len(one))
    first, sizes = np.full(n_fits, np.nan), np.full(n_fits, np.inf)
    open_fits, used = np.arange(n_fits), np.zeros(n_fits, int)

    def total_of(work, size: int) -> np.ndarray:
        return _total(blocks, work, size)

    def by_fit(x: np.ndarray) -> np.ndarray:
        return x.sum(0).reshape(-1, k).sum(1)

    def shorter(fits: np.ndarray) -> None:
        """Steps that went too far are shortened, all lengths being tried in one pass."""
        cols = (fits[:, None] * k + np.arange(k)).ravel()
        part = Losses(losses.kind, [losses.fits[f] for f in fits], losses.n_codes, c)
        start, step = before[:, cols], theta[:, cols] - before[:, cols]

        def tried(batch, sums):
            both = np.concatenate([start.T, step.T])
            for b in _opened(batch, targets):
                s, t = np.split(b.scores(both), 2, axis=1)
                sums += np.concatenate([part.loss(b, s + a * t) for a in STEPS])

        found = c * total_of(tried, len(STEPS) * len(fits)).reshape(len(STEPS), -1)
        totals = np.stack([found[i] + 0.5 * by_fit(penalty * (start + a * step) ** 2) for i, a in enumerate(STEPS)])
        theta[:, cols] = start + np.repeat(np.array(STEPS)[totals.argmin(0)], k) * step
        goal[fits] = np.inf

    if start is not None:

        def from_zero(batch, sums):
            slopes = sums.reshape(length, -1)
            for b in _opened(batch, targets):
                b.pull(slopes, losses.slope(b, np.zeros((len(b.folds), n_fits * k)))[0], width)

        first = np.maximum(np.sqrt(by_fit((c * total_of(from_zero, theta.size).reshape(theta.shape)) ** 2)), 1e-300)
        theta = start.copy()

    # A whole step is taken at once; the next pass tells whether it led down far enough.
    before, goal = theta.copy(), np.full(n_fits, np.inf)
    for _ in range(max_iter):
        cols = (open_fits[:, None] * k + np.arange(k)).ravel()
        part = Losses(losses.kind, [losses.fits[f] for f in open_fits], losses.n_codes, c)
        now, m, n_pairs = theta[:, cols], len(cols), len(cols) // g * len(one)

        def looked(batch, sums, part=part, now=now, m=m, n_pairs=n_pairs):
            weights, ends = np.ascontiguousarray(now.T), np.cumsum([len(part.fits), length * m, width * n_pairs])
            losses, slopes, seconds, squares = np.split(sums, ends)
            slopes, seconds, squares = slopes.reshape(length, m), seconds.reshape(width, n_pairs), squares.reshape(n_pairs, d, d)
            for b in _opened(batch, targets):
                s = b.scores(weights)
                second = part.seconds(b, s, g)
                losses += part.loss(b, s)
                b.pull(slopes, part.slope(b, s)[0], width)
                b.pull(seconds, second, width, True)
                for j in range(n_pairs):
                    squares[j] += b.dense.T @ (second[:, j, None] * b.dense)

        n_open = len(open_fits)
        ends = np.cumsum([n_open, length * m, width * n_pairs, n_pairs * d * d])
        out = total_of(looked, ends[-1])
        loss, slopes, seconds, squares = np.split(c * out, ends[:-1])
        total = loss + 0.5 * by_fit(penalty * now**2)
        if (far := total > goal[open_fits]).any():
            shorter(open_fits[far])
            continue
        gradient = penalty * now + slopes.reshape(length, m)
        alone = seconds.reshape(width, -1, len(one)) + (one == two)
        square = squares.reshape(-1, len(one), d, d)
        square[:, one == two] += np.diag(penalty[width:, 0] + 1e-9)
        if g > 1:  # A shift of all intercepts changes nothing: some weight on it keeps the block regular.
            square[:, :, -1, -1] += square[:, one == two, -1, -1].mean(1, keepdims=True)
        alone = np.linalg.inv(alone[:, :, places]) if g > 1 else 1 / alone[:, :, places]
        inverse = np.linalg.inv(square[:, places].transpose(0, 1, 3, 2, 4).reshape(-1, g * d, g * d))
        norm = np.sqrt(by_fit(gradient**2))
        sizes[open_fits] = norm
        first[open_fits] = np.where(np.isnan(first[open_fits]), np.maximum(norm, 1e-300), first[open_fits])
        todo = norm > tol * first[open_fits]
        if not todo.any():
            break
        if not todo.all():
            keep, groups = np.repeat(todo, k), np.repeat(todo, k // g)
            open_fits, total, gradient, alone, inverse = open_fits[todo], total[todo], gradient[:, keep], alone[:, groups], inverse[groups]
            cols, now, norm = cols[keep], now[:, keep], norm[todo]
        used[open_fits] += 1

        def eased(r, alone=alone, inverse=inverse):
            sparse = np.einsum("wgab,wgb->wga", alone, r[:width].reshape(width, -1, g)).reshape(width, -1)
            full = inverse @ r[width:].reshape(d, -1, g).transpose(1, 2, 0).reshape(-1, g * d, 1)
            return np.concatenate([sparse, full.reshape(-1, g, d).transpose(2, 0, 1).reshape(d, -1)])

        def bent(v, fits, now):
            part = Losses(losses.kind, fits, losses.n_codes, c)

            def work(batch, sums):
                weights, pulls = np.concatenate([now.T, v.T]), sums.reshape(v.shape)
                for b in _opened(batch, targets):
                    s, t = np.split(b.scores(weights), 2, axis=1)
                    b.pull(pulls, part.curved(b, s, t), width)

            return penalty * v + c * total_of(work, v.size).reshape(v.shape)

        step, r = np.zeros_like(gradient), -gradient
        z = eased(r)
        along, rz = z.copy(), by_fit(r * z)
        enough = np.maximum(np.minimum(0.3, np.sqrt(norm / first[open_fits])) * norm, 0.3 * tol * first[open_fits])
        for _ in range(TURNS):
            busy = np.sqrt(by_fit(r**2)) > enough
            if not busy.any():
                break
            own, h = np.repeat(busy, k), np.zeros_like(along)
            h[:, own] = bent(along[:, own], [losses.fits[f] for f in open_fits[busy]], now[:, own])
            curve = by_fit(along * h)
            a = np.where(busy & (curve > 0), rz / np.where(curve > 0, curve, 1), 0)
            step += np.repeat(a, k) * along
            r = r - np.repeat(a, k) * h
            z = eased(r)
            new = by_fit(r * z)
            along = z + np.repeat(np.where(busy & (rz > 0), new / np.where(rz > 0, rz, 1), 0), k) * along
            rz = new

        down = by_fit(gradient * step)
        before[:, cols], theta[:, cols] = now, now + step
        goal[open_fits] = total + 1e-4 * down + 1e-12 * np.abs(total)
    found = []
    for f in range(n_fits):
        own = theta[:, f * k : (f + 1) * k]
        weights = own[:width].copy()
        weights[rows.dense] = own[width:-1]
        found.append(Solved(weights, own[-1].copy(), float(sizes[f] / first[f]), int(used[f])))
    return found


@dataclass(frozen=True)
class LinearModel:
    """A fitted linear learner: ``weights`` has a row for each output, of which a binary one has one."""

    kind: str
    weights: np.ndarray
    intercepts: np.ndarray
    features: str = "features"

    def margins(self, col: str | None = None):
        """The outputs of each row, as an array."""
        weights, intercepts = self.weights.T, self.intercepts

        def score(rows: pa.Array) -> pa.Array:
            starts, at, values = sparse_rows(rows)
            found = row_sums(weights[at] * values[:, None], starts) + intercepts
            return pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel()))

        return F.arrow_udf(score, "array<double>").asNondeterministic()(F.unwrap_udt(col or self.features))

    def transform(self, df: DataFrame) -> DataFrame:
        """Add rawPrediction, probability unless the loss is a hinge, and prediction (the first of the largest)."""
        kept = df.columns
        scored = df.withColumn("_margins", self.margins())
        if self.weights.shape[0] == 1:
            one = F.get("_margins", F.lit(0))
            scored = scored.withColumn("_margins", F.array(-one, one))
            raised = F.transform("_margins", lambda s: 1 / (1 + F.exp(-s)))
        else:
            raised = F.transform("_margins", lambda s: F.exp(s - F.array_max("_margins")))
        scored = scored.withColumn("_raised", raised)
        total = F.aggregate("_raised", F.lit(0.0), lambda x, y: x + y)
        shares = F.zip_with("_raised", F.array_repeat(total, F.size("_raised")), lambda x, t: x / t)
        best = F.array_position("_margins", F.array_max("_margins")) - 1
        return scored.select(
            *kept,
            array_to_vector("_margins").alias("rawPrediction"),
            *([] if self.kind == SQUARED_HINGE else [array_to_vector(shares).alias("probability")]),
            best.cast("double").alias("prediction"),
        )

    def save(self, spark: SparkSession, path: str) -> None:
        facts = json.dumps({"kind": self.kind, "features": self.features})
        rows = [(facts, i, w.tolist(), float(b)) for i, (w, b) in enumerate(zip(self.weights, self.intercepts, strict=True))]
        spark.createDataFrame(rows, "facts string, output int, weights array<double>, intercept double").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearModel:
        rows = spark.read.parquet(path).orderBy("output").collect()
        facts = json.loads(rows[0].facts)
        return LinearModel(facts["kind"], np.array([r.weights for r in rows]), np.array([r.intercept for r in rows]), facts["features"])

"""Records of files that can't be cut at line ends: quoted CSV and JSON arrays, read in many tasks.

A file is read in its splits, as pieces between separators. A first pass reports per split
what it does to the state at its start, for either state: inside a quoted text or not, by
how much the nesting grows, and how many records end at each depth. These reports are
composed in file order, one row per split, which tells the state in which each split
really starts. A second pass then cuts every split into records; only what lies
across split ends is shuffled to be joined.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CELL = r'(?:"(?:[^"]++|"")*+"[^,]*+|(?!")[^,]*+)'
_FROM_START = re.compile(rf"{_CELL}(?:,{_CELL})*+", re.S)
_FROM_QUOTED = re.compile(rf'(?:[^"]++|"")*+"[^,]*+(?:,{_CELL})*+', re.S)
_STRING_END = re.compile(r'(?:[^"\\]++|\\.)*+"', re.S)
_STRING = re.compile(r'"(?:[^"\\]++|\\.)*+"', re.S)


class CsvLines:
    """Lines of CSV with doubled quotes; state 1 is inside a quoted cell. A quote inside a bare cell is a character."""

    separator, joint = "\n", "\n"

    @staticmethod
    def step(piece: str, state: int) -> tuple[int, int]:
        """The state after the line and the growth of the nesting, which is none."""
        if '"' not in piece:
            return state, 0
        return int(not (_FROM_QUOTED if state else _FROM_START).fullmatch(piece)), 0

    @staticmethod
    def is_empty(piece: str, state: int) -> bool:
        return state == 0 and piece in ("", "\r")

    @staticmethod
    def mark(first: str) -> int:
        return 0

    @staticmethod
    def base(mark: int) -> int:
        return 0

    @staticmethod
    def joined(pieces: list[str]) -> str:
        return "\n".join(pieces)


class JsonObjects:
    """What stands between closing braces; state 1 is inside a string. Records are the objects of the outer array."""

    separator, joint = "}", ""

    @staticmethod
    def step(piece: str, state: int) -> tuple[int, int]:
        """The state behind the piece and its brace, and the growth of the nesting."""
        at = 0
        if state:
            end = _STRING_END.match(piece)
            if end is None:
                return 1, 0
            at = end.end()
        bare = _STRING.sub("", piece[at:]) if '"' in piece else piece[at:]
        open_string = bare.find('"')
        bare = bare if open_string < 0 else bare[:open_string]
        grown = bare.count("{") + bare.count("[") - bare.count("]")
        return (0, grown - 1) if open_string < 0 else (1, grown)

    @staticmethod
    def is_empty(piece: str, state: int) -> bool:
        return False

    @staticmethod
    def mark(first: str) -> int:
        """Whether the file holds an array."""
        return int(first.lstrip("﻿ \t\r\n").startswith("["))

    @staticmethod
    def base(mark: int) -> int:
        return mark

    @staticmethod
    def joined(pieces: list[str]) -> str:
        return "".join(p + "}" for p in pieces)


Machine = type[CsvLines] | type[JsonObjects]
_SPLIT = ["path", "start", "length"]


def _pieces(spark: SparkSession, path: str, machine: Machine) -> DataFrame:
    """All pieces with the split that they were read in; those of a split are together and in order."""
    return spark.read.option("lineSep", machine.separator).text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        "value",
    )


def _rows(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns], strict=True)


def _reports(pieces: DataFrame, machine: Machine) -> DataFrame:
    """A row per split: exit state and growth for each entry state, and the record ends at each relative depth."""

    def report(batches):
        for split, rows in groupby(_rows(batches, [*_SPLIT, "value"]), key=lambda r: r[:3]):
            states, grown, mark = [0, 1], [0, 0], None
            ends: list[dict[int, int]] = [{}, {}]
            for row in rows:
                mark = machine.mark(row[3]) if mark is None else mark
                for i in (0, 1):
                    before = states[i]
                    states[i], more = machine.step(row[3], before)
                    grown[i] += more
                    if states[i] == 0 and not machine.is_empty(row[3], before):
                        ends[i][grown[i]] = ends[i].get(grown[i], 0) + 1
            listed = [{"entry": i, "depth": d, "n": n} for i in (0, 1) for d, n in ends[i].items()]
            yield pa.RecordBatch.from_pylist([dict(zip(_SPLIT, split, strict=True)) | {"mark": mark, "exits": states, "grown": grown, "ends": listed}], schema)

    schema = pa.schema(
        [("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("mark", pa.int32()), ("exits", pa.list_(pa.int32())), ("grown", pa.list_(pa.int64()))]
        + [("ends", pa.list_(pa.struct([("entry", pa.int32()), ("depth", pa.int64()), ("n", pa.int64())])))]
    )
    return pieces.mapInArrow(
        report, "path string, start long, length long, mark int, exits array<int>, grown array<long>, ends array<struct<entry:int,depth:long,n:long>>"
    )


def _entries(reports: DataFrame, machine: Machine) -> DataFrame:
    """A row per split: its state and depth at the start, the records that ended before, and whether one is open."""

    def compose(splits: pd.DataFrame) -> pd.DataFrame:
        splits = splits.sort_values("start")
        mark = int(splits["mark"].iloc[0])
        state, depth, before, base, out = 0, 0, 0, machine.base(mark), []
        for i, row in enumerate(splits.itertuples()):
            out.append((row.path, row.start, row.length, mark, state, depth, before, i > 0 and (state, depth) != (0, base)))
            before += sum(e["n"] for e in row.ends if e["entry"] == state and depth + e["depth"] == base)
            depth += int(row.grown[state])
            state = int(row.exits[state])
        return pd.DataFrame(out, columns=[*_SPLIT, "mark", "state", "depth", "before", "open"])

    entries = reports.groupBy("path").applyInPandas(
        compose, "path string, start long, length long, mark int, state int, depth long, before long, open boolean"
    )
    return entries.withColumnsRenamed({c: f"of_{c}" for c in _SPLIT})


def _cut(pieces: DataFrame, machine: Machine) -> DataFrame:
    """Records by number in their file, and the parts of those that lie across split ends."""
    known = ["mark", "state", "depth", "before", "open"]

    def cut(batches):
        found: list[tuple] = []
        for (path, start, *_), rows in groupby(_rows(batches, [*_SPLIT, *known, "value"]), key=lambda r: r[:3]):
            held: list[str] = []
            first = None
            for row in rows:
                if first is None:
                    first = row
                    mark, state, depth, number, whole = row[3:8]
                    whole, base = not whole, machine.base(mark)
                before = state
                state, more = machine.step(row[8], before)
                depth += more
                if machine.is_empty(row[8], before):
                    continue
                held.append(row[8])
                if state == 0 and depth == base:
                    found.append((path, number, start, whole, machine.joined(held)))
                    number, held, whole = number + 1, [], True
                    if len(found) == 1_024:
                        yield table(found)
                        found = []
            if held:
                found.append((path, number, start, False, machine.joined(held)))
        yield table(found)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * 5, schema, strict=True)], schema=schema)

    schema = pa.schema([("path", pa.string()), ("number", pa.int64()), ("start", pa.int64()), ("whole", pa.bool_()), ("record", pa.string())])
    return pieces.mapInArrow(cut, "path string, number long, start long, whole boolean, record string")


def records(spark: SparkSession, path: str, machine: Machine) -> DataFrame:
    """(path, number, record) of all files under ``path``; records are numbered from 0 in each file.

    Both passes must see the same splits; a split that the first did not report raises an
    error. The table of splits, which is broadcast, has one row per
    ``spark.sql.files.maxPartitionBytes`` of input. A record that is never closed
    reaches to the end of its file, as in a read by one task.
    """
    pieces = _pieces(spark, path, machine)
    entries = durable(_entries(durable(_reports(pieces, machine)), machine))
    same = [F.col(c) == F.col(f"of_{c}") for c in _SPLIT]
    placed = pieces.join(F.broadcast(entries), same[0] & same[1] & same[2], "left").select(
        *_SPLIT,
        "mark",
        F.coalesce("state", F.raise_error(F.lit("the splits changed between two passes over a file")).cast("int")).alias("state"),
        "depth",
        "before",
        "open",
        "value",
    )
    cut = durable(_cut(placed, machine))
    parts = cut.where(~F.col("whole")).groupBy("path", "number").agg(F.sort_array(F.collect_list(F.struct("start", "record"))).alias("parts"))
    across = parts.select("path", "number", F.array_join(F.col("parts.record"), machine.joint).alias("record"))
    return cut.where("whole").select("path", "number", "record").unionByName(across)


def running_numbers(found: DataFrame, first: int = 0) -> DataFrame:
    """``records`` with ``ordinal``, gapless over all files by path, without the first ``first`` of each."""
    kept = found.where(F.col("number") >= first)
    sizes = durable(kept.groupBy("path").agg(F.count(F.lit(1)).alias("n")))
    # One row per file.
    before = F.coalesce(F.sum("n").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = durable(sizes.select(F.col("path").alias("of_path"), before.alias("files_before")))
    joined = kept.join(offsets, F.col("path") == F.col("of_path"))
    return joined.withColumn("ordinal", F.col("files_before") + F.col("number") - first).drop("of_path", "files_before")

"""CSV records with line breaks in quoted fields, read by many tasks a file.

Whether a line break ends a record depends on all quotes before it. A split of a file can't know
these, but it can say what it does to either state: start outside quotes and end so, start
inside and end so. These small functions, one row a split, compose associatively: the state in which each
split starts follows from a window over them. So the file is read twice, in parallel: once for the
functions, and once, with the states, to put lines together to records. What a split holds of a record
that began in an earlier one is glued to it afterwards: two rows a split at most.

Within a task lines come in the order of the file; a record is held in memory whole, as anywhere. Blank
lines between records are no records. A quote opens a field only where the field begins, a doubled one is a character, and what
follows a closing quote belongs to the field. Files are UTF-8 or any other superset of ASCII, lines end with LF or CR LF.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged

_CLOSE = re.compile(rb'[^"]*(?:""[^"]*)*"(?!")')

BROADCAST_SPLITS = 500_000  # a hundred bytes each
BLANK = bytes(range(33))  # what a blank line may hold


def ends_open(line: bytes, opened: bool, delimiter: bytes = b",") -> bool:
    """Whether a quoted field is open after a line, given whether one was before."""
    at = 0
    while True:
        if opened or line[at:at + 1] == b'"':
            closed = _CLOSE.match(line, at if opened else at + 1)
            if closed is None:
                return True
            at, opened = closed.end(), False
        following = line.find(delimiter + b'"', at)
        if following < 0:
            return False
        at = following + len(delimiter)


class Lines:
    """What quotes do in an array of lines.

    Where every quote that would open a field stands at the line's start, after a delimiter or after another
    quote, each quote just changes the state; which quotes would open one depends on the state before. The other
    lines, ``stray`` in a state, are read by :func:`ends_open`. ``filled`` lines hold more than blanks."""

    def __init__(self, lines: pa.LargeBinaryArray, delimiter: bytes = b","):
        self.lines, self.delimiter = lines, delimiter
        n = len(lines)
        bounds = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + n + 1]
        data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)
        starts, ends = bounds[:-1], bounds[1:]
        quotes = np.flatnonzero(data[bounds[0]:bounds[-1]] == ord('"')) + bounds[0]
        line = np.searchsorted(ends, quotes, side="right")
        many = np.bincount(line, minlength=n)
        place = np.arange(len(quotes)) - (np.cumsum(many) - many)[line]  # of a quote among its line's
        before = data[np.maximum(quotes - 1, 0)]
        stray = (quotes != starts[line]) & (before != delimiter[-1]) & (before != ord('"'))
        self.odd = many % 2 == 1
        self.stray = [np.bincount(line[stray & (place % 2 == opening)], minlength=n) > 0 for opening in (0, 1)]
        self.filled = ends > starts
        self.filled[self.filled] = data[starts[self.filled]] > 32
        for k in np.flatnonzero(~self.filled & (ends > starts)).tolist():
            self.filled[k] = bool(lines[k].as_py().strip(BLANK))

    def states(self, opened: bool) -> np.ndarray:
        """Whether quotes are open before each line, and after the last one."""
        out = opened ^ (np.cumsum(np.r_[False, self.odd]) % 2 == 1)
        at = 0
        while True:
            stray = np.where(out[at:-1], self.stray[1][at:], self.stray[0][at:])
            for k in (np.flatnonzero(stray) + at).tolist():
                after = ends_open(self.lines[k].as_py(), bool(out[k]), self.delimiter)
                if after != out[k + 1]:
                    out[k + 1:] ^= True
                    at = k + 1
                    break
            else:
                return out


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("blk"),
                       F.monotonically_increasing_id().alias("mid"), F.col("value").cast("binary").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """((file, split), rows) of consecutive rows of one split; a task may read several."""
    blocks, files = batch.column(1).to_numpy(), pc.dictionary_encode(batch.column(0)).indices.to_numpy()
    heads = np.flatnonzero(np.r_[True, (blocks[1:] != blocks[:-1]) | (files[1:] != files[:-1])][:len(blocks)])
    for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(blocks)]):
        yield (batch.column(0)[a].as_py(), int(blocks[a])), batch.slice(a, b - a)


def split_functions(lines: DataFrame, delimiter: str = ",") -> DataFrame:
    """(file, blk, out, inside, starts_out, starts_inside): for a start outside and inside of quotes, whether the
    split ends inside, and how many records begin in it."""
    d = delimiter.encode()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for b in batches:
            for key, rows in _runs(b):
                split = found.setdefault(key, [False, True, 0, 0])
                lines_ = Lines(rows.column(2).cast(pa.large_binary()), d)
                states = lines_.states(split[0])
                both = [states, states if split[0] == split[1] else lines_.states(split[1])]  # they soon agree
                for i, states in enumerate(both):
                    split[i] = bool(states[-1])
                    split[2 + i] += int((~states[:-1] & lines_.filled).sum())
        yield pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.int64()),
            *(pa.array([s[i] for s in found.values()], t) for i, t in enumerate((pa.bool_(), pa.bool_(), pa.int64(), pa.int64())))],
            names=["file", "blk", "out", "inside", "starts_out", "starts_inside"])

    # a split is read by one task, whose rows of it are all there are
    return lines.select("file", "blk", "line").mapInArrow(run, "file string, blk long, out boolean, inside boolean, starts_out long, starts_inside long")


def split_states(functions: DataFrame) -> DataFrame:
    """(file, blk, opened, first): the state in which each split starts and the number of records of its file
    that begin before it. A function that does not look at the state sets it; since the last such one, every
    function that changes it counts."""
    by_file = Window.partitionBy("file").orderBy("blk")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    constant = F.col("out") == F.col("inside")
    swaps = F.col("out") & ~F.col("inside")
    f = functions.withColumn("_set", F.coalesce(F.sum(constant.cast("int")).over(before), F.lit(0)))  # constants before
    f = f.withColumn("_base", F.coalesce(F.last(F.when(constant, F.col("out")), True).over(before), F.lit(False)))
    # within the splits since the same constant; the constant itself, first of them, is no swap
    since = Window.partitionBy("file", "_set").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum(swaps.cast("int")).over(since), F.lit(0)) % 2 == 1
    f = f.withColumn("opened", F.col("_base") != odd)
    starts = F.when(F.col("opened"), F.col("starts_inside")).otherwise(F.col("starts_out"))
    return f.select("file", "blk", "opened", F.coalesce(F.sum(starts).over(before), F.lit(0)).alias("first"))


RECORD = "file string, blk long, number long, record binary, whole boolean"


def _records(lines: DataFrame, delimiter: str) -> DataFrame:
    """Rows of RECORD from lines with the state and first number of their split. ``number`` counts a file's
    records; a piece of a record that began before has the number of that, and is not whole."""
    d = delimiter.encode()

    def rows(key: tuple[str, int], first: int, parts: pa.LargeBinaryArray, bounds: np.ndarray, whole: np.ndarray) -> pa.RecordBatch:
        """Lines bounds[i] to bounds[i + 1] are the piece of number first + i."""
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), parts), pa.scalar(b"\n", pa.large_binary()))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[1:len(joined) + 1]
        data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)
        cr = (np.diff(np.r_[0, ends]) > 0) & whole
        cr[cr] = data[ends[cr] - 1] == 13
        if cr.any():  # of a line break CR LF
            joined = pc.if_else(pa.array(cr), pc.binary_slice(joined, 0, -1), joined)
        n = len(joined)
        return pa.RecordBatch.from_arrays([pa.array([key[0]] * n, pa.string()), pa.array(np.full(n, key[1])), pa.array(first + np.arange(n)),
                                           joined.cast(pa.binary()), pa.array(whole)], names=["file", "blk", "number", "record", "whole"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[str, int] | None = None
        held: list[pa.Array] = []  # lines of the record that is open
        number, opened, began = 0, False, True

        def piece() -> pa.RecordBatch:
            parts = pa.concat_arrays(held)
            return rows(at, number, parts, np.array([0, len(parts)]), np.array([False]))

        for b in batches:
            for key, run_ in _runs(b):
                if key != at:
                    if held:
                        yield piece()
                    at, held, opened = key, [], run_.column(3)[0].as_py()
                    began = not opened
                    number = run_.column(4)[0].as_py() - (1 if opened else 0)
                parts = run_.column(2).cast(pa.large_binary())
                lines_ = Lines(parts, d)
                states = lines_.states(opened)
                opened = bool(states[-1])
                kept = states[:-1] | lines_.filled
                if not kept.all():  # blank lines between records
                    parts, states = parts.filter(pa.array(kept)), np.r_[states[:-1][kept], opened]
                closed = np.flatnonzero(~states[1:])  # lines that end a record
                if not len(closed):
                    held.append(parts)
                    continue
                upto = int(closed[-1]) + 1
                before = sum(map(len, held))
                whole = np.ones(len(closed), bool)
                whole[0] = began
                yield rows(at, number, pa.concat_arrays([*held, parts.slice(0, upto)]), np.r_[0, closed + 1 + before], whole)
                number, began, held = number + len(closed), True, ([parts.slice(upto)] if upto < len(parts) else [])
        if held and sum(map(len, held)):
            yield piece()

    return lines.mapInArrow(run, RECORD)


def read_records(spark: SparkSession, paths: list[str], splits: int, delimiter: str = ",") -> tuple[DataFrame, DataFrame]:
    """(file, number, record) of CSV files (by ``_metadata.file_path``), numbered from 0 (the header) in each file, from pieces written once; and
    (file, records), their numbers. ``splits`` bounds the number of splits."""
    lines = _lines(spark, paths)
    functions = staged(split_functions(lines, delimiter), "quote-functions")
    states = staged(split_states(functions), "quote-states")
    if splits <= BROADCAST_SPLITS:  # lines stay where they are, in their order
        joined = lines.join(F.broadcast(states), ["file", "blk"])
    else:
        joined = lines.join(states, ["file", "blk"]).sortWithinPartitions("file", "blk", "mid")
    pieces = staged(_records(joined.select("file", "blk", "line", "opened", "first"), delimiter), "records")
    whole = pieces.where("whole").select("file", "number", F.col("record").cast("string").alias("record"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("blk", "record"))), lambda p: p["record"].cast("string"))
    glued = pieces.where(~F.col("whole")).groupBy("file", "number").agg(F.regexp_replace(F.array_join(ordered, "\n"), "\r$", "").alias("record"))
    started = F.when(F.col("opened"), F.col("starts_inside")).otherwise(F.col("starts_out"))
    counts = states.join(functions, ["file", "blk"]).groupBy("file").agg(F.sum(started).alias("records"))
    return whole.unionByName(glued), counts


def parsed(records: DataFrame, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """file, number and the fields of all records but the headers."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    fields = F.from_csv("record", ddl, {**options, "multiLine": "true"})
    return records.where("number > 0").select("file", "number", fields.alias("_f")).select("file", "number", "_f.*")

"""Records of multi-line CSV files, found in parallel.

A quoted field may hold newlines, so a byte range of a file does not tell where
its records begin: its first line may stand inside a field that an earlier range
opened.  Spark's text reader cuts files into ranges of whole lines; two passes
over them find the records:

1. ``survey`` reads each range under both assumptions -- it begins between two
   records, or inside a quoted field -- and gives, for each, how it ends and how
   many records begin in it.  The ranges of a file are then chained from its
   start, which settles every range's true state and its first record's number.
   One row a range goes to the driver, some 60 bytes for each
   ``spark.sql.files.maxPartitionBytes`` of input.
2. ``records`` reads the ranges again, each from its settled state.  A record that
   goes on in another range is put together from its parts: at most two for each
   range are shuffled.

So a file of any size is read by as many tasks as it has ranges.  A quote opens a
field only where a field begins, is doubled to stand for itself, and a backslash
is a character like others.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package

WHOLE, HEAD, TAIL = 0, 1, 2
BOM = b"\xef\xbb\xbf"
#: A line that starts outside a quoted field and plainly ends so: each field has no quote, or is quoted as a whole.
CLOSED = r'\A(?:[^",]*|"(?:[^"]|"")*")(?:,(?:[^",]*|"(?:[^"]|"")*"))*\z'


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line, given whether one is at its start."""
    at = 0
    while True:
        if inside:
            at = line.find(b'"', at)
            while at >= 0 and line[at + 1:at + 2] == b'"':
                at = line.find(b'"', at + 2)
            if at < 0:
                return True
            at, inside = at + 1, False
        elif line[at:at + 1] == b'"':
            at, inside = at + 1, True
            continue
        at = line.find(b",", at)
        if at < 0:
            return False
        at += 1


def states(lines: pa.Array, inside: bool) -> tuple[np.ndarray, bool]:
    """For each line whether it starts inside a field, and whether the last one ends so.

    Only quotes change it, and outside a field only those of lines that are not
    ``CLOSED``: these alone are looked through one by one.
    """
    out = np.empty(len(lines), bool)
    quoted = pc.match_substring(lines, b'"').to_numpy(zero_copy_only=False)
    closed = pc.match_substring_regex(lines, CLOSED).to_numpy(zero_copy_only=False)
    may_close, may_open = np.flatnonzero(quoted), np.flatnonzero(quoted & ~closed)
    done = 0
    while True:
        some = may_close if inside else may_open
        at = int(np.searchsorted(some, done))
        if at == len(some):
            break
        i = int(some[at])
        out[done:i + 1] = inside
        inside, done = ends_inside(lines[i].as_py(), inside), i + 1
    out[done:] = inside
    return out, inside


def blank(lines: pa.Array) -> np.ndarray:
    size = pc.binary_length(lines).to_numpy(zero_copy_only=False)
    out = size == 0
    for i in np.flatnonzero(size == 1).tolist():
        out[i] = lines[i].as_py() == b"\r"
    return out


def by_range(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """((file, block), lines) of (value, file, block) rows, in pieces that hold one range each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = (batch.column(k).to_numpy() for k in (1, 2))
        cut = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
            yield (int(file[a]), int(block[a])), batch.column(0).slice(a, b - a)


def _lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(list(files)).select(
        F.col("value").cast("binary").alias("value"), F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


@dataclass(frozen=True)
class Ranges:
    """The byte ranges of some files, sorted by file hash and start, each with its settled state."""

    file: np.ndarray
    block: np.ndarray
    inside: np.ndarray      # the range begins inside a quoted field
    row: np.ndarray         # number of the first record that begins in it; the header is 0
    names: dict[int, str]   # file hash -> file

    def find(self, file: int, block: int) -> int:
        a, b = np.searchsorted(self.file, [file, file + 1] if file < 2 ** 63 - 1 else [file, file])
        at = a + int(np.searchsorted(self.block[a:b], block))
        if at >= b or self.block[at] != block:
            raise RuntimeError("the files or their ranges changed between the two passes; read them again")
        return at


@dataclass(frozen=True)
class Export:
    """What a survey found: the files in load order, their headers and their records."""

    paths: list[str]                        # as Spark lists them
    uris: list[str]                         # as rows name them
    headers: list[tuple[str, ...] | None]   # None for a file without lines
    counts: list[int]                       # records without the header
    ranges: Ranges


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> list[tuple[str, str, int]]:
    """(path, uri, hash of the uri) of an export's files, in load order; no content is read."""
    listed = spark.read.format("binaryFile").load(list(paths) if not isinstance(paths, str) else paths)
    uri = F.col("_metadata.file_path")
    return sorted(tuple(r) for r in listed.select("path", uri.alias("uri"), F.xxhash64(uri).alias("file")).collect())


def header_names(header: bytes) -> tuple[str, ...]:
    """Column names of a header record; a name that was there before gets its place added."""
    names = next(csv.reader([header.removeprefix(BOM).decode().rstrip("\r")], strict=False), [])
    return tuple(n if n and n not in names[:i] else f"{n}_c{i}" for i, n in enumerate(names))


def _surveyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a range: for both assumptions how it ends and how many records begin; the header of a first range."""
    now, ends, count, header, open_header = None, [False, True], [0, 0], [], True

    def row() -> pa.RecordBatch:
        text = None if open_header or not header else b"\n".join(header)
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]]), pa.array([now[1]]), pa.array([ends[0]]), pa.array([ends[1]]), pa.array([count[0]]),
             pa.array([count[1]]), pa.array([text], pa.binary())],
            ["file", "block", "ends_out", "ends_in", "n_out", "n_in", "header"])

    for key, lines in by_range(batches):
        if key != now:
            if now:
                yield row()
            now, ends, count, header, open_header = key, [False, True], [0, 0], [], True
        empty = blank(lines)
        same = ends[0] == ends[1]
        for k in (0, 1):
            if not (k and same):    # both assumptions have met: what follows is the same for both
                starts, last = states(lines, ends[k])
            if k == 0 and key[1] == 0 and open_header:
                after = np.append(starts[1:], last)
                for i in range(len(lines)):
                    if header or not empty[i]:
                        header.append(lines[i].as_py())
                        if not after[i]:
                            open_header = False
                            break
            ends[k] = last
            count[k] += int((~starts & ~empty).sum())
    if now:
        yield row()


def survey(spark: SparkSession, paths: str | Sequence[str]) -> Export:
    """Read every range under both assumptions and chain them file by file."""
    ship_package(spark)
    files = list_files(spark, paths)
    if not files:       # files without content are not listed
        none = np.empty(0, np.int64)
        return Export([], [], [], [], Ranges(none, none, none.astype(bool), none, {}))
    found = _lines(spark, [p for p, _, _ in files]).mapInArrow(
        _surveyed, "file long, block long, ends_out boolean, ends_in boolean, n_out long, n_in long, header binary").collect()
    inside, row, headers, keys, starts, rows = False, 0, {}, [], [], []
    last, totals = None, {}
    for r in sorted(found, key=lambda r: (r["file"], r["block"])):
        if r["file"] != last:
            inside, row, last = False, 0, r["file"]
        keys.append((r["file"], r["block"]))
        starts.append(inside)
        rows.append(row)
        if r["header"] is not None:
            headers[last] = header_names(bytes(r["header"]))
        row += r["n_in"] if inside else r["n_out"]
        inside = r["ends_in"] if inside else r["ends_out"]
        totals[last] = row
    file, block = np.array(keys, np.int64).reshape(-1, 2).T
    ranges = Ranges(file, block, np.array(starts, bool), np.array(rows, np.int64), {f: uri for _, uri, f in files})
    return Export([p for p, _, _ in files], [u for _, u, _ in files], [headers.get(f) for *_, f in files],
                  [max(totals.get(f, 0) - 1, 0) for *_, f in files], ranges)


def _cut(ranges: Ranges):
    """The task that cuts ranges into records and into parts of records that go on elsewhere."""
    schema = pa.schema([("file", pa.string()), ("row", pa.int64()), ("block", pa.int64()), ("part", pa.int32()),
                        ("record", pa.binary())])

    def batch_of(key: tuple[int, int], rows: list, parts: list, records: pa.Array) -> pa.RecordBatch:
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([ranges.names[key[0]]] * n, pa.string()), pa.array(rows, pa.int64()),
             pa.array([key[1]] * n, pa.int64()), pa.array(parts, pa.int32()), records], schema=schema)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, row = None, False, 0
        held: list[bytes] | None = None     # lines of an open record
        held_row = None                     # its number; None for a part that began in an earlier range

        def rest() -> Iterator[pa.RecordBatch]:
            if held is not None:
                part = HEAD if held_row is None else TAIL
                yield batch_of(now, [held_row], [part], pa.array([b"\n".join(held)], pa.binary()))

        for key, lines in by_range(batches):
            if key != now:
                yield from rest()
                now, at = key, ranges.find(*key)
                inside, row = bool(ranges.inside[at]), int(ranges.row[at])
                held, held_row = ([], None) if inside else (None, None)
            starts, inside = states(lines, inside)
            after = np.append(starts[1:], inside)
            begins = ~starts & ~blank(lines)
            number = row + np.cumsum(begins) - 1
            row += int(begins.sum())
            single = np.flatnonzero(begins & ~after)
            if len(single):
                yield batch_of(key, number[single].tolist(), [WHOLE] * len(single), lines.take(pa.array(single)))
            for i in np.flatnonzero(starts | after).tolist():
                if not starts[i]:
                    held, held_row = [], int(number[i])
                held.append(lines[i].as_py())
                if not after[i]:
                    part = HEAD if held_row is None else WHOLE
                    yield batch_of(key, [held_row], [part], pa.array([b"\n".join(held)], pa.binary()))
                    held = None
        if now:
            yield from rest()

    return cut


def records(spark: SparkSession, export: Export, paths: Sequence[str]) -> DataFrame:
    """(file, row, record): the records of some of an export's files; row 0 is the header."""
    schema = "file string, row long, block long, part int, record binary"
    ranges = export.ranges
    found = _lines(spark, paths).mapInArrow(_cut(ranges), schema)
    out = found.where(F.col("part") == WHOLE)
    uri_of = dict(zip(export.paths, export.uris))
    split = {ranges.names[f] for f in ranges.file[ranges.inside].tolist()}
    parted = [p for p in paths if uri_of[p] in split]
    if parted:
        # a tail begins a record; the heads after it, of ranges that begin inside it, go on with it
        parts = _lines(spark, parted).mapInArrow(_cut(ranges), schema).where(F.col("part") != WHOLE)
        order = Window.partitionBy("file").orderBy("block", "part")
        parts = parts.withColumn("group", F.sum((F.col("part") == TAIL).cast("int")).over(order))
        pieces = F.sort_array(F.collect_list(F.struct("block", "part", F.col("record").cast("string").alias("text"))))
        joined = parts.groupBy("file", "group").agg(F.max("row").alias("row"), pieces.alias("pieces")).select(
            "file", "row", F.array_join(F.transform("pieces", lambda p: p["text"]), "\n").cast("binary").alias("record"))
        out = out.select("file", "row", "record").unionAll(joined)
    text = F.col("record").cast("string")
    return out.select("file", "row", F.when(text.endswith("\r"), text.substr(F.lit(1), F.length(text) - 1))
                      .otherwise(text).alias("record"))

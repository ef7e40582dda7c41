"""Records of large CSV files, read in parallel byte ranges.

A line break ends a record only outside quotes, and whether a byte lies inside
quotes depends on all quotes before it.  The parity of the quotes is counted
for each range in parallel, and the exclusive-or over the ranges before it
(a running sum modulo two) tells each range how it begins.  A range then owns
the records that start in it; it reads on to the end of its last one.  Nothing
is read whole: a task streams ``_CHUNK`` bytes at a time and holds one record.
Behind its end a range reads in small pieces, and no further where no record
starts in it, so short ranges of a long file don't read the file again and again.
Neighbouring short ranges go to one task, which opens their file once.

Lines end in \\n or \\r\\n.  Cells are parsed by Spark's ``from_csv``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendlake.sources import files

BOM = b"\xef\xbb\xbf"
RANGE_BYTES = 64 << 20
_CHUNK = 1 << 20
_SPAN, _BEHIND = 32 << 10, 1 << 10
_QUOTE, _BREAK = ord('"'), ord("\n")


def byte_ranges(spark: SparkSession, paths: list[str] | DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, start, stop, size) of every range of every file; a byte order mark is not cut.

    The workers look up the sizes, the driver has nothing to do for each file."""
    range_bytes = max(range_bytes, len(BOM))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = []
            for path in batch.column("path").to_pylist():
                filesystem, place = files.open_filesystem(path)
                lengths.append(filesystem.get_file_info(place).size)
                if lengths[-1] is None:
                    raise FileNotFoundError(path)
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(lengths, pa.int64())], ["path", "size"])

    listed = files.listed(spark, paths).mapInArrow(measure, "path string, size long").filter("size > 0")
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))
    return (listed.select("path", "size", F.explode(starts).alias("start"))
            .select("path", "start", F.least(F.col("start") + range_bytes, "size").alias("stop"), "size"))


def _dealt(ranges: DataFrame) -> DataFrame:
    """Ranges spread over the tasks, those of one file as well; ranges of one span stay together, in order."""
    span = F.floor(F.col("start") / _SPAN)
    return (ranges.repartition(8 * ranges.sparkSession.sparkContext.defaultParallelism, "path", span)
            .sortWithinPartitions("path", "start"))


def _opened(rows: list[dict]) -> Iterator[tuple[dict, pa.NativeFile]]:
    """Each row with its file, opened once for rows of one file that follow each other."""
    path, stream = None, None
    try:
        for row in rows:
            if row["path"] != path:
                if stream is not None:
                    stream.close()
                path = row["path"]
                filesystem, place = files.open_filesystem(path)
                stream = filesystem.open_input_file(place)
            yield row, stream
    finally:
        if stream is not None:
            stream.close()


def _pieces(stream, start: int, stop: int, behind: int = 0) -> Iterator[bytes]:
    """The bytes from ``start`` to ``stop``, then on to ``behind`` in pieces that start small."""
    stream.seek(start)
    step = _BEHIND
    while start < max(stop, behind):
        if start < stop:
            n = min(_CHUNK, stop - start)
        else:
            n, step = min(_CHUNK, step, behind - start), 2 * step
        piece = stream.read(n)
        if not piece:
            return
        start += len(piece)
        yield piece


def with_state(ranges: DataFrame) -> DataFrame:
    """The ranges with ``quoted`` (whether they begin inside quotes) and ``head`` (nothing but blanks before)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quotes, blank = [], []
            for row, stream in _opened(batch.to_pylist()):
                n, empty = 0, True
                for piece in _pieces(stream, row["start"], row["stop"]):
                    n += piece.count(b'"')
                    empty = empty and not (piece.removeprefix(BOM) if not row["start"] else piece).strip()
                quotes.append(n % 2)
                blank.append(empty)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(quotes, pa.int64()), pa.array(blank, pa.bool_())],
                                             ["path", "start", "stop", "size", "odd", "blank"])

    before = W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    counted = _dealt(ranges).mapInArrow(count, "path string, start long, stop long, size long, odd long, blank boolean")
    return counted.select("path", "start", "stop", "size",
                          (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("quoted"),
                          F.coalesce(F.every("blank").over(before), F.lit(True)).alias("head"))


def _owned(stream, start: int, stop: int, size: int, quoted: bool) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of the records that start in a range."""
    at_start = start == 0
    if start:
        stream.seek(start - 1)
        at_start = stream.read(1) == b"\n" and not quoted
    offset = start if at_start else None  # of the record being read; None: one of a range before
    held: list[bytes] = []
    place = start
    for piece in _pieces(stream, start, stop, size):
        raw = np.frombuffer(piece, np.uint8)
        inside = (np.cumsum(raw == _QUOTE) + quoted) & 1
        quoted = bool(inside[-1])
        first = 0
        for end in np.flatnonzero((raw == _BREAK) & (inside == 0)).tolist():
            if offset is not None:
                yield offset, b"".join([*held, piece[first:end]])
            held, first, offset = [], end + 1, place + end + 1
            if offset >= stop:
                return
        if offset is not None:
            held.append(piece[first:])
        place += len(piece)
        if offset is None and place >= stop:
            return  # the range lies within a record that starts before it
    if offset is not None and offset < size:
        yield offset, b"".join(held)


def records(spark: SparkSession, paths: list[str] | DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, offset, record) of every record that is not blank, without the header."""
    ranges = with_state(byte_ranges(spark, paths, range_bytes))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["path", "offset", "record"], [pa.string(), pa.int64(), pa.string()]
        for batch in batches:
            out, held = [], 0
            for row, stream in _opened(batch.to_pylist()):
                head = row["head"]
                for offset, raw in _owned(stream, row["start"], row["stop"], row["size"], row["quoted"]):
                    body = (raw.removeprefix(BOM) if offset == 0 else raw).removesuffix(b"\r")
                    if head:  # the first record with anything in it is the header
                        head = not body.strip()
                    elif body:
                        out.append((row["path"], offset, body.decode("utf-8", "replace")))
                        held += len(body)
                    if held >= _CHUNK:
                        yield _batch(out, names, kinds)
                        out, held = [], 0
            if out:
                yield _batch(out, names, kinds)

    return _dealt(ranges).mapInArrow(read, "path string, offset long, record string")


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

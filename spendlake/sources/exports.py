"""Bank export CSVs -> export rows, headers bound by name per file.

The files are ``;``-separated, quoted, multi-line UTF-8 text (the reader drops
the BOM).  The first record of each file is its header.  The workers read just
that record, files with the same header form a layout, and each layout is one
scan with the header's own width, so columns come in any order and number, and
a layout without the currency column binds correctly.  Records are read once;
nothing joins, sorts or shuffles them.  Files are the unit of parallelism
(Spark does not split multi-line CSV inside a file) unless ``range_bytes`` or
``split_files`` is set.

A scan keeps every file's path, status and split on the driver.  More than
``GROUP_FILES`` files are therefore listed by a worker, kept as a table by header
and scanned in groups, whose cells are stored in the session's shared folder
(``session.checkpoint_dir``); the driver holds one group at a time.

Errors follow the strict load: a missing required header fails at once; an
empty amount, an empty currency under a present header or a malformed date
fail the job naming the file.  ``on_error="reject"`` instead routes rows with
an empty amount or currency to a rejects frame.
"""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import islice
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake import fixed_values as FV
from spendlake.functions.text import decode_file_name, parse_locale_decimal, pending_to_null
from spendlake.schemas import EXPORT_ROWS, POSITION
from spendlake.session import checkpoint_dir, settings
from spendlake.sources import files, ranges

FIELDS = ["posting_date", "amount", "sender", "recipient", "name", "description", "balance",
          "currency", "reconciled"]
REQUIRED = [f for f in FIELDS if f != "currency"]
COLUMNS = EXPORT_ROWS.fieldNames()
_CHUNK = 64 << 10
GROUP_FILES = 10_000


def export_paths(spark: SparkSession, path) -> list[str]:
    """The ``*.csv`` directly inside a folder, one file, or a list of files."""
    if isinstance(path, (list, tuple)):
        return sorted(path)
    return files.matching(spark, path if path.endswith(".csv") else path.rstrip("/") + "/*.csv")


def _first_record(stream) -> list[str]:
    """Cells of the first non-empty record; reads no further than its end."""
    raw, quoted, at, start = b"", False, 0, 0
    while True:
        more = stream.read(_CHUNK)
        raw += more
        while at < len(raw):
            c = raw[at:at + 1]
            if c == b'"':
                quoted = not quoted
            elif c in b"\r\n" and not quoted:
                if raw[start:at].removeprefix(b"\xef\xbb\xbf").strip():
                    break
                start = at + 1
            at += 1
        if at < len(raw) or not more:
            text = raw[start:at].decode("utf-8-sig")
            return next(csv.reader(io.StringIO(text, newline=""), delimiter=";"), [])


def _headers(paths: DataFrame) -> DataFrame:
    """(header, paths) of listed files, several rows for a header; the workers read the headers.
    Files without any record are left out."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[tuple[str, ...], list[str]] = {}
            for name in batch.column("path").to_pylist():
                filesystem, place = files.open_filesystem(name)
                with filesystem.open_input_stream(place, compression=None) as stream:
                    held.setdefault(tuple(_first_record(stream)), []).append(name)
            texts = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([list(h) for h in held], texts),
                                              pa.array(list(held.values()), texts)], ["header", "paths"])

    return paths.mapInArrow(read, "header array<string>, paths array<string>").filter("size(header) > 0")


def layouts(spark: SparkSession, path) -> dict[tuple[str, ...], list[str]]:
    """header -> files with that header, on the driver; files without any record are left out."""
    paths = export_paths(spark, path)
    if not paths:
        return {}
    out: dict[tuple[str, ...], list[str]] = {}
    for r in _headers(files.listed(spark, paths)).collect():
        out.setdefault(tuple(r["header"]), []).extend(r["paths"])
    return {h: sorted(ps) for h, ps in sorted(out.items())}


def _found(spark: SparkSession, path) -> list[str] | DataFrame:
    """The export files as ``export_paths`` has them; as rows (``path``) where there are more than ``GROUP_FILES``."""
    if isinstance(path, (list, tuple)) or path.endswith(".csv"):
        paths = export_paths(spark, path)
        return paths if len(paths) <= GROUP_FILES else files.listed(spark, paths)
    listing = files.in_folder(spark, path.rstrip("/") or "/", ".csv")
    few = [r["path"] for r in listing.take(GROUP_FILES + 1)]
    return sorted(few) if len(few) <= GROUP_FILES else files.listed(spark, listing)


def _groups(paths: DataFrame, n: int) -> Iterator[list[str]]:
    """The ``n`` paths by name, ``GROUP_FILES`` at a time."""
    in_order = (paths.repartitionByRange(-(-n // GROUP_FILES), "path").sortWithinPartitions("path")
                .toLocalIterator())
    while group := [r["path"] for r in islice(in_order, GROUP_FILES)]:
        yield group


def _scan_groups(spark: SparkSession, paths: DataFrame, n: int, width: int, split_files: bool, place: str) -> DataFrame:
    """The cells that ``scan`` gives of ``n`` files, stored at ``place`` group by group."""
    tasks = 8 * spark.sparkContext.defaultParallelism
    for group in _groups(paths, n):
        # many small files to a task, and nothing kept of a group that is done
        with settings(spark, spark__sql__files__openCostInBytes=128 << 10, spark__sql__files__minPartitionNum=tasks,
                      spark__sql__hive__filesourcePartitionFileCacheSize=0):
            scan(spark, group, width, split_files).write.mode("append").parquet(place)
    stored = T.StructType([*_cells(width), T.StructField("source_file", T.StringType()),
                           T.StructField("row_in_file", POSITION)])
    return spark.read.schema(stored).parquet(place)


def _bound_groups(spark: SparkSession, paths: DataFrame, mapping: dict[str, str] | None, pending_marker: str,
                  default_currency: str, split_files: bool, range_bytes: int | None) -> list[DataFrame]:
    """``bind`` of each layout's cells, with the paths in a table: no list of all files on the driver."""
    scratch = f"{checkpoint_dir(spark).rstrip('/')}/spendlake-scan-{uuid.uuid4().hex}"
    _headers(paths).select("header", F.explode("paths").alias("path")).write.parquet(f"{scratch}/files")
    found = spark.read.parquet(f"{scratch}/files")
    held = found.groupBy("header").agg(F.min("path").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    held = sorted((tuple(r["header"]), r["first"], r["n"]) for r in held)
    for header, first, _ in held:  # before anything is scanned
        _check_header(header, mapping, first)
    parts = []
    for k, (header, _, n) in enumerate(held):
        own = found.filter(F.col("header") == F.array(*[F.lit(h) for h in header])).select("path")
        cells = (scan_ranges(spark, own, len(header), range_bytes) if range_bytes
                 else _scan_groups(spark, own, n, len(header), split_files, f"{scratch}/{k}"))
        parts.append(bind(cells, header, mapping, pending_marker, default_currency))
    return parts


def _csv_options() -> dict[str, str]:
    return dict(sep=";", quote='"', escape='"', mode="PERMISSIVE", nullValue="", emptyValue="")


def _cells(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])


def scan_ranges(spark: SparkSession, paths: list[str] | DataFrame, width: int, range_bytes: int) -> DataFrame:
    """The same cells as ``scan`` gives, from byte ranges of the files: quoted line breaks
    are allowed, and one huge file is read by many tasks.  The position is the record's offset."""
    found = ranges.records(spark, paths, range_bytes)
    name = F.element_at(F.split("path", "/"), -1)
    columns = _cells(width).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    # a generated row is parsed once; as a struct's fields each use of a cell would parse the record again
    return found.select(F.inline(F.array(F.from_csv("record", columns, _csv_options()))),
                        name.alias("source_file"),
                        F.struct(F.lit(0).cast("long").alias("split_start"), F.col("offset").alias("record"))
                        .alias("row_in_file"))


def scan(spark: SparkSession, paths: list[str], width: int, split_files: bool = False) -> DataFrame:
    """Positional cells ``_c0`` .. of every record below the header, with file name and order.

    By default a file is read whole (quoted fields may hold line breaks).
    ``split_files=True`` reads line by line and lets Spark split a large file
    into byte ranges -- for exports known to hold no quoted line breaks.  The
    position in the file is (split start, record id): the id grows with the
    file position inside a split, the split start orders the splits."""
    # Spark looks up the files in a job of up to 10,000 tasks, one for each file
    tasks = 8 * spark.sparkContext.defaultParallelism
    with settings(spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=tasks):
        reader = (spark.read.schema(_cells(width))
                  .options(header=True, enforceSchema=True, multiLine=not split_files, encoding="UTF-8",
                           **_csv_options()))
        df = reader._df(reader._jreader.csv(files.java_texts(spark, paths)))
    return df.select("*", decode_file_name(F.col("_metadata.file_name")).alias("source_file"),
                     F.struct(F.col("_metadata.file_block_start").alias("split_start"),
                              F.monotonically_increasing_id().alias("record")).alias("row_in_file"))


def positions(header, mapping: dict[str, str] | None = None) -> dict[str, int]:
    """Field -> position; of a repeated header name the last column counts."""
    mapping = FV.HEADER_TO_FIELD if mapping is None else mapping
    return {mapping.get(h, h): i for i, h in enumerate(header) if mapping.get(h, h) in FIELDS}


def _check_header(header, mapping: dict[str, str] | None = None, path: str | None = None) -> None:
    at = positions(header, mapping)
    of = f" of file '{unquote(path.rsplit('/', 1)[-1])}'" if path else ""
    for f in REQUIRED:
        if f not in at:
            raise ValueError(f"Missing column for field '{f}' in header {list(header)}{of}")


def bind(cells: DataFrame, header, mapping: dict[str, str] | None = None,
         pending_marker: str = FV.PENDING_MARKER, default_currency: str = FV.DEFAULT_CURRENCY) -> DataFrame:
    """Fields of the records of one layout: COLUMNS but for the amount, which stays text
    (``amount_text``), and ``reason`` of rejected rows.  Records without a value are left out."""
    _check_header(header, mapping)
    at = positions(header, mapping)
    filled = [F.col(f"_c{i}") != "" for i in range(len(header))]
    is_data = F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in filled]), F.lit(False))

    def field(name: str) -> Column:
        # NULL for other records, so that no check can be evaluated on them
        return F.when(F.col("_is_data"), F.nullif(F.col(f"_c{at[name]}"), F.lit("")))

    rows = cells.withColumn("_is_data", is_data).filter("_is_data")
    currency = field("currency") if "currency" in at else F.lit(default_currency)
    no_currency = F.col("_is_data") & currency.isNull()
    return rows.select(
        pending_to_null(field("posting_date"), pending_marker).alias("posting_date_text"),
        field("amount").alias("amount_text"),
        *[field(f).alias(f) for f in ("sender", "recipient", "name", "description")],
        parse_locale_decimal(field("balance")).alias("balance"),
        currency.alias("currency"), field("reconciled").alias("reconciled"), "source_file", "row_in_file",
        F.when(field("amount").isNull(), F.lit("empty amount")).when(no_currency, F.lit("empty currency"))
         .alias("reason"))


def _strict(bound: DataFrame) -> DataFrame:
    message = F.concat(F.lit("Empty required value (amount or currency) in file '"), F.col("source_file"),
                       F.lit("' at record "), F.to_json(F.struct("row_in_file")))
    amount = F.when(F.col("reason").isNotNull(), F.raise_error(message)).otherwise(
        parse_locale_decimal(F.col("amount_text")))
    return bound.withColumn("amount", amount).select(*COLUMNS)


def split_rejects(bound: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): rejects have an empty amount, or an empty currency under a currency header."""
    good = bound.filter("reason IS NULL").withColumn("amount", parse_locale_decimal(F.col("amount_text")))
    rejects = bound.filter("reason IS NOT NULL").select(
        "reason", "source_file", "row_in_file", "posting_date_text", "amount_text", "description", "name")
    return good.select(*COLUMNS), rejects


def read_exports(spark: SparkSession, path, mapping: dict[str, str] | None = None,
                 on_error: str = "fail", pending_marker: str = FV.PENDING_MARKER,
                 default_currency: str = FV.DEFAULT_CURRENCY, split_files: bool = False,
                 range_bytes: int | None = None):
    """Export rows (``schemas.EXPORT_ROWS``) of every CSV in ``path``.

    ``range_bytes`` reads files in byte ranges of that size, with line breaks in
    quotes (``sources.ranges``); ``split_files`` is for files known to hold none.
    Returns the rows, or ``(rows, rejects)`` when ``on_error="reject"``."""
    if on_error not in ("fail", "reject"):
        raise ValueError("on_error must be 'fail' or 'reject'")
    found, parts = _found(spark, path), []
    if isinstance(found, DataFrame):
        parts = _bound_groups(spark, found, mapping, pending_marker, default_currency, split_files, range_bytes)
    else:
        for header, paths in layouts(spark, found).items():
            _check_header(header, mapping, paths[0])
            cells = (scan_ranges(spark, paths, len(header), range_bytes) if range_bytes
                     else scan(spark, paths, len(header), split_files))
            parts.append(bind(cells, header, mapping, pending_marker, default_currency))
    if not parts:
        # no file with a header: no rows (the position column has the scan's type)
        position = "row_in_file struct<split_start:bigint,record:bigint>"
        bound = spark.createDataFrame([], "posting_date_text string, amount_text string, sender string, recipient "
                                          "string, name string, description string, balance decimal(18,2), currency "
                                          f"string, reconciled string, source_file string, {position}, reason string")
    else:
        bound = reduce(DataFrame.unionByName, parts)
    return _strict(bound) if on_error == "fail" else split_rejects(bound)


def export_files(spark: SparkSession, path) -> DataFrame:
    """One row (``source_file``) per listed export file, with or without records."""
    names = [(p.rsplit("/", 1)[-1],) for p in export_paths(spark, path)]
    return spark.createDataFrame(names, "source_file string")

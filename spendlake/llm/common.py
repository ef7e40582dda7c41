"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendlake.session import checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/spendlake-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    The rows are computed once (``checkpoint()`` would compute them twice),
    and later stages survive the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name, k = f"__{base}", 0
    while name.lower() in taken:
        k += 1
        name = f"__{base}{k}"
    return name


def release_memory() -> None:
    """Give back what a worker's allocators hold but do not use, at the end of a partition."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def with_results(docs: DataFrame, fields: str, function: Callable[[pa.Array], list[pa.Array]],
                 block_bytes: int = 1 << 20) -> DataFrame:
    """``docs`` with further columns (``fields``: a DDL list) that ``function`` makes from the texts.

    The workers see about ``block_bytes`` of text at a time."""
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(fields).fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", block_bytes):
            yield pa.RecordBatch.from_arrays([*part.columns, *function(part.column("text"))], names)
        release_memory()

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column | str, modulus: int, remainder: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus`` equals ``remainder``; a null id is never held out."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes`` per slice.

    Every row is passed on; a single longer text makes a slice of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            if size and size + n > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < len(lengths):
            yield batch.slice(start)

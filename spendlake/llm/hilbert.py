"""Sharding along a Hilbert curve, for pruning on several columns at once.

Three metadata dimensions are quantised to ``bits`` bits each: the text's size
(thirds of a power of two, so order is kept), and lang and source (by a hash,
so equal values share a cell; null has a cell of its own).  Rows are ordered by
the index of their cell on the Hilbert curve, which steps from a cell to a
neighbour only, then by size, text checksum and doc_id, and the order is cut
into runs of equal numbers of rows: law ``rows``.  Shard s holds the ranks
floor(s * n / shards) to floor((s + 1) * n / shards) - 1, so counts differ by
one at most, and slot is the rank within the shard.

The order is found on narrow rows (no texts): one range-partitioned sort,
written to the shared checkpoint folder with each row's place in its
partition; the number of rows of each partition, a list as long as there are
partitions, turns places into ranks.  Rows of a crowded cell are told apart by
the further keys, so no cell has to fit one task.

``write_runs`` writes whole documents in curve order, ``run_bounds`` gives the
bounds of every dimension for each file, and ``files_to_read`` prunes.

Defined cases: a null text has size 1 and the checksum of the empty text; null
lang and source have their own cell; repeated rows each get a slot; an empty
table gives no rows; other columns, whatever their names, are ignored by
``assign`` and kept by ``write_runs``.  A very long text counts with its whole
size, like any other; ``assign`` does not move it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm.common import cut, unused

BITS = 6


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``axes`` (n rows, one column per dimension)."""
    x = axes.astype(np.uint64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        q, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(b)) & np.uint64(1) == 1, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return out.astype(np.int64)


def curve(axes: list[Column], bits: int = BITS) -> Column:
    """Column expression: the Hilbert index of quantised axes."""

    @F.pandas_udf("long")
    def index(*columns: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([c.to_numpy() for c in columns], axis=1), bits))

    return index(*axes)


def text_size(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def axes(docs: DataFrame, bits: int = BITS) -> list[Column]:
    """The quantised dimensions of a documents table, each in 0 .. 2 ** bits - 1."""
    cells = 1 << bits
    size = F.least(F.floor(F.log2(text_size(F.col("text"))) * 3), F.lit(cells - 1)).cast("long")

    def named(column: str) -> Column:
        if column not in docs.columns:
            return F.lit(0).cast("long")
        return F.when(F.col(column).isNull(), F.lit(0)).otherwise(
            1 + F.crc32(F.col(column).cast("string").cast("binary")) % (cells - 1)).cast("long")

    return [size, named("lang"), named("source")]


def assign(docs: DataFrame, shards: int = 8, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert of every row."""
    # rows equal in all else are told apart by their place, so that no range must hold them all
    narrow = cut(docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text_size(F.col("text")).alias("size"),
                             F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                             curve(axes(docs, bits), bits).alias("hilbert")), "curve")
    keys = ["hilbert", "size", "text_crc32", "doc_id", "row"]
    placed = cut(narrow.repartitionByRange(*keys).sortWithinPartitions(*keys)
                 .withColumn("place", F.monotonically_increasing_id()), "order")
    part, inside = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # one per partition
    before, total = [], 0
    for r in sorted(counts, key=lambda r: r["part"]):
        before.append((r["part"], total))
        total += r["n"]
    offsets = docs.sparkSession.createDataFrame(before, "part long, before long")
    ranked = (placed.withColumn("part", part).join(F.broadcast(offsets), "part")
              .withColumn("rank", F.col("before") + inside))
    shard = F.expr(f"CAST(((rank + 1) * {shards} - 1) DIV {max(total, 1)} AS INT)")
    first = F.expr(f"(CAST(shard AS BIGINT) * {total}) DIV {shards}")
    return (ranked.withColumn("shard", shard)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("rank") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert"))


def write_runs(docs: DataFrame, path: str, runs: int, bits: int = BITS) -> None:
    """Write whole documents in curve order as about ``runs`` files."""
    index, size, row = (unused(docs, name) for name in ("hilbert", "size", "row"))
    keyed = docs.select("*", curve(axes(docs, bits), bits).alias(index), text_size(F.col("text")).alias(size),
                        F.monotonically_increasing_id().alias(row))
    order = [index, size, "doc_id", row]
    (keyed.repartitionByRange(runs, *order).sortWithinPartitions(*order).drop(index, size, row)
     .write.mode("overwrite").parquet(path))


def run_bounds(spark: SparkSession, path: str) -> DataFrame:
    """For each file: rows, the smallest and largest size, and the langs and sources in it."""
    docs = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    size = text_size(F.col("text"))
    return docs.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.min(size).alias("min_size"), F.max(size).alias("max_size"),
        F.collect_set("lang").alias("langs"), F.collect_set("source").alias("sources"))


def files_to_read(bounds: DataFrame, lang: str | None = None, source: str | None = None,
                  size: tuple[int, int] | None = None) -> DataFrame:
    """The files that can hold rows with these values."""
    out = bounds
    if lang is not None:
        out = out.filter(F.array_contains("langs", lang))
    if source is not None:
        out = out.filter(F.array_contains("sources", source))
    if size is not None:
        out = out.filter((F.col("max_size") >= size[0]) & (F.col("min_size") <= size[1]))
    return out.select("file")

"""Trigrams of each stored file, to find the files a search has to read.

A search term is a regular expression, matched without regard to case.  Where
it holds runs of plain ASCII characters, every match holds their trigrams, so
files without them need not be read.  Texts and terms are folded the way the
matcher folds ASCII letters: lower case, and the four other characters that it
takes for one (long s, Kelvin sign, dotted capital and dotless small i)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from spendlake.sources import files

#: What the case-insensitive matcher takes for an ASCII letter, and that letter.
FOLDED, FOLDED_TO = "ſKİı", "skii"
SEARCHED = ["transaction_description", "counterparty_name"]
SCHEMA = "file string, trigram string"
_UNREAD = "()[]\\"  # groups, classes and escapes: not looked into
_REPEATS = "*?{"


def _folded() -> Column:
    """The searched texts of a row, folded; each ends with a NUL, so no trigram spans two."""
    return F.lower(F.translate(F.concat_ws("\0", *SEARCHED, F.lit("")), FOLDED, FOLDED_TO)).cast("binary")


def _of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, trigram) of each batch of (file, text): windows of three printable ASCII bytes, each once a file.

    A byte of a longer character is never ASCII, so windows of bytes are windows of characters."""
    for batch in batches:
        found = zip(batch.column("file").to_pylist(), batch.column("text").to_pylist(), strict=True)
        for file, rows in groupby(found, itemgetter(0)):
            raw = np.frombuffer(b"".join(text for _, text in rows), np.uint8)
            plain = (raw >= 0x20) & (raw <= 0x7E)
            at = np.flatnonzero(plain[:-2] & plain[1:-1] & plain[2:])
            codes = np.unique(raw[at].astype(np.int32) << 16 | raw[at + 1].astype(np.int32) << 8 | raw[at + 2])
            chars = np.column_stack([codes >> 16, codes >> 8 & 255, codes & 255]).astype(np.uint8).tobytes().decode()
            each = [chars[k:k + 3] for k in range(0, len(chars), 3)]
            yield pa.RecordBatch.from_arrays([pa.array([file] * len(each), pa.string()), pa.array(each, pa.string())],
                                             ["file", "trigram"])


def write(spark: SparkSession, data_path: str, index_path: str) -> None:
    """Index the files of ``data_path``: one row for each (trigram, file), ordered by trigram.

    A task cuts the texts of its files a batch at a time and drops repeats before the
    shuffle; a file has as many trigrams as its alphabet allows, however many rows it has."""
    if not files.exists(spark, data_path):  # a part without rows
        spark.createDataFrame([], SCHEMA).write.parquet(index_path)
        return
    rows = spark.read.parquet(data_path).select(F.col("_metadata.file_path").alias("file"), _folded().alias("text"))
    rows.mapInArrow(_of_batches, SCHEMA).distinct().sort("trigram").write.parquet(index_path)


def required(term: str | None) -> list[set[str]] | None:
    """For each alternative of a term the trigrams that every match of it holds; None: all files are read."""
    if not term or any(c in term for c in _UNREAD):
        return None
    out = []
    for alternative in term.split("|"):
        runs = [""]
        for c in alternative:
            if c in _REPEATS:  # the character before may be missing
                runs[-1] = runs[-1][:-1]
                if c == "{":
                    return None
                runs.append("")
            elif c in "+.^$" or not " " <= c <= "~":
                runs.append("")
            else:
                runs[-1] += c.lower()
        needed = {run[k:k + 3] for run in runs for k in range(len(run) - 2)}
        if not needed:
            return None
        out.append(needed)
    return out


def files_with(spark: SparkSession, index_paths: list[str], wanted: list[set[str]]) -> list[str]:
    """The files that hold all trigrams of some alternative."""
    if not index_paths:
        return []
    every = sorted(set().union(*wanted))
    index = spark.read.schema(SCHEMA).parquet(*index_paths)
    held = index.filter(F.col("trigram").isin(every)).groupBy("file").agg(F.collect_set("trigram").alias("held"))
    can = F.lit(False)
    for needed in wanted:
        can = can | (F.size(F.array_intersect("held", F.array(*map(F.lit, sorted(needed))))) == len(needed))
    return sorted(r["file"] for r in held.filter(can).select("file").collect())

"""Files beside Spark's own readers: listing, removal, and byte access on workers."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    files, p = _hadoop(spark, path)
    return files.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    files, p = _hadoop(spark, path)
    files.delete(p, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    files, p = _hadoop(spark, path)
    if not files.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"could not rename {path} to {to}")


def swap_in(spark: SparkSession, aside: str, path: str) -> None:
    """Put a folder written aside in the place of ``path``; what was there is removed last."""
    old = f"{path.rstrip('/')}-old-{uuid.uuid4().hex}"
    if exists(spark, path):
        rename(spark, path, old)
    rename(spark, aside, path)
    delete(spark, old)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written from the driver."""
    files, p = _hadoop(spark, path)
    out = files.create(p, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    files, p = _hadoop(spark, path)
    stream = files.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, by name; the driver lists them, as for any scan.

    All names come in one call: a call for each takes longer than the listing."""
    files, p = _hadoop(spark, pattern)
    found = files.globStatus(p)
    if not found:
        return []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    held = hadoop.mapred.JobConf(False)  # holds any number of paths as one text, commas in names escaped
    hadoop.mapred.FileInputFormat.setInputPaths(held, hadoop.fs.FileUtil.stat2Paths(found))
    text = held.getRaw("mapreduce.input.fileinputformat.inputdir")
    return sorted(re.sub(r"\\(.)", r"\1", name, flags=re.S) for name in re.findall(r"(?:\\.|[^,\\])+", text, flags=re.S))


def java_texts(spark: SparkSession, texts: list[str]):
    """Paths as a Java array, passed on in one call: as a list there would be a call for each."""
    return spark.sparkContext._jvm.java.util.regex.Pattern.compile("\0").split("\0".join(texts))


def listed(spark: SparkSession, paths: list[str] | DataFrame) -> DataFrame:
    """Paths as rows (``path``), dealt out to the workers."""
    tasks = 8 * spark.sparkContext.defaultParallelism
    if not isinstance(paths, DataFrame):
        tasks = max(1, min(len(paths), tasks))
        paths = spark.createDataFrame(pa.table({"path": pa.array(paths, pa.string())}))
    return paths.repartition(tasks, "path")


def _names(folder: str) -> Iterator[str]:
    """Names in a folder, one after the other where the file system is local; none of what is no folder."""
    filesystem, place = open_filesystem(folder)
    if isinstance(filesystem, fs.LocalFileSystem):
        if os.path.isdir(place):
            with os.scandir(place) as found:
                yield from (entry.name for entry in found)
    elif filesystem.get_file_info(place).type == fs.FileType.Directory:
        yield from (entry.base_name for entry in filesystem.get_file_info(fs.FileSelector(place)))


def in_folder(spark: SparkSession, folder: str, ending: str) -> DataFrame:
    """Paths (``path``) in a folder, or in those that match a glob, whose names have an ending.

    A worker lists a folder and passes the names on in batches: there may be
    more of them than the driver can hold."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column("path").to_pylist():
                found = (f"{place.rstrip('/')}/{name}" for name in _names(place) if name.endswith(ending))
                while some := list(islice(found, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], ["path"])

    return listed(spark, matching(spark, folder)).mapInArrow(read, "path string")


def open_filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path on it; for use on any worker."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    parts = urlsplit(path)
    filesystem, root = fs.FileSystem.from_uri(f"{parts.scheme}://{parts.netloc}")
    return filesystem, root.rstrip("/") + path.split("://", 1)[1].removeprefix(parts.netloc)

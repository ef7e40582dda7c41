"""Stored tables made of parts, and the pointer that says which parts are live.

A part is what one run wrote to one table: ``<table>/part=<name>/month_start=..``.
It is written aside, and only a new pointer makes it visible, so readers see
all tables of a run or none, and a failed write changes nothing.  Pointers are
numbered files; readers follow the highest.  One writer at a time is assumed.

``PartTable`` is bucketed and sorted by its key: joins and aggregations on the
key read the stored side bucket by bucket, without a shuffle.  Bucketing is
part of a table's catalogue entry, so reads go through an external table of the
session's catalogue, named after the path and the live parts.  A bucket is what
one task writes, joins and aggregates, so their number has to follow the rows
(``buckets_for``).  A table without buckets is written in tasks of even size."""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendlake.sources import files

MONTH = "month_start"
BUCKET_ROWS = 500_000


class Pointer:
    """The live parts of every table under ``path``: {table: [part, ...]}."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbered(self) -> list[str]:
        return files.matching(self.spark, f"{self.path}/_live/[0-9]*")

    def read(self) -> dict[str, list[str]]:
        found = self._numbered()
        return json.loads(files.read_text(self.spark, found[-1])) if found else {}

    def publish(self, live: dict[str, list[str]]) -> None:
        """Switch readers to ``live``; the pointer before it is kept for those still reading."""
        found = self._numbered()
        number = int(found[-1].rsplit("/", 1)[-1]) + 1 if found else 1
        aside = f"{self.path}/_live/.{uuid.uuid4().hex}"
        files.write_text(self.spark, aside, json.dumps(live, sort_keys=True))
        files.rename(self.spark, aside, f"{self.path}/_live/{number:010d}")
        for old in found[:-1]:
            files.delete(self.spark, old)

    def dead_parts(self) -> list[str]:
        """Part folders that neither the newest pointer nor the one before it names."""
        named = {f"{t}/part={p}" for f in self._numbered()[-2:]
                 for t, ps in json.loads(files.read_text(self.spark, f)).items() for p in ps}
        found = files.matching(self.spark, f"{self.path}/*/part=*")
        return [f for f in found if "/".join(f.rsplit("/", 2)[1:]) not in named]


def new_part(run_id: str) -> str:
    """A name for what ``run_id`` writes; a repeated run gets another name for the same run."""
    safe = "".join(c if c.isalnum() or c in "._" else "_" for c in run_id)
    return f"{safe}-{hashlib.md5(run_id.encode()).hexdigest()[:8]}-{uuid.uuid4().hex[:8]}"


def without_run(parts: list[str], run_id: str) -> list[str]:
    """The parts that other runs wrote."""
    own = new_part(run_id).rsplit("-", 1)[0]
    return [p for p in parts if p.rsplit("-", 1)[0] != own]


def buckets_for(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Buckets for a table of about this many rows: a task that writes or joins one keeps its size."""
    return max(2, -(-rows // bucket_rows))


@dataclass(frozen=True)
class PartTable:
    """One stored table; 0 ``buckets``: neither bucketed nor sorted."""

    spark: SparkSession
    path: str
    schema: StructType  # without the part, the month last
    key: str
    buckets: int

    def _table(self, parts: list[str]) -> str:
        """The catalogue name of the table with these parts, registered once per session."""
        text = json.dumps([self.path, sorted(parts), self.buckets])
        name = f"spendlake_{hashlib.md5(text.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            place = self.path.replace("'", "\\'")
            bucketed = f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS "
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, `part` string) USING parquet PARTITIONED BY (`part`, `{MONTH}`) "
                f"{bucketed if self.buckets else ''}LOCATION '{place}'")
            if parts:
                self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return name

    def write(self, rows: DataFrame, part: str) -> DataFrame:
        """Write ``rows`` as ``part`` (visible to nobody yet) and read them back."""
        own = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields if f.name != MONTH],
                          F.lit(part).alias("part"), MONTH)
        if self.buckets:
            # dealt out by the bucket's own number: one task a bucket, so a bucket has one file in each month
            own = own.repartitionById(self.buckets, F.pmod(F.hash(self.key), F.lit(self.buckets)))
        else:
            # by month; AQE joins small months into one task and splits large ones
            own = own.hint("rebalance", MONTH)
        own.write.insertInto(self._table([]))
        return self.read([part])

    def read(self, parts: list[str]) -> DataFrame:
        """The rows of the given parts, bucketed by the key."""
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        table = self.spark.table(self._table(parts))
        return table.filter(F.col("part").isin(parts)).select(*self.schema.fieldNames())

    def months(self, parts: list[str]) -> list[str]:
        """The months (ISO days) that the parts hold, newest first: from the catalogue, no file is read."""
        if not parts:
            return []
        found = self.spark.sql(f"SHOW PARTITIONS {self._table(parts)}").collect()
        named = [dict(kv.split("=", 1) for kv in r["partition"].split("/")) for r in found]
        return sorted({n[MONTH] for n in named if n["part"] in parts and n[MONTH][:1].isdigit()}, reverse=True)

    def part_files(self, names: list[str]) -> DataFrame:
        """The rows of some data files only."""
        if not names:
            return self.spark.createDataFrame([], self.schema)
        fields = [f for f in self.schema.fields if f.name != MONTH]
        return (self.spark.read.schema(StructType([*fields, self.schema[MONTH]])).option("basePath", self.path)
                .parquet(*names).select(*self.schema.fieldNames()))

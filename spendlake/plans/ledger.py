"""A stored ledger: raw table, fact, daily summary, search index and audit.

A run (``refresh`` or ``append``) writes its parts of all tables aside and then
switches one pointer, so readers see a run whole or not at all, and a failed
run leaves what was there.  A run is known by its id: repeating it replaces its
own parts and its own audit, so it never counts twice.

* The raw table and the fact are bucketed by the row key.  An append looks its
  keys up bucket by bucket, and the uniqueness check aggregates within buckets:
  the stored side is never shuffled.  The summary has no buckets: it is written by
  month, in tasks of even size.
* Only new rows are categorised; the summary is merged with their totals, and
  the dashboard's reports are answered from it.
* The default date window takes the last month from the catalogue and reads
  that month only; calendar slicers prune months at run time.
* The search index holds the trigrams of each fact file, so a search reads only
  files that hold all trigrams its term needs.

Intermediate rows are landed beside the tables, in a shared folder."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake import fixed_values as FV
from spendlake.operators import filters, ingest, marts, quality, reports
from spendlake.operators.categorise import categorise
from spendlake.operators.staging import stage
from spendlake.plans.star import report_frame_same_run
from spendlake.plans.summary import merge, summarise, summary_frame
from spendlake.schemas import FACT, RAW, SUMMARY
from spendlake.sources import files, trigrams
from spendlake.sources.parts import PartTable, Pointer, new_part, without_run
from spendlake.sources.rules import rules_frame

AUDIT = ("source_file string, parsed long, pending long, superseded long, duplicate long, inserted long, skipped long, "
         "run_id string, loaded_at timestamp")


class Ledger:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 8, rules: DataFrame | None = None,
                 calendar=(FV.CALENDAR_START, FV.CALENDAR_END)):
        self.spark, self.path = spark, path.rstrip("/")
        self.rules = rules if rules is not None else rules_frame(spark)
        self.calendar = calendar
        self.pointer = Pointer(spark, self.path)
        self.raw_table = PartTable(spark, f"{self.path}/raw", RAW, "transaction_hash", buckets)
        self.fact_table = PartTable(spark, f"{self.path}/fact", FACT, "transaction_key", buckets)
        self.summary_table = PartTable(spark, f"{self.path}/summary", SUMMARY, "account_key", 0)

    # --- runs ---------------------------------------------------------------

    def refresh(self, export_rows: DataFrame, run_id: str | None = None, export_files: DataFrame | None = None) -> str:
        """Replace everything but the audit history by a full load; returns the run's id."""
        return self._run(export_rows, run_id, export_files, keep=False)

    def append(self, export_rows: DataFrame, run_id: str | None = None, export_files: DataFrame | None = None) -> str:
        """Add the rows whose keys are not stored yet; returns the run's id."""
        return self._run(export_rows, run_id, export_files, keep=True)

    def _run(self, export_rows: DataFrame, run_id: str | None, export_files: DataFrame | None, keep: bool) -> str:
        run_id = run_id or uuid.uuid4().hex
        part = new_part(run_id)
        live = self.pointer.read()
        others = {t: without_run(parts, run_id) for t, parts in live.items()}
        kept = others if keep else {"audit": others.get("audit", [])}
        landing = f"{self.path}/_landing/{part}"
        try:
            new = ingest.load(ingest.with_position(export_rows), landing_path=landing, position=True)
            if keep and kept.get("raw"):
                new = self.unseen(new, kept["raw"], landing)
            added = self.raw_table.write(ingest.with_month(new, "posting_date"), part)
            fact = marts.fact_transactions(categorise(stage(added), self.rules))
            fact = self.fact_table.write(ingest.with_month(fact, "date_key"), part)
            totals = summarise(fact)
            if kept.get("raw"):
                stored = self._summary_of(kept["raw"], kept.get("summary", []))
                totals = merge(stored, totals)
            self.summary_table.write(totals, part)
            trigrams.write(self.spark, f"{self.fact_table.path}/part={part}", f"{self.path}/trigrams/part={part}")
            audit = ingest.load_audit(export_rows, files=export_files, typed=self.spark.read.parquet(landing),
                                      inserted=added)
            (audit.withColumn("run_id", F.lit(run_id)).withColumn("loaded_at", F.current_timestamp())
             .write.parquet(f"{self.path}/audit/part={part}"))
        finally:
            files.delete(self.spark, landing)
        self.pointer.publish({
            "raw": [*kept.get("raw", []), part], "fact": [*kept.get("fact", []), part], "summary": [part],
            "trigrams": [*kept.get("trigrams", []), part], "audit": [*kept.get("audit", []), part]})
        return run_id

    def unseen(self, new: DataFrame, raw_parts: list[str], landing: str) -> DataFrame:
        """The new rows whose keys the stored parts don't hold.

        The key hashes the date, so only the months of the new rows are read.
        The new rows are dealt out as the stored ones are, so the stored side stays where it
        is.  (An outer join and a test: an anti join would be moved below that dealing out.)"""
        landed = ingest.posted(self.spark.read.parquet(landing))
        months = [r["m"] for r in landed.select(F.trunc("posting_date", "month").alias("m")).distinct().collect()]
        stored = self.raw_table.read(raw_parts).filter(F.col("month_start").isin(months))
        dealt = new.repartition(self.raw_table.buckets, "transaction_hash")
        known = stored.select(F.col("transaction_hash").alias("_stored")).hint("merge")
        joined = dealt.join(known, F.col("transaction_hash") == F.col("_stored"), "left")
        return joined.filter(F.col("_stored").isNull()).drop("_stored")

    def _summary_of(self, raw_parts: list[str], summary_parts: list[str]) -> DataFrame:
        """The stored summary of the given runs; recomputed from the fact where a repeated run is in the stored one."""
        if self.pointer.read().get("raw") == raw_parts and summary_parts:
            return self.summary_table.read(summary_parts)
        return summarise(self.fact_table.read(raw_parts))  # a run has the same part name in every table

    def clean(self) -> int:
        """Remove the parts of failed and replaced runs; returns their number."""
        dead = self.pointer.dead_parts()
        for path in dead:
            files.delete(self.spark, path)
        return len(dead)

    # --- tables -------------------------------------------------------------

    def _live(self, table: str) -> list[str]:
        return self.pointer.read().get(table, [])

    def raw(self) -> DataFrame:
        return self.raw_table.read(self._live("raw"))

    def fact(self) -> DataFrame:
        return self.fact_table.read(self._live("fact"))

    def summary(self) -> DataFrame:
        return self.summary_table.read(self._live("summary"))

    def audit(self) -> DataFrame:
        """One row for each run and file, and a total (``source_file`` NULL) for each run."""
        paths = [f"{self.path}/audit/part={p}" for p in self._live("audit")]
        return self.spark.read.schema(AUDIT).parquet(*paths) if paths else self.spark.createDataFrame([], AUDIT)

    @cached_property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.spark, *self.calendar)

    @cached_property
    def dim_category(self) -> DataFrame:
        return marts.dim_category(self.spark)

    def frame(self) -> DataFrame:
        """The report frame over the stored fact."""
        return report_frame_same_run(self.fact(), self.dim_date, self.dim_category)

    def totals(self) -> DataFrame:
        """The daily summary with its attributes, for the reports that sum and count."""
        return summary_frame(self.summary(), self.dim_date, self.dim_category)

    # --- filters and reports --------------------------------------------------

    def latest_day(self) -> dt.date | None:
        """The latest date on the calendar: a maximum over one month of the summary.

        Months come from the catalogue, newest first; a month whose rows are all
        off the calendar gives none, and the one before is read."""
        first, last = (marts._as_date(d) for d in self.calendar)
        totals = self.totals()
        for text in self.summary_table.months(self._live("summary")):
            month = dt.date.fromisoformat(text)
            if first.replace(day=1) <= month <= last:
                day = totals.filter(F.col("month_start") == F.lit(month)).agg(F.max("date_day").alias("d")).first()["d"]
                if day is not None:
                    return day
        return None

    def page(self, size: int, after: tuple | None = None, columns=FV.TRANSACTION_LIST_DEFAULT) -> DataFrame:
        """One page of the transaction list (``reports.transaction_page``), from as few months as hold it.

        The summary tells how many rows each month has: the month of the page
        before and the older ones that fill a page are read.  Where too few are
        left, all rows behind are, with those off the calendar."""
        frame = self.frame()
        counts = (self.totals().filter(F.col("date_day").isNotNull()).groupBy("month_start")
                  .agg(F.sum("transactions").alias("n")).orderBy(F.desc("month_start")).collect())  # one a month
        wanted, rows = [], 0
        for r in counts if after is None or after[0] is not None else []:
            if after is None or r["month_start"] <= after[0]:
                started = after is not None and r["month_start"] == after[0].replace(day=1)
                wanted.append(r["month_start"])
                rows += 0 if started else r["n"]
                if rows >= size:
                    frame = frame.filter(F.col("month_start").isin(wanted) & F.col("date_day").isNotNull())
                    break
        return reports.transaction_page(frame, size, after, columns)

    def last_days(self, frame: DataFrame | None = None, days: int = 90) -> DataFrame:
        """The default window of the dashboard over the frame (or the summary); other months are not read."""
        frame = self.frame() if frame is None else frame
        latest = self.latest_day()
        if latest is None:
            return frame.filter(F.lit(False))
        return filters.date_range(frame, latest - dt.timedelta(days), latest)

    def dashboard(self, frame: DataFrame | None = None, names=None, types=("credit", "debit")) -> DataFrame:
        return filters.transaction_types(filters.categories(self.last_days(frame), names), types)

    def search(self, term: str | None) -> DataFrame:
        """The report frame's rows that match ``term``, from the files that can hold it."""
        wanted = trigrams.required(term)
        fact = self.fact()
        if wanted is not None:
            paths = [f"{self.path}/trigrams/part={p}" for p in self._live("trigrams")]
            fact = self.fact_table.part_files(trigrams.files_with(self.spark, paths, wanted))
        frame = report_frame_same_run(fact, self.dim_date, self.dim_category)
        return reports.transaction_search(frame, term)

    def repeated_keys(self) -> DataFrame:
        """Keys that the fact holds more than once; aggregated within buckets."""
        return quality.repeated_keys(self.fact(), "transaction_key")

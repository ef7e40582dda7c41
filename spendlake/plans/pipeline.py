"""End-to-end runs: load -> models -> checks, and the CSV export of marts.

Tables are written as Parquet under ``out_dir`` (a shared filesystem on a
cluster): ``raw_transactions`` and ``marts/{fct_transactions, dim_account,
dim_category, dim_date}``.  Each write is one job; a lost executor only
re-runs its tasks from the last shuffle or written table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spendlake import fixed_values as FV
from spendlake.operators import ingest, marts, quality
from spendlake.operators.categorise import categorise
from spendlake.operators.staging import stage
from spendlake.plans.star import HOT_ACCOUNT_ROWS, hot_accounts, report_frame, report_frame_same_run
from spendlake.sources import files
from spendlake.sources.exports import export_files, export_paths, read_exports
from spendlake.sources.rules import rules_frame

MART_NAMES = ["dim_account", "dim_category", "dim_date", "fct_transactions"]
HOT_LIST = "hot_accounts"


@dataclass
class PipelineResult:
    raw: DataFrame
    marts: dict[str, DataFrame]
    checks: DataFrame | None
    frame: DataFrame


def load_exports(spark: SparkSession, csv_dir, raw_path: str, append: bool = False,
                 export_rows: DataFrame | None = None, split_files: bool = False,
                 audit_path: str | None = None) -> DataFrame:
    """Exports -> ``raw_transactions``, partitioned by month.  Full refresh by
    default; ``append`` keeps the stored keys and adds unseen ones.

    The parsed rows, and the rows that an append adds, are landed beside the
    raw table (a shared folder by definition); that run-private folder is
    removed in the end.  A full refresh is written there too and then swapped
    in, so a failed job leaves the old table.  The audit counts what was
    written (``plans.ledger`` keeps the audits of all runs)."""
    rows = export_rows if export_rows is not None else read_exports(spark, csv_dir, split_files=split_files)
    landing = f"{raw_path.rstrip('/')}-landing-{uuid.uuid4().hex}"
    try:
        new_raw = ingest.load(rows, landing_path=f"{landing}/rows")
        if append and files.exists(spark, raw_path):
            landed = ingest.posted(spark.read.parquet(f"{landing}/rows"))
            months = landed.select(F.trunc("posting_date", "month").alias("m")).distinct().collect()
            # only the months of the new rows are read; their list is as long as the calendar at most
            stored = spark.read.parquet(raw_path).filter(F.col("month_start").isin([r["m"] for r in months]))
            added = ingest.append_new_only(new_raw, stored)
            ingest.with_month(added, "posting_date").write.parquet(f"{landing}/added")
            written = spark.read.parquet(f"{landing}/added")
            by_month(written).write.mode("append").partitionBy("month_start").parquet(raw_path)
        else:
            # written aside, so a failed job leaves the table that was there
            by_month(ingest.with_month(new_raw, "posting_date")).write.partitionBy("month_start").parquet(
                f"{landing}/table")
            files.swap_in(spark, f"{landing}/table", raw_path)
            written = spark.read.parquet(raw_path)
        if audit_path:
            names = export_files(spark, csv_dir) if export_rows is None else None
            typed = spark.read.parquet(f"{landing}/rows")
            (ingest.load_audit(rows, files=names, typed=typed, inserted=written)
             .write.mode("overwrite").parquet(audit_path))
    finally:
        files.delete(spark, landing)
    return spark.read.parquet(raw_path)


def by_month(rows: DataFrame) -> DataFrame:
    """Deal rows out by month before a write partitioned by month, so that a month has few
    files; Spark splits months that are larger than a partition should be."""
    return rows.hint("rebalance", F.col("month_start"))


def build_marts(spark: SparkSession, raw: DataFrame, marts_dir: str, rules: DataFrame | None = None,
                calendar=(FV.CALENDAR_START, FV.CALENDAR_END), run_checks: bool = True,
                hot_account_rows: int = HOT_ACCOUNT_ROWS):
    """raw -> staged -> categorised -> marts (written), then the 21 checks on
    the written tables; any failing check raises ``quality.ChecksFailed``."""
    rules = rules if rules is not None else rules_frame(spark)
    staged = stage(raw)
    built = {
        "fct_transactions": marts.fact_transactions(categorise(staged, rules)),
        "dim_account": marts.dim_account(staged),
        "dim_category": marts.dim_category(spark),
        "dim_date": marts.dim_date(spark, *calendar),
    }
    for name, df in built.items():
        out = df.write
        if name == "fct_transactions":
            out = by_month(ingest.with_month(df, "date_key")).write.partitionBy("month_start")
        aside = f"{marts_dir}/{name}-new-{uuid.uuid4().hex}"
        try:
            out.parquet(aside)
            files.swap_in(spark, aside, f"{marts_dir}/{name}")
        finally:
            files.delete(spark, aside)
    written = {name: spark.read.parquet(f"{marts_dir}/{name}") for name in built}
    # Accounts too large for one task of the account join (read by report_frame).
    hot_accounts(written["fct_transactions"], hot_account_rows).write.mode("overwrite").parquet(
        f"{marts_dir}/{HOT_LIST}")
    checks = None
    if run_checks:
        checks = quality.run_checks(spark, quality.standard_checks(
            staged, written["fct_transactions"], written["dim_date"], written["dim_account"]))
        quality.assert_checks(checks)
    return written, checks


def run_pipeline(spark: SparkSession, out_dir: str, csv_dir: str | None = None,
                 export_rows: DataFrame | None = None, skip_load: bool = False,
                 skip_models: bool = False, rules: DataFrame | None = None,
                 calendar=(FV.CALENDAR_START, FV.CALENDAR_END), append: bool = False,
                 keep_frame: bool = False) -> PipelineResult:
    """Load (unless skipped or no export exists), build marts and run the
    checks (unless skipped), and return the report frame over the marts.
    ``keep_frame`` persists the frame for repeated reports (memory and disk;
    a lost block is recomputed from the written marts)."""
    raw_path, marts_dir = f"{out_dir}/raw_transactions", f"{out_dir}/marts"
    has_input = export_rows is not None or (csv_dir is not None and bool(export_paths(spark, csv_dir)))
    if not skip_load and has_input:
        load_exports(spark, csv_dir, raw_path, append=append, export_rows=export_rows,
                     audit_path=f"{out_dir}/load_audit")
    if not files.exists(spark, raw_path):
        raise FileNotFoundError(f"no raw table at {raw_path}; load exports first")
    raw = spark.read.parquet(raw_path)
    checks = None
    if skip_models:
        if not all(files.exists(spark, f"{marts_dir}/{n}") for n in MART_NAMES):
            raise FileNotFoundError(f"marts missing under {marts_dir}; build them first")
        built = {n: spark.read.parquet(f"{marts_dir}/{n}") for n in MART_NAMES}
    else:
        built, checks = build_marts(spark, raw, marts_dir, rules, calendar)
    if skip_models:
        hot_path = f"{marts_dir}/{HOT_LIST}"
        hot = spark.read.parquet(hot_path) if files.exists(spark, hot_path) else None
        frame = report_frame(built["fct_transactions"], built["dim_date"], built["dim_category"],
                             built["dim_account"], hot_list=hot)
    else:
        # Built in this run and checked (relationships): no account join needed.
        frame = report_frame_same_run(built["fct_transactions"], built["dim_date"], built["dim_category"])
    if keep_frame:
        frame = frame.persist()
    return PipelineResult(raw, built, checks, frame)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> int:
    """One table as CSV (header, ``,``, ``"`` quote and escape).  The row
    count is observed during the write, not by a second pass."""
    obs = Observation()
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if single_file:
        out = out.coalesce(1)
    (out.write.mode("overwrite")
        .options(header=True, sep=",", quote='"', escape='"', escapeQuotes=True)
        .csv(path))
    return int(obs.get["rows"])


def export_search(frame: DataFrame, term: str | None, path: str, single_file: bool = False) -> int:
    """The searched transaction list with all columns, as CSV."""
    from spendlake.operators.reports import transaction_search
    return export_csv(transaction_search(frame, term), path, single_file)


def export_marts(spark: SparkSession, marts_dir: str, export_dir: str, single_file: bool = False) -> dict[str, int]:
    """All four marts as CSV directories; returns row counts and the total."""
    counts = {}
    for name in MART_NAMES:
        df = spark.read.parquet(f"{marts_dir}/{name}").drop("month_start")
        counts[name] = export_csv(df, f"{export_dir}/{name}", single_file)
    counts["total"] = sum(counts.values())
    return counts

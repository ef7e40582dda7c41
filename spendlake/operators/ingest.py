"""Load semantics: typing, newest export wins, key dedupe, audit, append.

Input is export rows (``schemas.EXPORT_ROWS``) from any source.  The plan is
two shuffles over the rows: one on (account, posting_date) for the newest
export, one on the row key for the dedupe.  Both are aggregations with a
map-side partial step, so a hot account/day or a massively repeated key is
collapsed before it is shuffled; the only full-width join is a semi join
against one row per (account, day), which AQE splits when a key is skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendlake.functions.text import account_from_file_name, row_hash

RAW_COLUMNS = [
    "transaction_hash", "posting_date", "amount", "sender", "recipient", "name",
    "description", "balance", "currency", "reconciled", "source_file",
]


def parse_posting_date(text: Column, source_file: Column, fmt: str = "yyyy/M/d") -> Column:
    """Strict date parse: a malformed date fails the job, naming value and file."""
    parsed = F.try_to_date(text, fmt)
    message = F.concat(F.lit("Failed to parse posting_date '"), text, F.lit("' in file '"),
                       source_file, F.lit("'"))
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def typed_rows(rows: DataFrame) -> DataFrame:
    """Row key over the export texts, parsed date and account of the file."""
    return rows.select(
        row_hash(F.col("posting_date_text"), F.col("amount"), F.col("description"),
                 F.col("name"), F.col("sender"), F.col("recipient")).alias("transaction_hash"),
        parse_posting_date(F.col("posting_date_text"), F.col("source_file")).alias("posting_date"),
        "amount", "sender", "recipient", "name", "description", "balance", "currency",
        "reconciled", "source_file", "row_in_file",
        account_from_file_name(F.col("source_file")).alias("account"),
        F.col("posting_date_text").isNull().alias("pending"),
    )


def posted(typed: DataFrame) -> DataFrame:
    """Pending rows (no posting date) are not loaded.  The test is on the
    text: a present text either parses or fails the job, and the filter
    does not re-evaluate the parse."""
    return typed.filter(~F.col("pending")).drop("pending")


def newest_file_wins(rows: DataFrame) -> DataFrame:
    """Per account and posting date only the highest-named export survives;
    all of its rows for that date are kept."""
    # A maximum over text is no hash aggregate; distinct keys are, and reduce
    # the rows to one per export and day before the newest is ranked.
    exports = rows.select("account", "posting_date", "source_file").distinct()
    last = W.partitionBy("account", "posting_date").orderBy(F.desc("source_file"))
    newest = (exports.withColumn("_rn", F.row_number().over(last)).filter(F.col("_rn") == 1)
              .select(F.col("account").alias("_acct"), F.col("posting_date").alias("_day"),
                      F.col("source_file").alias("_newest_file")))
    # All three columns are equi-keys, so both join sides come straight from
    # a shuffle: that is the shape AQE's skew-join rule can split when one
    # account-day holds a large share of all rows (a join reusing the
    # aggregate's partitioning saves a small exchange but cannot be split).
    cond = ((rows["account"] == newest["_acct"]) & (rows["posting_date"] == newest["_day"])
            & (rows["source_file"] == newest["_newest_file"]))
    return rows.join(newest, cond, "left_semi")


def with_position(rows: DataFrame) -> DataFrame:
    """Export rows whose position is (split start, record), as ``sources.exports`` gives it."""
    if not dict(rows.dtypes)["row_in_file"].startswith("struct"):
        position = F.struct(F.lit(0).cast("long").alias("split_start"), F.col("row_in_file").cast("long").alias("record"))
        rows = rows.withColumn("row_in_file", position)
    return rows


def dedupe_by_key(rows: DataFrame, position: bool = False) -> DataFrame:
    """One row per key: the first loaded wins, i.e. highest file name, then
    earliest position in the file.  ``row_number() == 1`` is planned with a
    partial WindowGroupLimit before the shuffle, so each map task keeps one
    row per key and no key gathers its duplicates in one task."""
    first = W.partitionBy("transaction_hash").orderBy(F.desc("source_file"), F.asc("row_in_file"))
    return (rows.withColumn("_rn", F.row_number().over(first))
            .filter(F.col("_rn") == 1).select(*RAW_COLUMNS, *(["row_in_file"] if position else [])))


def land(rows: DataFrame, landing_path: str) -> DataFrame:
    """Write typed rows once (a landing table in a shared folder) and read
    them back: the parse runs once, the newest-export aggregate reads three
    columns only, and lost executors do not re-parse the exports.  Pending
    rows are kept (flagged) so the load audit can be computed from it."""
    typed_rows(rows).write.mode("overwrite").parquet(landing_path)
    return rows.sparkSession.read.parquet(landing_path)


def load(rows: DataFrame, with_load_time: bool = True, landing_path: str | None = None,
         position: bool = False) -> DataFrame:
    """Export rows -> raw transactions (one row per key), with their ``row_in_file`` if asked."""
    ready = posted(land(rows, landing_path) if landing_path else typed_rows(rows))
    kept = dedupe_by_key(newest_file_wins(ready), position)
    if with_load_time:
        kept = kept.withColumn("loaded_at", F.current_timestamp())
    return kept


def load_audit(rows: DataFrame, files: DataFrame | None = None, typed: DataFrame | None = None,
               inserted: DataFrame | None = None) -> DataFrame:
    """Per export file: parsed, pending, superseded (an export with a higher
    name supplied the day), duplicate (the key came before in the run, or is
    stored already), inserted and skipped; the row with ``source_file`` NULL
    is the total.

    ``files`` (one ``source_file`` per file, ``exports.export_files``) adds
    files without data rows; ``typed`` (a landing table) replaces parsing
    ``rows`` again; ``inserted`` is what the run wrote (default: a full load
    of ``rows``), so the audit counts rows of the table, not of a plan."""
    typed = typed if typed is not None else typed_rows(rows)
    kept = newest_file_wins(posted(typed))
    parsed = typed.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("parsed"),
        F.count_if(F.col("pending")).alias("pending"))
    per_kept = kept.groupBy("source_file").agg(F.count(F.lit(1)).alias("kept"))
    written = inserted if inserted is not None else dedupe_by_key(kept)
    written = written.groupBy("source_file").agg(F.count(F.lit(1)).alias("inserted"))
    if files is not None:
        parsed = (files.select("source_file").distinct().join(parsed, "source_file", "left")
                  .select("source_file", F.coalesce("parsed", F.lit(0)).alias("parsed"),
                          F.coalesce("pending", F.lit(0)).alias("pending")))
    per_file = (parsed.join(per_kept, "source_file", "left").join(written, "source_file", "left")
                .select("source_file", "parsed", "pending",
                        (F.col("parsed") - F.col("pending") - F.coalesce("kept", F.lit(0))).alias("superseded"),
                        (F.coalesce("kept", F.lit(0)) - F.coalesce("inserted", F.lit(0))).alias("duplicate"),
                        F.coalesce("inserted", F.lit(0)).alias("inserted")))
    return (per_file.rollup("source_file")
            .agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
                   for c in ("parsed", "pending", "superseded", "duplicate", "inserted")])
            .withColumn("skipped", F.col("pending") + F.col("superseded") + F.col("duplicate")))


def with_month(rows: DataFrame, day: str) -> DataFrame:
    """Add the partition column of stored tables: the first day of the month (NULL for no day)."""
    return rows.withColumn("month_start", F.trunc(F.col(day), "month"))


def append_new_only(new_raw: DataFrame, existing_raw: DataFrame) -> DataFrame:
    """Append load: keys already in the table stay as they are; only unseen
    keys are added.  The per-date memory lives within one load run only.

    The key hashes the date text, so equal keys have equal dates and the join
    is on both: a stored table can be pruned to the new rows' dates first."""
    keys = ["transaction_hash", "posting_date"]
    return new_raw.join(existing_raw.select(*keys), keys, "left_anti")

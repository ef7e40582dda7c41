"""Bank-shaped views over the driver's tables.

The driver ships TPC-H-like tables and an event stream, not bank exports.
These adapters derive export rows (the shape produced by
``sources.exports.read_exports``) from whole tables, so that every registered
query runs the real load path.  Both are projections and equi-joins.  The
fact-like table is dealt out by its row key first: a driver file is one split.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake import fixed_values as FV
from spendlake.schemas import MONEY
from spendlake.sources import files
from spendlake.sources.tables import table


def _account(key: Column) -> Column:
    prefix = F.when(key % 3 == 0, F.lit("07")).otherwise(F.lit("08"))
    return F.concat(prefix, F.lpad(key.cast("string"), 8, "0"))


def _file(acct: Column, even: Column, even_stamp: str, odd_stamp: str) -> Column:
    stamp = F.when(even, F.lit(even_stamp)).otherwise(F.lit(odd_stamp))
    return F.concat(F.lit(FV.ACCOUNT_FILE_PREFIX), acct, F.lit(FV.ACCOUNT_FILE_SEPARATOR), stamp, F.lit(".csv"))


def _date_text(d: Column) -> Column:
    return F.date_format(d, "yyyy/MM/dd")


def _rows_of(df: DataFrame) -> Column:
    """The number of rows as a scalar subquery (NULL for none, so that a remainder by it is NULL)."""
    return F.nullif(df.select(F.count(F.lit(1))).scalar(), F.lit(0).cast("long"))


#: Event dates are moved back by up to 1,715 days, a whole account alike: years
#: of postings, some before the calendar's first day.
ERAS, ERA_DAYS = 50, 35


def events_export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows over ``events`` (correctness adapter).

    Every event is one row; every 50th event is exported a second time
    (``copy`` = 1, other balance) so the key dedupe has work.  Description and
    name come from all rows of ``part`` / ``customer``, whose keys count from
    0, by the event's number modulo theirs."""
    ev = (table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
          .repartition("event_id"))
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    ev = (ev.withColumn("copy", F.explode(copies))
            .withColumn("part_no", F.col("event_id") % _rows_of(part))
            .withColumn("cust_no", F.col("event_id") % _rows_of(cust)))
    j = (ev.join(part, F.col("p_partkey") == F.col("part_no"))
           .join(cust, F.col("c_custkey") == F.col("cust_no")))
    day = F.date_sub(F.col("ts").cast("date"), (F.col("user_id") % ERAS * ERA_DAYS).cast("int"))
    sgn = F.when(F.col("event_type").isin("purchase", "click"), F.lit(-1)).otherwise(F.lit(1))
    acct = _account(F.col("user_id"))
    has_party = F.col("event_id") % 101 != 0
    return j.select(
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
         .otherwise(_date_text(day)).alias("posting_date_text"),
        (sgn * F.col("value")).cast(MONEY).alias("amount"),
        F.when((sgn < 0) & has_party, acct).alias("sender"),
        F.when((sgn > 0) & has_party, acct).alias("recipient"),
        F.when(F.col("event_id") % 13 != 0, F.col("c_name")).alias("name"),
        F.when(F.col("event_id") % 17 != 0, F.col("p_name")).alias("description"),
        (F.col("c_acctbal") + F.col("copy")).cast(MONEY).alias("balance"),
        F.lit(FV.DEFAULT_CURRENCY).alias("currency"),
        F.lit(None).cast("string").alias("reconciled"),
        _file(acct, F.col("event_id") % 2 == 0, "2024-02-01 08.00.00", "2024-01-16 08.00.00").alias("source_file"),
        (F.col("event_id") * 2 + F.col("copy")).alias("row_in_file"),
    )


def write_export_files(cells: DataFrame, header: list[str], folder: str) -> int:
    """Write positional cells (``_c0`` .., source_file, row_in_file) as real export files: a byte
    order mark, ``;``, quotes around cells with a line break, quote or ``;``, a ``;`` at the end of a
    line; here and there a blank line, a record of empty cells, a row cut short.  Returns the
    number of records with data.

    A file's rows are streamed by one task, in order of their position."""
    def quoted(c: Column) -> Column:
        odd = c.rlike('[;"\\n\\r]')
        return F.when(odd, F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)

    def line(values: list[Column]) -> Column:
        return F.concat(F.concat_ws(";", *values), F.lit(";"))

    no = F.col("row_in_file")
    full = line([quoted(F.coalesce(f"_c{i}", F.lit(""))) for i in range(len(header))])
    body = F.when(no % 6 == 0, F.regexp_replace(full, ";+$", "")).otherwise(full)
    empty = F.lit(";" * len(header) + "\n")
    text = F.concat(F.when(no % 9 == 0, F.lit("\n")).otherwise(F.lit("")),
                    F.when(no % 12 == 0, empty).otherwise(F.lit("")), body, F.lit("\n"))
    first = "\ufeff" + ";".join(header) + ";\n"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, place = files.open_filesystem(folder)
        filesystem.create_dir(place, recursive=True)
        name, out, n = None, None, 0
        for batch in batches:
            for own, body in zip(batch.column("source_file").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if own != name:
                    if out is not None:
                        out.close()
                    name, out = own, filesystem.open_output_stream(f"{place}/{own}")
                    out.write(first.encode())
                out.write(body.encode())
                n += 1
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    ordered = (cells.select("source_file", "row_in_file", text.alias("text")).repartition("source_file")
               .sortWithinPartitions("source_file", "row_in_file"))
    return ordered.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def lineitem_export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows over ``lineitem`` joined to its dimensions (bench adapter)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate").repartition("l_orderkey", "l_linenumber")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    j = (li.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
           .join(cust, F.col("c_custkey") == F.col("o_custkey"))
           .join(part, F.col("p_partkey") == F.col("l_partkey"))
           .join(supp, F.col("s_suppkey") == F.col("l_suppkey")))
    sgn = F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(-1))
    acct = _account(F.col("l_suppkey"))
    pending = (F.col("l_linenumber") == 7) & (F.col("l_linestatus") == "O")
    return j.select(
        F.when(pending, F.lit(None).cast("string"))
         .otherwise(_date_text(F.col("l_shipdate").cast("date"))).alias("posting_date_text"),
        (sgn * F.col("l_extendedprice")).cast(MONEY).alias("amount"),
        F.when(sgn < 0, acct).alias("sender"),
        F.when(sgn > 0, acct).alias("recipient"),
        F.col("c_name").alias("name"),
        F.col("p_name").alias("description"),
        F.col("s_acctbal").cast(MONEY).alias("balance"),
        F.lit(FV.DEFAULT_CURRENCY).alias("currency"),
        F.col("l_linestatus").alias("reconciled"),
        _file(acct, F.col("l_linenumber") % 2 == 0, "2001-12-31 08.00.00", "2001-06-30 08.00.00").alias("source_file"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_in_file"),
    )

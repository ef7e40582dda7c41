"""Daily totals that answer the dashboard's reports without reading the fact.

One row for each day, account, category, status and type holds the sums and the
number of transactions.  Sums and counts add up, so an append merges its own
totals into the stored ones, and every report over the joined frame works on
the joined summary as well: it sums sums, and counts by ``transactions``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.plans.star import DATE_COLUMNS, _layout, _with_dimensions
from spendlake.schemas import SUMMARY

KEYS = ["date_key", "account_key", "category_key", "categorization_status", "transaction_type"]
TOTALS = ["amount", "absolute_amount", "transactions"]


def summarise(fact: DataFrame) -> DataFrame:
    """Totals of fact rows (``schemas.SUMMARY``); the aggregation is partial before its shuffle."""
    return _typed(fact.groupBy(*KEYS).agg(F.sum("amount").alias("amount"),
                                          F.sum("absolute_amount").alias("absolute_amount"),
                                          F.count(F.lit(1)).alias("transactions")))


def merge(stored: DataFrame, added: DataFrame) -> DataFrame:
    """Totals of both, one row for each key."""
    return _typed(stored.select(*KEYS, *TOTALS).unionByName(added.select(*KEYS, *TOTALS))
                  .groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in TOTALS]))


def _typed(totals: DataFrame) -> DataFrame:
    month = totals.withColumn("month_start", F.trunc("date_key", "month"))
    return month.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SUMMARY.fields])


def summary_frame(summary: DataFrame, dim_date: DataFrame, dim_category: DataFrame) -> DataFrame:
    """The summary with date and category attributes, for ``operators.reports``."""
    joined = _with_dimensions(summary, dim_date, dim_category, columns=[*KEYS, *TOTALS])
    attributes = ["category_name", "category_group", "category_type", "category_classification"]
    return joined.select(*KEYS, *TOTALS, *DATE_COLUMNS, *attributes, *_layout(summary))

"""Star schema: transaction fact and the date, account, category dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake import fixed_values as FV
from spendlake.functions.calendar import calendar_columns
from spendlake.schemas import CATEGORY_ROWS

FACT_COLUMNS = [
    "transaction_key", "date_key", "account_key", "amount", "absolute_amount", "balance",
    "transaction_type", "counterparty_name", "transaction_description", "currency",
    "category_key", "categorization_status", "source_file",
]


def fact_transactions(categorised: DataFrame) -> DataFrame:
    cols = [
        F.col("transaction_hash").alias("transaction_key"),
        F.col("posting_date").alias("date_key"),
        F.coalesce("sender_account", "recipient_account").alias("account_key"),
        "amount", "absolute_amount", "balance", "transaction_type", "counterparty_name",
        "transaction_description", "currency", "category_key", "categorization_status", "source_file",
    ]
    cols += [c for c in ("row_in_file", "loaded_at") if c in categorised.columns]
    return categorised.select(*cols)


def account_attributes(number: Column, bank_name: str = FV.BANK_NAME,
                       checking_prefix: str = FV.CHECKING_PREFIX) -> dict[str, Column]:
    """The account dimension's report attributes as functions of the account
    number (NULL number -> NULL attributes, as an unmatched left join gives)."""
    present = number.isNotNull()
    return {
        "account_number": number,
        "bank_name": F.when(present, F.lit(bank_name)),
        "account_type": F.when(present, F.when(number.startswith(checking_prefix), F.lit("Checking"))
                               .otherwise(F.lit("Unknown"))),
    }


def dim_account(staged: DataFrame, bank_name: str = FV.BANK_NAME,
                default_currency: str = FV.DEFAULT_CURRENCY,
                checking_prefix: str = FV.CHECKING_PREFIX) -> DataFrame:
    """Distinct sender and recipient accounts in one scan (explode of the two
    columns, then a distinct that deduplicates map-side first)."""
    accounts = (staged.select(F.explode(F.array("sender_account", "recipient_account")).alias("account_number"))
                .filter(F.col("account_number").isNotNull()).distinct())
    known = account_attributes(F.col("account_number"), bank_name, checking_prefix)
    return accounts.select(F.col("account_number").alias("account_key"), "account_number",
                           known["bank_name"].alias("bank_name"), F.lit(default_currency).alias("default_currency"),
                           known["account_type"].alias("account_type"))


def dim_category(spark: SparkSession, rows=None) -> DataFrame:
    """Literal category rows plus the classification of their type.

    The rows are literals of the plan, so its size is known and joins to it broadcast it."""
    rows = FV.CATEGORY_ROWS if rows is None else rows
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, CATEGORY_ROWS.fields, strict=True)])
               for r in rows]
    base = spark.range(1, numPartitions=1).select(F.inline(F.array(*structs))) if structs else \
        spark.createDataFrame([], CATEGORY_ROWS)
    cls = None
    for ctype, label in FV.CLASSIFICATION_BY_TYPE.items():
        cond = F.col("category_type") == ctype
        cls = F.when(cond, F.lit(label)) if cls is None else cls.when(cond, F.lit(label))
    return base.withColumn("category_classification", cls.otherwise(F.lit(FV.OTHER_CLASSIFICATION)))


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def dim_date(spark: SparkSession, start=FV.CALENDAR_START, end=FV.CALENDAR_END) -> DataFrame:
    """One row per day in [start, end]; the size is fixed by the range."""
    lo, hi = _as_date(start), _as_date(end)
    days = (hi - lo).days + 1
    spine = spark.range(0, max(days, 0), numPartitions=1).select(
        F.date_add(F.lit(lo), F.col("id").cast("int")).alias("d"))
    return spine.select(*[c.alias(n) for n, c in calendar_columns(F.col("d")).items()])


def dim_date_for(staged: DataFrame) -> DataFrame:
    """Calendar covering whole years of the staged posting dates; the range is
    a data-derived parameter (one tiny aggregate), the rows are generated."""
    bounds = staged.agg(F.min("posting_date").alias("lo"), F.max("posting_date").alias("hi"))
    spine = bounds.select(F.explode(F.sequence(F.trunc("lo", "year"),
                                               F.date_add(F.add_months(F.trunc("hi", "year"), 12), -1))).alias("d"))
    return spine.select(*[c.alias(n) for n, c in calendar_columns(F.col("d")).items()])

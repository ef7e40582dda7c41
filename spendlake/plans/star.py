"""Star join: the denormalised report frame.

The date and category dimensions are joined as Catalyst sees fit; generated
ones (calendar range, literal rows) are small enough to be broadcast by their
size.  The account dimension grows with the data.  Its side is unique on its
key, so reports without account columns skip that join entirely.  No key of it
gathers an unbounded group: rows without an account get a key of their own that
matches nothing, and accounts with more than a given number of fact rows are
joined map-side against a broadcast of their few dimension rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake import fixed_values as FV
from spendlake.operators.marts import account_attributes

DATE_COLUMNS = ["date_day", "year", "quarter", "month", "month_name", "week_of_year", "day_of_week"]
CATEGORY_COLUMNS = ["category_name", "category_group", "category_type", "category_classification"]
ACCOUNT_COLUMNS = ["account_number", "bank_name", "account_type"]
FACT_COLUMNS = [
    "transaction_key", "date_key", "account_key", "category_key", "amount", "absolute_amount",
    "balance", "transaction_type", "counterparty_name", "transaction_description", "currency",
    "categorization_status",
]
REPORT_COLUMNS = FACT_COLUMNS + DATE_COLUMNS + CATEGORY_COLUMNS + ACCOUNT_COLUMNS


HOT_ACCOUNT_ROWS = 10_000_000


def hot_accounts(fact: DataFrame, hot_rows: int = HOT_ACCOUNT_ROWS) -> DataFrame:
    """Accounts with more than ``hot_rows`` fact rows (at most rows/hot_rows
    of them): one aggregate over the key column, partial on the map side."""
    return (fact.filter(F.col("account_key").isNotNull()).groupBy("account_key")
            .agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > hot_rows))


def _with_accounts(f: DataFrame, dim_account: DataFrame, hot_list: DataFrame) -> DataFrame:
    """Left join of the account attributes, in a form Catalyst removes when
    no account column is used (every account side is unique on its key).

    ``hot_list`` (``hot_accounts``) has at most rows/hot_rows accounts: their
    dimension rows are broadcast.  In the other join their rows, and rows
    without an account, carry a key of their own, so no key there holds more
    than ``hot_rows`` rows."""
    a = dim_account.select(F.col("account_key").alias("_a_key"), *ACCOUNT_COLUMNS).dropDuplicates(["_a_key"])
    hot_keys = hot_list.select(F.col("account_key").alias("_hk"))
    hot = (a.join(F.broadcast(hot_keys), F.col("_a_key") == F.col("_hk"), "left_semi")
           .select(F.col("_a_key").alias("_h_key"), *[F.col(c).alias("_h_" + c) for c in ACCOUNT_COLUMNS]))
    g = f.join(F.broadcast(hot), f["account_key"] == F.col("_h_key"), "left")
    alone = F.col("_h_key").isNotNull() | F.col("account_key").isNull()
    g = g.withColumn("_j_key", F.when(alone, F.concat(F.lit("\u0000"), F.col("transaction_key")))
                      .otherwise(F.col("account_key")))
    g = g.join(a, g["_j_key"] == F.col("_a_key"), "left")
    return g.withColumns({c: F.coalesce(F.col("_h_" + c), F.col(c)) for c in ACCOUNT_COLUMNS})


def _with_dimensions(fact: DataFrame, dim_date: DataFrame, dim_category: DataFrame,
                     columns=FACT_COLUMNS) -> DataFrame:
    """``columns`` of the fact with the date and category attributes.

    The date join of a stored fact is on the month as well, which follows from
    the date: a filter on any calendar attribute then prunes the fact's month
    partitions at run time (dynamic partition pruning)."""
    d = dim_date.select(F.col("date_key").alias("_d_key"), F.trunc("date_key", "month").alias("_d_month"),
                        *DATE_COLUMNS)
    c = dim_category.select(F.col("category_key").alias("_c_key"), *CATEGORY_COLUMNS)
    f = fact.select(*columns, *_layout(fact))
    on_date = f["date_key"] == d["_d_key"]
    if "month_start" in f.columns:
        on_date = on_date & (f["month_start"] == d["_d_month"])
    return f.join(d, on_date, "left").join(c, f["category_key"] == c["_c_key"], "left")


def _layout(fact: DataFrame) -> list[str]:
    """A stored fact's partition column goes along, so that date filters prune files."""
    return [c for c in ("month_start",) if c in fact.columns]


def report_frame(fact: DataFrame, dim_date: DataFrame, dim_category: DataFrame, dim_account: DataFrame,
                 hot_list: DataFrame | None = None, hot_account_rows: int = HOT_ACCOUNT_ROWS) -> DataFrame:
    """Fact LEFT JOIN date, category, account; one row per fact row.

    Every account side is unique on its join key, so the join is many-to-one
    by construction and Catalyst removes it from every report that uses no
    account column -- at scale this saves shuffling the fact by account.
    ``hot_list`` is the stored result of ``hot_accounts`` (written with the
    marts), so queries need not recount."""
    joined = _with_dimensions(fact, dim_date, dim_category)
    hot = hot_list if hot_list is not None else hot_accounts(fact, hot_account_rows)
    return _with_accounts(joined, dim_account, hot).select(*REPORT_COLUMNS, *_layout(fact))


def report_frame_same_run(fact: DataFrame, dim_date: DataFrame, dim_category: DataFrame,
                          bank_name: str = FV.BANK_NAME, checking_prefix: str = FV.CHECKING_PREFIX) -> DataFrame:
    """Report frame for marts built in the same run from the same staging.

    There every non-NULL ``account_key`` (sender or recipient of a staged
    row) is a key of ``dim_account`` (the distinct senders and recipients of
    those rows), and the dimension's attributes are fixed functions of the
    key.  The left join to it therefore equals columns computed from the key:
    no join, no shuffle, and no hot-account skew.  Stored marts use
    ``report_frame``, whose relationships check guards the same fact."""
    joined = _with_dimensions(fact, dim_date, dim_category)
    known = account_attributes(F.col("account_key"), bank_name, checking_prefix)
    return joined.withColumns(known).select(*REPORT_COLUMNS, *_layout(fact))

"""Report queries over the (filtered) report frame.

All are single aggregations with partial (map-side) aggregation; group keys
are low-cardinality dimension attributes or (day, attribute) pairs.  Empty
sums are 0 and NULL group keys are dropped, as in the dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendlake import fixed_values as FV
from spendlake.functions.formatting import int_text, money_text, percent_share
from spendlake.functions.text import search_mask
from spendlake.schemas import MONEY


def _money(c: Column) -> Column:
    return c.cast(MONEY)


def _sum0(c: Column) -> Column:
    return _money(F.coalesce(F.sum(c), F.lit(0)))


def _average(c: Column) -> Column:
    """Unrounded: the exact sum over the count, as a double."""
    return F.sum(c).cast("double") / F.count(c)


def _rows(frame: DataFrame) -> Column:
    """Each row's number of transactions: one, or the count that a summary holds."""
    return F.col("transactions") if "transactions" in frame.columns else F.lit(1)


def _count(frame: DataFrame, where: Column | None = None) -> Column:
    """The number of transactions (that meet a condition)."""
    rows = _rows(frame)
    counted = F.sum(rows if where is None else F.when(where, rows))
    return F.coalesce(counted, F.lit(0)).cast("long")


def _debits(frame: DataFrame) -> DataFrame:
    return frame.filter(F.col("transaction_type") == "debit")


def data_summary(frame: DataFrame) -> DataFrame:
    """Row count and date range of the unfiltered frame."""
    return frame.agg(_count(frame).alias("total_transactions"),
                     F.min("date_day").alias("min_date"), F.max("date_day").alias("max_date"))


def key_metrics(frame: DataFrame) -> DataFrame:
    """Income, absolute expenses, net flow and count in one pass."""
    credit = F.when(F.col("transaction_type") == "credit", F.col("amount"))
    debit = F.when(F.col("transaction_type") == "debit", F.col("amount"))
    return frame.agg(_sum0(credit).alias("income"), _sum0(debit).alias("expenses_signed"),
                     _count(frame).alias("transaction_count")).select(
        "income",
        _money(F.abs("expenses_signed")).alias("total_expenses"),
        _money(F.col("income") + F.col("expenses_signed")).alias("net_flow"),
        "transaction_count",
    ).withColumnRenamed("income", "total_income")


def key_metrics_text(frame: DataFrame, unit: str = FV.DEFAULT_CURRENCY) -> DataFrame:
    """The metric cards as display text."""
    m = key_metrics(frame)
    return m.select(money_text(F.col("total_income"), unit).alias("total_income_text"),
                    money_text(F.col("total_expenses"), unit).alias("total_expenses_text"),
                    money_text(F.col("net_flow"), unit).alias("net_flow_text"),
                    int_text(F.col("transaction_count")).alias("transaction_count_text"))


def income_vs_expenses(frame: DataFrame) -> DataFrame:
    """Two rows (type, amount)."""
    m = key_metrics(frame)
    return m.select(F.inline(F.array(
        F.struct(F.lit("Income").alias("type"), F.col("total_income").alias("amount")),
        F.struct(F.lit("Expenses").alias("type"), F.col("total_expenses").alias("amount")))))


def _by(frame: DataFrame, key: str, value: str, out: str) -> DataFrame:
    return (frame.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(_money(F.sum(value)).alias(out))
            .orderBy(F.desc(out), F.asc(key)))


def expenses_by_category(frame: DataFrame) -> DataFrame:
    return _by(_debits(frame), "category_name", "absolute_amount", "total_expense")


def expenses_by_group(frame: DataFrame) -> DataFrame:
    return _by(_debits(frame), "category_group", "absolute_amount", "total_expense")


def expenses_by_type(frame: DataFrame) -> DataFrame:
    """Essential vs discretionary: expenses by category type."""
    return _by(_debits(frame), "category_type", "absolute_amount", "total_expense")


def daily_cash_flow(frame: DataFrame) -> DataFrame:
    return (frame.filter(F.col("date_day").isNotNull() & F.col("transaction_type").isNotNull())
            .groupBy("date_day", "transaction_type").agg(_money(F.sum("amount")).alias("amount")))


def monthly_summary(frame: DataFrame) -> DataFrame:
    """Per year, month and type: signed and absolute sum, ``YYYY-MM`` period
    and the capitalised series name."""
    keys = ["year", "month", "month_name", "transaction_type"]
    g = frame.filter(F.col("year").isNotNull() & F.col("month").isNotNull()
                     & F.col("month_name").isNotNull() & F.col("transaction_type").isNotNull())
    return g.groupBy(*keys).agg(_money(F.sum("amount")).alias("amount")).select(
        F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0")).alias("period"),
        *keys, "amount", _money(F.abs("amount")).alias("abs_amount"),
        F.initcap("transaction_type").alias("series"))


def monthly_summary_wide(frame: DataFrame, types: Sequence[str] = ("credit", "debit")) -> DataFrame:
    """One row per period, one absolute-amount column per type (pivot with
    the values given, so no extra pass discovers them)."""
    m = monthly_summary(frame)
    return (m.groupBy("period").pivot("transaction_type", list(types))
            .agg(_money(F.sum("abs_amount"))))


def category_by_day(frame: DataFrame) -> DataFrame:
    return (_debits(frame).filter(F.col("date_day").isNotNull() & F.col("category_name").isNotNull())
            .groupBy("date_day", "category_name")
            .agg(_money(F.sum("absolute_amount")).alias("absolute_amount")))


def top_categories(frame: DataFrame, k: int = 5) -> DataFrame:
    """The k categories with the largest expense (ties by name)."""
    return expenses_by_category(frame).limit(k)


def top_category_by_day(frame: DataFrame, k: int = 5) -> DataFrame:
    """Daily series of the top-k categories.  The category totals are summed
    from the per-day aggregate itself (exact decimal sums), so the frame is
    scanned once; the k names (a proven bound) are broadcast to a semi join."""
    daily = category_by_day(frame)
    top = (daily.groupBy("category_name").agg(F.sum("absolute_amount").alias("_total"))
           .orderBy(F.desc("_total"), F.asc("category_name")).limit(k).select("category_name"))
    return daily.join(F.broadcast(top), "category_name", "left_semi")


def uncategorised_share(frame: DataFrame) -> DataFrame:
    return frame.agg(_count(frame, F.col("categorization_status") == "Uncategorized").alias("uncategorised"),
                     _count(frame).alias("transactions")).select(
        "uncategorised", "transactions",
        percent_share(F.col("uncategorised"), F.col("transactions")).alias("uncategorised_pct"))


def transaction_list(frame: DataFrame, columns: Sequence[str] = FV.TRANSACTION_LIST_DEFAULT,
                     limit: int | None = None) -> DataFrame:
    """Chosen columns (from the allowed set), newest first."""
    bad = [c for c in columns if c not in FV.TRANSACTION_LIST_COLUMNS]
    if bad:
        raise ValueError(f"columns not offered by the transaction list: {bad}")
    cols = list(columns)
    out = frame.orderBy(F.desc_nulls_last("date_day"), F.asc("transaction_key")).select(*cols)
    return out.limit(limit) if limit is not None else out


def transaction_page(frame: DataFrame, size: int, after: tuple | None = None,
                     columns: Sequence[str] = FV.TRANSACTION_LIST_DEFAULT) -> DataFrame:
    """One page of the transaction list: the ``size`` rows behind the last row
    (date or None, key) of the page before, with ``transaction_key`` to go on from.

    Pages one after the other are the whole list.  Each is a top-k of the rows
    behind the key, so no page sorts the fact (``Ledger.page`` reads the months
    it needs only)."""
    bad = [c for c in columns if c not in FV.TRANSACTION_LIST_COLUMNS]
    if bad:
        raise ValueError(f"columns not offered by the transaction list: {bad}")
    day, key = F.col("date_day"), F.col("transaction_key")
    if after is not None:
        last_day, last_key = after
        if last_day is None:  # undated rows come last
            frame = frame.filter(day.isNull() & (key > F.lit(last_key)))
        else:
            behind = (day < F.lit(last_day)) | ((day == F.lit(last_day)) & (key > F.lit(last_key)))
            frame = frame.filter(behind | day.isNull())
    shown = [c for c in columns if c != "transaction_key"]
    return (frame.orderBy(F.desc_nulls_last("date_day"), F.asc("transaction_key")).limit(size)
            .select("transaction_key", *shown))


def transaction_search(frame: DataFrame, term: str | None, literal: bool = False) -> DataFrame:
    """Rows whose description or counterparty matches ``term`` (regex,
    case-insensitive); all rows when the term is empty."""
    if not term:
        return frame
    return frame.filter(search_mask(term, F.col("transaction_description"), F.col("counterparty_name"),
                                    literal=literal))


def category_list(frame: DataFrame) -> DataFrame:
    """Distinct category names, sorted (the filter's choices)."""
    return (frame.filter(F.col("category_name").isNotNull()).select("category_name")
            .distinct().orderBy("category_name"))


def total_amount(fact: DataFrame) -> DataFrame:
    return fact.agg(_sum0(F.col("amount")).alias("total_amount"))


def measures(fact: DataFrame) -> DataFrame:
    """Total, income, expenses, net flow, count and average as one pass."""
    credit = F.when(F.col("transaction_type") == "credit", F.col("amount"))
    debit = F.when(F.col("transaction_type") == "debit", F.col("amount"))
    return fact.agg(
        _sum0(F.col("amount")).alias("total_amount"),
        _sum0(credit).alias("total_income"),
        _sum0(debit).alias("total_expenses"),
        F.count(F.lit(1)).alias("transaction_count"),
        _average(F.col("absolute_amount")).alias("average_transaction"),
    ).withColumn("net_flow", _money(F.col("total_income") + F.col("total_expenses")))


def average_transaction(fact: DataFrame) -> DataFrame:
    return fact.agg(_average(F.col("absolute_amount")).alias("average_transaction"))


def category_matrix(frame: DataFrame) -> DataFrame:
    """Amounts by group and category with group subtotals and a grand total
    (``level`` 0 = category, 1 = group subtotal, 3 = total)."""
    return (frame.rollup("category_group", "category_name")
            .agg(_money(F.sum("amount")).alias("amount"),
                 _money(F.sum("absolute_amount")).alias("absolute_amount"),
                 _count(frame).alias("transactions"),
                 F.grouping_id().cast("int").alias("level")))


def spending_without_transfers(frame: DataFrame) -> DataFrame:
    return _by(_debits(frame).filter(F.col("category_type") != "Transfer"),
               "category_name", "absolute_amount", "total_expense")


def daily_balance(fact: DataFrame) -> DataFrame:
    """Balance per account and day: the balance of the day's last record in the
    newest export (exports list transactions in order).  A fact without
    ``row_in_file`` gives the row with the largest key, a deterministic choice."""
    order = ["source_file", "row_in_file"] if "row_in_file" in fact.columns else []
    last = W.partitionBy("account_key", "date_key").orderBy(*map(F.desc, [*order, "transaction_key"]))
    # a limit of one row per group goes before the shuffle; a maximum over text would sort all rows
    return (fact.filter(F.col("account_key").isNotNull() & F.col("date_key").isNotNull())
            .withColumn("_rn", F.row_number().over(last)).filter(F.col("_rn") == 1)
            .select("account_key", "date_key", "balance"))


def amount_by_date(frame: DataFrame) -> DataFrame:
    return (frame.filter(F.col("date_day").isNotNull()).groupBy("date_day")
            .agg(_money(F.sum("amount")).alias("amount")))


def amount_by_category(frame: DataFrame) -> DataFrame:
    return (frame.filter(F.col("category_name").isNotNull()).groupBy("category_name")
            .agg(_money(F.sum("amount")).alias("amount")))


def categories_in_use(dim_category: DataFrame, fact: DataFrame) -> DataFrame:
    """Category rows that occur in the fact, in display order (semi join
    against the distinct fact keys, then ``sort_order``)."""
    used = fact.select("category_key").filter(F.col("category_key").isNotNull()).distinct()
    return (dim_category.join(used, "category_key", "left_semi")
            .orderBy("sort_order", "category_key"))

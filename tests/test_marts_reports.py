import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from spendlake.operators import filters, marts, reports
from spendlake.plans.model import Model


@pytest.fixture(scope="module")
def model(spark):
    return Model(spark, SF0001)


def test_dim_category(spark):
    d = {r["category_key"]: r for r in marts.dim_category(spark).collect()}
    assert len(d) == 22
    assert d["CAT016"]["category_classification"] == "Income"
    assert d["CAT021"]["category_classification"] == "Transfer"
    assert d["CAT001"]["category_classification"] == "Expense - Essential"
    assert d["CAT002"]["category_classification"] == "Expense - Discretionary"
    assert d["CAT999"]["category_classification"] == "Expense - Unknown"


def test_dim_date_default_range(spark):
    d = marts.dim_date(spark)
    assert d.count() == 4018
    r = d.filter(F.col("date_key") == "2024-12-30").first()
    assert (r.week_of_year, r.day_of_week, r.day_name, r.year_quarter) == (1, 1, "Monday", "2024-Q4")


def test_dim_account_distinct_and_types(model):
    rows = model.dim_account.collect()
    keys = [r.account_key for r in rows]
    assert len(keys) == len(set(keys)) and None not in keys
    assert all((r.account_type == "Checking") == r.account_number.startswith("07") for r in rows)
    staged = model.staged.toPandas()
    want = set(staged.sender_account.dropna()) | set(staged.recipient_account.dropna())
    assert set(keys) == want


def test_star_join_keeps_fact_rows(model):
    assert model.frame.count() == model.fact.count() == 555


FRAME = ("date_day date, year int, month int, month_name string, transaction_type string, amount decimal(18,2), "
         "absolute_amount decimal(18,2), category_name string, category_group string, category_type string, "
         "transaction_description string, counterparty_name string, categorization_status string, transaction_key string")


@pytest.fixture(scope="module")
def small(spark):
    """Eight rows whose reports can be added up by hand."""
    def row(key, day, kind, amount, category, group, ctype, text, party, status="Matched"):
        d = dt.date.fromisoformat(day)
        return (d, d.year, d.month, d.strftime("%B"), kind, Decimal(amount), abs(Decimal(amount)), category, group,
                ctype, text, party, status, key)
    return spark.createDataFrame([
        row("a", "2024-01-05", "credit", "1000.00", "Salary", "Income", "Income", "pay", "Firm"),
        row("b", "2024-01-05", "debit", "-100.50", "Rent", "Housing", "Essential", "Spring rent", None),
        row("c", "2024-01-06", "debit", "-20.25", "Food", "Living", "Essential", None, "BOLT"),
        row("d", "2024-02-01", "debit", "-30.00", "Food", "Living", "Essential", "shop", "x"),
        row("e", "2024-02-01", "debit", "-5.00", "Fees", "Bank", "Other", "fee", None),
        row("f", "2024-02-02", "debit", "-5.00", "Games", "Fun", "Other", "play", None),
        row("g", "2024-02-02", "debit", "-1.00", "Books", "Fun", "Other", "read", None),
        row("h", "2024-02-03", "debit", "-0.50", None, None, None, "?", None, "Uncategorized"),
    ], FRAME)


def test_reports_of_a_small_frame(small):
    m = reports.key_metrics(small).first()
    assert (m.total_income, m.total_expenses, m.net_flow, m.transaction_count) == (
        Decimal("1000.00"), Decimal("162.25"), Decimal("837.75"), 8)
    assert [(r.category_name, str(r.total_expense)) for r in reports.expenses_by_category(small).collect()] == [
        ("Rent", "100.50"), ("Food", "50.25"), ("Fees", "5.00"), ("Games", "5.00"), ("Books", "1.00")]
    assert [r.category_name for r in reports.top_categories(small, 3).collect()] == ["Rent", "Food", "Fees"]
    daily = {(str(r.date_day), r.transaction_type): str(r.amount) for r in reports.daily_cash_flow(small).collect()}
    assert daily == {("2024-01-05", "credit"): "1000.00", ("2024-01-05", "debit"): "-100.50",
                     ("2024-01-06", "debit"): "-20.25", ("2024-02-01", "debit"): "-35.00",
                     ("2024-02-02", "debit"): "-6.00", ("2024-02-03", "debit"): "-0.50"}
    monthly = {(r.period, r.series): str(r.abs_amount) for r in reports.monthly_summary(small).collect()}
    assert monthly == {("2024-01", "Credit"): "1000.00", ("2024-01", "Debit"): "120.75", ("2024-02", "Debit"): "41.50"}
    share = reports.uncategorised_share(small).first()
    assert (share.uncategorised, share.transactions, share.uncategorised_pct) == (1, 8, 12.5)
    assert {r.transaction_key for r in reports.transaction_search(small, "ring|bolt").collect()} == {"b", "c"}
    assert reports.transaction_search(small, "").count() == 8


def test_income_vs_expenses_and_text(model):
    rows = {r.type: r.amount for r in reports.income_vs_expenses(model.filtered).collect()}
    km = reports.key_metrics(model.filtered).first()
    assert rows == {"Income": km.total_income, "Expenses": km.total_expenses}
    t = reports.key_metrics_text(model.filtered).first()
    assert t.total_income_text == f"{km.total_income:,.2f} DKK"
    assert t.transaction_count_text == f"{km.transaction_count:,}"


def test_filters(model):
    frame = model.frame
    assert filters.transaction_types(frame, []).count() == 0
    assert filters.categories(frame, ["All", "Rent"]).count() == frame.count()
    assert filters.categories(frame, []).count() == frame.count()
    only = filters.categories(frame, ["Rent"])
    assert only.count() == frame.filter(F.col("category_name") == "Rent").count() > 0
    jan = filters.slicers(frame, year=2024, month=1)
    assert jan.count() == frame.filter((F.col("year") == 2024) & (F.col("month") == 1)).count()
    r = filters.date_range(frame, "2024-01-10", "2024-01-12")
    assert r.agg(F.min("date_day"), F.max("date_day")).first()[0].isoformat() >= "2024-01-10"


def test_transaction_list_columns(model):
    with pytest.raises(ValueError):
        reports.transaction_list(model.filtered, ["balance"])
    rows = reports.transaction_list(model.filtered, ["date_day", "amount"], limit=10).collect()
    assert len(rows) == 10 and rows[0].date_day >= rows[-1].date_day


def test_calendar_outside_range_gives_null_day(spark):
    m = Model(spark, SF0001, calendar=("2020-01-01", "2020-12-31"))
    assert m.frame.filter(F.col("date_day").isNotNull()).count() == 0
    assert reports.data_summary(m.frame).first().min_date is None


def test_category_matrix_totals(model):
    rows = reports.category_matrix(model.frame).collect()
    total = [r for r in rows if r.level == 3][0]
    assert total.amount == model.fact.agg(F.sum("amount")).first()[0]
    groups = [r for r in rows if r.level == 1]
    assert sum(r.transactions for r in groups) == total.transactions


def test_daily_balance_rule(model):
    fact = model.fact.toPandas()
    fact = fact.dropna(subset=["account_key", "date_key"])
    want = {}
    for r in fact.sort_values("transaction_key").itertuples():
        want[r.account_key, r.date_key] = r.balance
    got = {(r.account_key, r.date_key): r.balance for r in reports.daily_balance(model.fact).collect()}
    assert got == want


def test_measures(spark):
    fact = spark.createDataFrame([("credit", Decimal("10.00"), Decimal("10.00")), ("debit", Decimal("-2.00"), Decimal("2.00")),
                                  ("debit", Decimal("-1.00"), Decimal("1.00"))],
                                 "transaction_type string, amount decimal(18,2), absolute_amount decimal(18,2)")
    m = reports.measures(fact).first()
    assert (m.total_amount, m.total_income, m.total_expenses, m.net_flow, m.transaction_count) == (
        Decimal("7.00"), Decimal("10.00"), Decimal("-3.00"), Decimal("7.00"), 3)
    assert m.average_transaction == 13 / 3
    none = reports.measures(fact.limit(0)).first()
    assert none.total_amount == 0 and none.transaction_count == 0 and none.average_transaction is None

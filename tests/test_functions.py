import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from spendlake.functions.calendar import calendar_columns
from spendlake.functions.formatting import int_text, money_text, percent_share
from spendlake.functions.text import (account_from_file_name, amount_hash_text, decode_file_name,
                                      parse_locale_decimal, pending_to_null, row_hash, search_mask)


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("out")).first()["out"]


def test_locale_decimal(spark):
    cases = {"-1.234,56": Decimal("-1234.56"), "1234.56": Decimal("123456.00"), "12.345.678,90": Decimal("12345678.90"),
             "5": Decimal("5.00"), "": None, None: None}
    for text, want in cases.items():
        assert one(spark, parse_locale_decimal(F.col("v")), text) == want


def test_pending_marker(spark):
    assert one(spark, pending_to_null(F.col("v")), "Reserveret") is None
    assert one(spark, pending_to_null(F.col("v")), "") is None
    assert one(spark, pending_to_null(F.col("v")), "2024/01/05") == "2024/01/05"


def test_amount_hash_text_matches_float_text(spark):
    for v in ["100.00", "-100.00", "12.50", "12.34", "0.10", "12345678.90", "-0.05", "0.00"]:
        got = one(spark, amount_hash_text(F.col("v").cast("decimal(18,2)")), v)
        assert got == str(float(v)), v


def test_row_hash_text(spark):
    df = spark.createDataFrame([("2024/01/05", Decimal("-100.00"), "a", "b", "c", None)],
                               "d string, a decimal(18,2), de string, n string, s string, r string")
    got = df.select(row_hash(*[F.col(c) for c in ["d", "a", "de", "n", "s", "r"]])).first()[0]
    assert got == hashlib.md5("2024/01/05|-100.0|a|b|c|".encode()).hexdigest()


def test_account_from_file_name(spark):
    f = account_from_file_name(F.col("v"))
    assert one(spark, f, "Konto 0718425948 - 2024-02-01 08.00.00.csv") == "Konto 0718425948"
    assert one(spark, f, "other.csv") == "other.csv"
    assert one(spark, f, "Konto 1.csv") == "Konto 1.csv"


def test_decode_file_name(spark):
    assert one(spark, decode_file_name(F.col("v")), "Konto%200718%20-%20a+b.csv") == "Konto 0718 - a+b.csv"


def test_search_mask_unicode_case(spark):
    df = spark.createDataFrame([("FØTEX city", None), (None, "føtex"), ("netto", "x")], "a string, b string")
    got = [r[0] for r in df.select(search_mask("føtex", F.col("a"), F.col("b"))).collect()]
    assert got == [True, True, False]
    got = [r[0] for r in df.select(search_mask("f.tex", F.col("a"), F.col("b"), literal=True)).collect()]
    assert got == [False, False, False]


def test_calendar_against_python(spark):
    start = dt.date(2019, 12, 25)
    days = [start + dt.timedelta(days=i) for i in range(800)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    cols = calendar_columns(F.col("d"))
    rows = df.select(*[c.alias(n) for n, c in cols.items()]).collect()
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    for d, r in zip(days, rows):
        iso = d.isocalendar()
        assert r.year == d.year and r.month == d.month and r.day_of_month == d.day
        assert r.quarter == (d.month - 1) // 3 + 1
        assert r.week_of_year == iso[1] and r.day_of_week == iso[2]
        assert r.day_name == names[iso[2] - 1] and r.month_name == d.strftime("%B")
        assert r.is_weekend == (iso[2] >= 6)
        assert r.day_of_year == d.timetuple().tm_yday
        assert r.year_month == d.strftime("%Y-%m") and r.year_quarter == f"{d.year}-Q{r.quarter}"
        assert r.is_first_day_of_month == (d.day == 1)
        assert r.is_last_day_of_month == ((d + dt.timedelta(days=1)).day == 1)


def test_formatting(spark):
    df = spark.createDataFrame([(Decimal("12345.6"), 12345, 3, 7)], "m decimal(18,2), n long, a long, b long")
    r = df.select(money_text(F.col("m")), int_text(F.col("n")), percent_share(F.col("a"), F.col("b"))).first()
    assert r[0] == "12,345.60 DKK" and r[1] == "12,345" and r[2] == 42.9
    assert df.select(percent_share(F.col("a"), F.lit(0))).first()[0] is None

"""Explicit schemas; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Export rows after header binding and number parsing; the date stays text
# because the row key hashes the text (the adapters produce the same shape,
# so the whole load path is shared).
EXPORT_ROWS = T.StructType([
    T.StructField("posting_date_text", T.StringType()),
    T.StructField("amount", MONEY),
    T.StructField("sender", T.StringType()),
    T.StructField("recipient", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("balance", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("reconciled", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("row_in_file", T.LongType()),
])

# Stored tables of a ledger; the month is the partition column.  A row's place
# in its file is (split start, record), as the CSV scan gives it.
TOTAL = T.DecimalType(28, 2)
POSITION = T.StructType([T.StructField("split_start", T.LongType()), T.StructField("record", T.LongType())])


def _table(texts: str, **typed: T.DataType) -> T.StructType:
    """Text columns (their names) but for those with a type; in the order of ``texts``."""
    return T.StructType([T.StructField(c, typed.get(c, T.StringType())) for c in texts.split()])


RAW = _table("transaction_hash posting_date amount sender recipient name description balance currency reconciled "
             "source_file row_in_file loaded_at month_start",
             posting_date=T.DateType(), amount=MONEY, balance=MONEY, row_in_file=POSITION,
             loaded_at=T.TimestampType(), month_start=T.DateType())
FACT = _table("transaction_key date_key account_key amount absolute_amount balance transaction_type "
              "counterparty_name transaction_description currency category_key categorization_status source_file "
              "row_in_file loaded_at month_start",
              date_key=T.DateType(), amount=MONEY, absolute_amount=MONEY, balance=MONEY, row_in_file=POSITION,
              loaded_at=T.TimestampType(), month_start=T.DateType())
SUMMARY = _table("date_key account_key category_key categorization_status transaction_type amount absolute_amount "
                 "transactions month_start",
                 date_key=T.DateType(), amount=TOTAL, absolute_amount=TOTAL, transactions=T.LongType(),
                 month_start=T.DateType())

RULES = T.StructType([
    T.StructField("pattern_type", T.StringType()),
    T.StructField("pattern_value", T.StringType()),
    T.StructField("category_key", T.StringType()),
    T.StructField("priority", T.IntegerType()),
])

CATEGORY_ROWS = T.StructType([
    T.StructField("category_key", T.StringType()),
    T.StructField("category_name", T.StringType()),
    T.StructField("category_group", T.StringType()),
    T.StructField("category_type", T.StringType()),
    T.StructField("sort_order", T.IntegerType()),
])

CHECK_RESULTS = T.StructType([
    T.StructField("check_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("failures", T.LongType()),
])

"""Staging projection: renames, sign classification, absolute amount."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("posting_date").isNotNull()).select(
        "transaction_hash",
        "posting_date",
        "amount",
        "balance",
        "currency",
        F.col("sender").alias("sender_account"),
        F.col("recipient").alias("recipient_account"),
        F.col("name").alias("counterparty_name"),
        F.col("description").alias("transaction_description"),
        F.col("reconciled").alias("is_reconciled"),
        F.when(F.col("amount") < 0, F.lit("debit")).otherwise(F.lit("credit")).alias("transaction_type"),
        F.abs("amount").alias("absolute_amount"),
        "source_file",
        *[c for c in ("row_in_file", "loaded_at") if c in raw.columns],
    )

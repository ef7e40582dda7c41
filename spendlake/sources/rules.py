"""Category rule tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendlake import fixed_values as FV
from spendlake.schemas import RULES

# Fixture rules used by the contract queries on the adapters: ties, overlaps,
# mixed case and one rule that can never match (types are debit/credit).
FIXTURE_RULES = [
    ("description", "ring", "CAT001", 100),
    ("description", "gear", "CAT002", 90),
    ("description", "old", "CAT003", 90),
    ("description", "bolt", "CAT004", 100),
    ("description", "red", "CAT017", 100),
    ("description", "hot", "CAT016", 80),
    ("description", "WIDGET", "CAT021", 100),
    ("name", "customer#00000000", "CAT020", 70),
    ("transaction_type", "credit", "CAT018", 50),
    ("transaction_type", "income", "CAT016", 50),
]


# Wildcards, NULL keys, NULL priorities, NULL patterns and an unknown type.
ODD_RULES = [
    ("description", "g%r r", "CAT001", 100),
    ("description", "_lue%bolt", "CAT002", None),
    ("description", "large", None, 120),
    ("description", "%", "CAT003", None),
    ("name", "customer#0000000_1", "CAT020", 110),
    ("name", "customer#", None, None),
    ("transaction_type", "CREDIT", "CAT018", 90),
    ("transaction_type", "deb%", "CAT016", 130),
    ("description", None, "CAT004", 500),
    ("counterparty", "a", "CAT005", 500),
]

# More rules than generated code holds well: one for each customer number that
# ends in 000 to 399, of several priorities.
MANY_RULES = [("name", f"{k:03d}", f"CAT{k % 21 + 1:03d}", 50 + k % 7) for k in range(400)] + FIXTURE_RULES


def rules_frame(spark: SparkSession, rows=None) -> DataFrame:
    """Rule table from rows (default: the standard seed)."""
    return spark.createDataFrame(list(FV.DEFAULT_RULES if rows is None else rows), RULES)


def read_rules_csv(spark: SparkSession, path: str) -> DataFrame:
    """Seed CSV with header ``pattern_type,pattern_value,category_key,priority``."""
    return (spark.read.schema(RULES)
            .options(header=True, sep=",", quote='"', escape='"', encoding="UTF-8", mode="FAILFAST")
            .csv(path))

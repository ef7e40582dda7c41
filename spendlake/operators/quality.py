"""Data-quality checks: unique, not_null, accepted_values, relationships.

Failure counts follow the usual definitions: ``unique`` counts duplicated
non-NULL values, ``not_null`` counts NULL rows, ``accepted_values`` counts
distinct non-NULL values outside the list, ``relationships`` counts child
rows whose non-NULL key has no parent.  All NULL and accepted-value checks
of one table run in a single aggregate pass; each ``unique`` check is one
aggregation with partial aggregation; each relationship is one anti join.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.schemas import CHECK_RESULTS


@dataclass
class TableChecks:
    frame: DataFrame
    unique: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    accepted: dict[str, list[str]] = field(default_factory=dict)
    # column -> (parent table name, parent column)
    relationships: dict[str, tuple[str, str]] = field(default_factory=dict)


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their ``count``.  A table bucketed by
    the column is aggregated bucket by bucket, without a shuffle."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).count().filter(F.col("count") > 1)


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    return repeated_keys(df, column).agg(F.count(F.lit(1)).alias("failures"))


def null_and_accepted_failures(df: DataFrame, not_null: list[str],
                               accepted: dict[str, list[str]]) -> DataFrame:
    """One pass: NULL counts, and the number of distinct values outside each
    list (a distinct aggregate, shuffled on the value, never gathered)."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"nn__{c}") for c in not_null]
    aggs += [F.count_distinct(F.when(F.col(c).isNotNull() & ~F.col(c).isin(v), F.col(c))).alias(f"av__{c}")
             for c, v in accepted.items()]
    return df.agg(*aggs)


def relationship_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows without a parent.  Rows are counted per key before the join, so a
    key that a large share of the rows has is one row in it."""
    p = parent.select(F.col(parent_column).alias("_parent_key")).filter(F.col("_parent_key").isNotNull())
    keys = (child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_child_key"))
            .agg(F.count(F.lit(1)).alias("_rows")))
    orphans = keys.join(p, F.col("_child_key") == F.col("_parent_key"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("failures"))


def run_checks(spark: SparkSession, tables: dict[str, TableChecks]) -> DataFrame:
    """All checks -> DataFrame(check_name, table_name, column_name, failures)."""
    parts: list[DataFrame] = []
    for tname, spec in tables.items():
        if spec.not_null or spec.accepted:
            one = null_and_accepted_failures(spec.frame, spec.not_null, spec.accepted)
            cols = [F.struct(F.lit("not_null").alias("check_name"), F.lit(tname).alias("table_name"),
                             F.lit(c).alias("column_name"), F.col(f"nn__{c}").cast("long").alias("failures"))
                    for c in spec.not_null]
            cols += [F.struct(F.lit("accepted_values").alias("check_name"), F.lit(tname).alias("table_name"),
                              F.lit(c).alias("column_name"), F.col(f"av__{c}").cast("long").alias("failures"))
                     for c in spec.accepted]
            parts.append(one.select(F.inline(F.array(*cols))))
        for c in spec.unique:
            parts.append(unique_failures(spec.frame, c).select(
                F.lit("unique").alias("check_name"), F.lit(tname).alias("table_name"),
                F.lit(c).alias("column_name"), F.col("failures").cast("long")))
        for c, (ptable, pcol) in spec.relationships.items():
            parent = tables[ptable].frame
            parts.append(relationship_failures(spec.frame, c, parent, pcol).select(
                F.lit("relationships").alias("check_name"), F.lit(tname).alias("table_name"),
                F.lit(c).alias("column_name"), F.col("failures").cast("long")))
    if not parts:
        return spark.createDataFrame([], CHECK_RESULTS)
    return reduce(lambda a, b: a.unionByName(b), parts)


def standard_checks(staged: DataFrame, fact: DataFrame, dim_date: DataFrame,
                    dim_account: DataFrame) -> dict[str, TableChecks]:
    """The 21 checks on staging and marts."""
    types = ["debit", "credit"]
    return {
        "stg_transactions": TableChecks(
            staged, unique=["transaction_hash"],
            not_null=["transaction_hash", "posting_date", "amount", "currency"],
            accepted={"currency": ["DKK"], "transaction_type": types}),
        "dim_date": TableChecks(dim_date, unique=["date_key"], not_null=["date_key", "date_day"]),
        "dim_account": TableChecks(dim_account, unique=["account_key"],
                                   not_null=["account_key", "account_number"]),
        "fct_transactions": TableChecks(
            fact, unique=["transaction_key"],
            not_null=["transaction_key", "date_key", "account_key", "amount"],
            accepted={"transaction_type": types},
            relationships={"date_key": ("dim_date", "date_key"),
                           "account_key": ("dim_account", "account_key")}),
    }


class ChecksFailed(RuntimeError):
    pass


def assert_checks(results: DataFrame) -> DataFrame:
    """Raise when any check has failures (the pipeline stops there).  Only
    the failing check rows (at most one per check) reach the driver."""
    failing = results.filter(F.col("failures") > 0).collect()
    if failing:
        text = ", ".join(f"{r.check_name}({r.table_name}.{r.column_name})={r.failures}" for r in failing)
        raise ChecksFailed(f"{len(failing)} check(s) failed: {text}")
    return results

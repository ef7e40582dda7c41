"""Plan shape assertions and the driver contract."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF0001
from spendlake.operators import ingest
from spendlake.plans.model import Model


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_anywhere(spark):
    m = Model(spark, SF0001)
    for df in (m.raw, m.categorised, m.frame, m.filtered):
        p = plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_categoriser_is_map_only(spark):
    m = Model(spark, SF0001)
    p = m.categorised._jdf.queryExecution().optimizedPlan().toString()
    staged = m.staged._jdf.queryExecution().optimizedPlan().toString()
    # categorisation adds a projection only: no join, aggregate or window beyond staging's own
    assert p.count("Join") == staged.count("Join")
    assert p.count("Aggregate") == staged.count("Aggregate")
    assert p.count("Window") == staged.count("Window")


def test_bounded_dimensions_are_broadcast(spark):
    m = Model(spark, SF0001)
    p = m.frame._jdf.queryExecution().sparkPlan().toString()
    assert p.count("BroadcastHashJoin") >= 2


def test_unused_account_join_is_removed(spark):
    from spendlake.operators import filters, reports
    from spendlake.plans.star import report_frame
    m = Model(spark, SF0001)
    stored = filters.dashboard(report_frame(m.fact, m.dim_date, m.dim_category, m.dim_account))
    p = reports.expenses_by_category(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "_a_key" not in p  # the account dimension is not joined at all
    q = reports.transaction_list(stored, ["account_number"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_a_key" in q


def test_large_account_dimension_join(spark):
    from spendlake.operators import filters, reports
    from spendlake.plans.star import report_frame
    m = Model(spark, SF0001)
    large = report_frame(m.fact, m.dim_date, m.dim_category, m.dim_account, hot_account_rows=3)
    plain = report_frame(m.fact, m.dim_date, m.dim_category, m.dim_account)
    p = reports.expenses_by_category(filters.dashboard(large))._jdf.queryExecution().optimizedPlan().toString()
    assert "_a_key" not in p and "_h_key" not in p  # unused: no account join, no hot-key aggregate
    cols = ["transaction_key", "account_number", "bank_name", "account_type"]
    def rows(df):
        return sorted(tuple("" if v is None else str(v) for v in r) for r in df.select(*cols).collect())
    assert rows(large) == rows(plain)
    assert "_h_key" in large.select(*cols)._jdf.queryExecution().optimizedPlan().toString()


def test_same_run_frame_equals_joined_frame(spark):
    from spendlake.plans.star import report_frame
    m = Model(spark, SF0001)
    joined = report_frame(m.fact, m.dim_date, m.dim_category, m.dim_account)
    assert "_a_key" not in m.frame._jdf.queryExecution().optimizedPlan().toString()
    def rows(df):
        return sorted(tuple("" if v is None else str(v) for v in r) for r in df.select(*joined.columns).collect())
    assert rows(m.frame) == rows(joined)


def test_dedupe_limits_groups_before_the_shuffle(spark):
    m = Model(spark, SF0001)
    p = plan(ingest.dedupe_by_key(m.kept))
    assert "WindowGroupLimit" in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    m = Model(spark, SF0001)
    p = plan(m.raw)
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in p
    assert "IsNotNull(p_partkey)" in p


def test_hash_aggregates_for_newest_export_and_daily_balance(spark):
    from spendlake.operators import reports
    m = Model(spark, SF0001)
    assert "SortAggregate" not in plan(m.kept)
    assert "SortAggregate" not in plan(reports.daily_balance(m.fact))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["category_name", "total_expense"]
    assert df.count() > 0


def test_every_query_has_oracle_sql():
    from spendlake.plans.catalogue import QUERIES
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


SAMPLE = ["ingest_audit_by_file", "ingest_audit_append", "ingest_bind_headers", "ingest_rejects",
          "categorise_odd_rules", "report_frame_large_dim", "measures", "categorise_transactions", "dim_date", "report_frame", "monthly_summary_wide",
          "top_category_by_day", "category_matrix", "check_all"]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ["events", "part", "customer"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    df = E.queries()[name](spark, SF0001)
    cur = con.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(o_cols)

    def norm(cols, rows):
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted(tuple("" if r[i] is None else str(r[i]) for i in idx) for r in rows)
    assert norm(df.columns, [tuple(r) for r in df.collect()]) == norm(o_cols, cur.fetchall())

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import HEADER, SF0001, write_csv
from spendlake.operators import quality
from spendlake.plans import pipeline
from spendlake.plans.model import Model


def test_each_check_passes_and_fails(spark):
    good = spark.createDataFrame([("a", "debit"), ("b", "credit")], "k string, t string")
    bad = spark.createDataFrame([("a", "debit"), ("a", "x"), (None, "y"), (None, None)], "k string, t string")
    parent = spark.createDataFrame([("a",)], "k string")
    spec = lambda df: {"t": quality.TableChecks(df, unique=["k"], not_null=["k"], accepted={"t": ["debit", "credit"]},
                                                relationships={"k": ("p", "k")}),
                       "p": quality.TableChecks(parent)}
    ok = {(r.check_name, r.column_name): r.failures for r in quality.run_checks(spark, spec(good.filter("k = 'a'"))).collect()}
    assert set(ok.values()) == {0}
    res = {(r.check_name, r.column_name): r.failures for r in quality.run_checks(spark, spec(bad)).collect()}
    assert res == {("unique", "k"): 1, ("not_null", "k"): 2, ("accepted_values", "t"): 2, ("relationships", "k"): 0}
    orphan = spark.createDataFrame([("z", "debit")], "k string, t string")
    res = {(r.check_name, r.column_name): r.failures for r in quality.run_checks(spark, spec(orphan)).collect()}
    assert res[("relationships", "k")] == 1
    with pytest.raises(quality.ChecksFailed):
        quality.assert_checks(quality.run_checks(spark, spec(bad)))


def test_21_checks_on_adapter(spark):
    m = Model(spark, SF0001)
    res = quality.run_checks(spark, quality.standard_checks(m.staged, m.fact, m.dim_date, m.dim_account)).collect()
    assert len(res) == 21
    failing = {(r.table_name, r.check_name, r.column_name) for r in res if r.failures > 0}
    assert failing == {("fct_transactions", "not_null", "account_key")}  # parties missing on purpose


def csv_dir(tmp_path):
    d = tmp_path / "exports"
    d.mkdir()
    write_csv(d / "Konto 0718 - 2024-02-01 08.00.00.csv", HEADER, [
        ["2024/01/10", "-45,50", "0718", "", "NETTO", "Netto 123", "1.000,00", "DKK", ""],
        ["2024/01/11", "25.000,00", "", "0718", "Firma", "Løn januar", "26.000,00", "DKK", ""],
        ["Reserveret", "-10,00", "0718", "", "", "pending", "", "DKK", ""],
    ])
    write_csv(d / "Konto 0718 - 2024-01-16 08.00.00.csv", HEADER, [
        ["2024/01/10", "-99,00", "0718", "", "", "superseded", "", "DKK", ""],
        ["2024/01/09", "-5,00", "0718", "", "", "Coffee Shop", "900,00", "DKK", ""],
    ])
    return d


def test_run_pipeline_end_to_end(spark, tmp_path):
    out = str(tmp_path / "out")
    res = pipeline.run_pipeline(spark, out, csv_dir=str(csv_dir(tmp_path)))
    assert res.checks.filter(F.col("failures") > 0).count() == 0
    cats = {r.transaction_description: (r.category_name, r.categorization_status) for r in res.frame.collect()}
    assert cats == {"Netto 123": ("Groceries", "Matched"), "Løn januar": ("Salary", "Matched"),
                    "Coffee Shop": ("Bank Fees", "Matched")}
    assert res.raw.filter(F.col("loaded_at").isNull()).count() == 0
    audit = {r.source_file: r for r in spark.read.parquet(f"{out}/load_audit").collect()}
    assert audit[None].parsed == 5 and audit[None].pending == 1 and audit[None].superseded == 1
    assert audit[None].inserted == 3
    n = pipeline.export_search(res.frame, "netto|coffee", str(tmp_path / "search"))
    assert n == 2
    # skip the load (no exports needed), then skip the models too
    res2 = pipeline.run_pipeline(spark, out, skip_load=True)
    assert res2.frame.count() == 3
    res3 = pipeline.run_pipeline(spark, out, skip_load=True, skip_models=True)
    assert res3.checks is None and res3.frame.count() == 3
    assert spark.read.parquet(f"{out}/marts/hot_accounts").count() == 0
    counts = pipeline.export_marts(spark, f"{out}/marts", str(tmp_path / "export"))
    assert counts["fct_transactions"] == 3 and counts["dim_category"] == 22 and counts["dim_date"] == 4018
    back = spark.read.options(header=True).csv(str(tmp_path / "export" / "dim_category"))
    assert back.filter(F.col("category_name") == "Food & Dining").count() == 0
    assert back.filter(F.col("category_group") == "Food & Dining").count() == 3


def test_pipeline_append_and_missing_input(spark, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        pipeline.run_pipeline(spark, out, csv_dir=str(tmp_path / "nothing"))
    d = csv_dir(tmp_path)
    pipeline.run_pipeline(spark, out, csv_dir=str(d))
    write_csv(d / "Konto 0718 - 2024-03-01 08.00.00.csv", HEADER, [
        ["2024/02/20", "-1,00", "0718", "", "", "new row", "", "DKK", ""],
        ["2024/01/10", "-45,50", "0718", "", "NETTO", "Netto 123", "1.000,00", "DKK", ""],
    ])
    res = pipeline.run_pipeline(spark, out, csv_dir=str(d), append=True)
    assert sorted(r.transaction_description for r in res.frame.collect()) == [
        "Coffee Shop", "Løn januar", "Netto 123", "new row"]


def test_failing_checks_stop_the_pipeline(spark, tmp_path):
    d = tmp_path / "exports"
    d.mkdir()
    write_csv(d / "Konto 0718 - 2024-02-01 08.00.00.csv", HEADER, [
        ["2024/01/10", "-45,50", "", "", "", "no parties", "", "DKK", ""]])
    with pytest.raises(quality.ChecksFailed, match="account_key"):
        pipeline.run_pipeline(spark, str(tmp_path / "out"), csv_dir=str(d))


def test_export_single_file(spark, tmp_path):
    m = Model(spark, SF0001)
    n = pipeline.export_csv(m.fact.limit(5), str(tmp_path / "one"), single_file=True)
    assert n == 5
    assert len([f for f in os.listdir(tmp_path / "one") if f.endswith(".csv")]) == 1


def test_rule_seed_csv_and_keep_frame(spark, tmp_path):
    from spendlake.sources.rules import read_rules_csv
    seed = tmp_path / "rules.csv"
    seed.write_text("pattern_type,pattern_value,category_key,priority\ndescription,netto,CAT001,100\n"
                    "description,\"el og vand\",CAT005,100\n", encoding="utf-8")
    rules = read_rules_csv(spark, str(seed))
    assert [tuple(r) for r in rules.collect()] == [("description", "netto", "CAT001", 100),
                                                   ("description", "el og vand", "CAT005", 100)]
    res = pipeline.run_pipeline(spark, str(tmp_path / "out"), csv_dir=str(csv_dir(tmp_path)), rules=rules,
                                keep_frame=True)
    assert res.frame.is_cached
    assert {r.category_key for r in res.frame.collect()} == {"CAT001", "CAT999"}


def test_append_audit_counts_what_was_written(spark, tmp_path):
    out, d = str(tmp_path / "out"), csv_dir(tmp_path)
    (d / "empty.csv").write_text("")
    first = pipeline.run_pipeline(spark, out, csv_dir=str(d), append=True)
    assert first.raw.count() == 3
    audit = {r.source_file: r for r in spark.read.parquet(f"{out}/load_audit").collect()}
    assert (audit[None].inserted, audit[None].skipped, audit["empty.csv"].parsed) == (3, 2, 0)
    again = pipeline.run_pipeline(spark, out, csv_dir=str(d), append=True)
    assert again.raw.count() == 3
    audit = {r.source_file: r for r in spark.read.parquet(f"{out}/load_audit").collect()}
    assert (audit[None].inserted, audit[None].skipped, audit[None].parsed) == (0, 5, 5)
    assert not [f for f in os.listdir(out) if "landing" in f]


def test_date_filters_prune_the_stored_fact(spark, tmp_path):
    from spendlake.operators import filters, reports
    d = tmp_path / "exports"
    d.mkdir()
    write_csv(d / "Konto 0718 - 2024-12-31 08.00.00.csv", HEADER, [
        [f"2024/{m:02d}/10", "-1,00", "0718", "", "", f"m{m}", "", "DKK", ""] for m in range(1, 13)])
    out = str(tmp_path / "out")
    pipeline.run_pipeline(spark, out, csv_dir=str(d))
    frame = pipeline.run_pipeline(spark, out, skip_load=True, skip_models=True).frame
    for view, n in ((filters.date_range(frame, "2024-05-01", "2024-06-30"), 2), (filters.date_range(frame), 3)):
        report = reports.expenses_by_category(view)
        assert view.count() == n
        report.collect()
        plan = report._jdf.queryExecution().executedPlan().toString()
        pruned = [x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:]]
        assert any("month_start" in x for x in pruned)
    raw = spark.read.parquet(f"{out}/raw_transactions")
    assert sorted(r.month_start.month for r in raw.select("month_start").distinct().collect()) == list(range(1, 13))


STOCK_SESSION = """
import sys
from pyspark.sql import SparkSession
from spendlake.plans import pipeline
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert not spark.conf.get("spark.checkpoint.dir", None)
print("rows", pipeline.run_pipeline(spark, sys.argv[2], csv_dir=sys.argv[1]).frame.count())
"""


def test_pipeline_on_a_session_without_settings(tmp_path):
    conf = tmp_path / "conf"
    conf.mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(conf), "PYTHONPATH": os.path.dirname(os.path.dirname(__file__))}
    done = subprocess.run([sys.executable, "-c", STOCK_SESSION, str(csv_dir(tmp_path)), str(tmp_path / "out")],
                          env=env, capture_output=True, text=True, timeout=300)
    assert "rows 3" in done.stdout, done.stderr[-2000:]

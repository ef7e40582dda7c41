"""The stored ledger: atomic runs, audit history, bucketed keys, summary, windows, pages and search."""

import datetime as dt
import os
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import HEADER, SF0001, write_csv
from spendlake.operators import filters, reports
from spendlake.plans import catalogue
from spendlake.plans.catalogue import FIRST_RUN_STAMP
from spendlake.plans.ledger import Ledger
from spendlake.plans.model import Model
from spendlake.plans.star import REPORT_COLUMNS
from spendlake.schemas import SUMMARY
from spendlake.sources import trigrams
from spendlake.sources.parts import BUCKET_ROWS, new_part, without_run
from spendlake.sources.rules import FIXTURE_RULES, rules_frame
from spendlake.streaming import start_ledger_load


def rows_of(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(
        "formatted"))


CALENDAR = ("2023-01-01", "2023-12-31")


def exports(spark):
    """The rows of four months (few months make few files), and the pending ones; January is off the calendar."""
    return Model(spark, SF0001).export_rows.filter(
        "posting_date_text IS NULL OR posting_date_text BETWEEN '2023/10/01' AND '2024/01/31'")


def model(spark):
    return Model(spark, source=exports(spark), calendar=CALENDAR)


def older(spark):
    return exports(spark).filter(F.col("source_file").contains(FIRST_RUN_STAMP))


def a_ledger(spark, path, buckets=1, calendar=CALENDAR):
    return Ledger(spark, str(path), buckets=buckets, calendar=calendar, rules=rules_frame(spark, FIXTURE_RULES))


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    ledger = a_ledger(spark, tmp_path_factory.mktemp("whole"))
    ledger.refresh(exports(spark), "run 1")
    return ledger


@pytest.fixture(scope="module")
def appended(spark, tmp_path_factory):
    ledger = a_ledger(spark, tmp_path_factory.mktemp("appended"), buckets=2)
    ledger.refresh(older(spark), "run 1")
    ledger.append(exports(spark), "run 2")
    return ledger


def test_part_names_know_their_run():
    a, b, c = new_part("run 1"), new_part("run 1"), new_part("run-1")
    assert a != b and without_run([a, b, c], "run 1") == [c]


def test_buckets_of_the_queries_follow_the_rows(spark, tmp_path, monkeypatch):
    """A bucket is one task's work: two of them for any input made every task grow with it."""
    class Seen:
        def __init__(self, *_, buckets, **__):
            self.buckets = buckets

        def refresh(self, *_):
            pass
    monkeypatch.setattr(catalogue, "Ledger", Seen)
    spark.range(1).selectExpr("id AS p_partkey", "'bolt' AS p_name").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(1).selectExpr("id AS c_custkey", "'x' AS c_name", "1D AS c_acctbal").write.parquet(
        f"{tmp_path}/customer.parquet")
    for n, buckets in ((10, 2), (2 * BUCKET_ROWS + 1, 3)):
        spark.range(n).selectExpr("id AS event_id", "timestamp_seconds(id) AS ts", "id AS user_id", "'view' AS event_type",
                                  "1D AS value").write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
        catalogue._LEDGERS.pop((spark.sparkContext.applicationId, str(tmp_path), False), None)
        assert catalogue._ledger(spark, str(tmp_path)).buckets == buckets
    catalogue._LEDGERS.pop((spark.sparkContext.applicationId, str(tmp_path), False))


def test_the_summary_is_written_by_as_many_tasks_as_its_size_needs(spark, tmp_path):
    days = spark.range(40_000).selectExpr("date_add(DATE'2024-01-01', int(id % 90)) AS date_key",
                                          "md5(string(id)) AS account_key")
    other = {f.name: F.lit(1 if f.name == "transactions" else None).cast(f.dataType) for f in SUMMARY.fields}
    rows = days.withColumns({c: v for c, v in other.items() if c not in days.columns})
    rows = rows.withColumn("month_start", F.trunc("date_key", "month"))
    ledger = a_ledger(spark, tmp_path, buckets=2)
    table = ledger.summary_table
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k"}
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        assert table.write(rows, "a-1").count() == 40_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    tasks = {f.rsplit("/part-", 1)[1][:5] for f in spark.read.parquet(table.path).inputFiles()}
    assert len(tasks) > 3  # a task for each 100 KB, not one for all
    assert rows_of(table.read(["a-1"])) == rows_of(rows.select(SUMMARY.fieldNames()))


def test_refresh_equals_the_lazy_model(spark, whole):
    m = model(spark)
    assert rows_of(whole.raw().select(m.raw.columns)) == rows_of(m.raw)
    assert rows_of(whole.frame().select(*REPORT_COLUMNS)) == rows_of(m.frame)


def test_a_failed_run_leaves_what_was_there(spark, whole, tmp_path):
    ledger = a_ledger(spark, tmp_path / "ledger")
    ledger.refresh(older(spark), "good")
    before = rows_of(ledger.fact())
    bad = exports(spark).withColumn("posting_date_text", F.lit("not a date"))
    for run in (ledger.refresh, ledger.append):
        with pytest.raises(PySparkException, match="not a date"):
            run(bad, "bad")
    assert rows_of(a_ledger(spark, tmp_path / "ledger").fact()) == before
    assert not os.listdir(tmp_path / "ledger" / "_landing")


def test_a_run_that_fails_half_way_is_not_seen(spark, tmp_path, monkeypatch):
    """The raw table and the fact are written, the index is not: readers still see the run before."""
    ledger = a_ledger(spark, tmp_path)
    ledger.refresh(older(spark), "good")
    before = [rows_of(t()) for t in (ledger.raw, ledger.fact, ledger.summary, ledger.audit)]

    def broken(*_):
        raise RuntimeError("disk full")
    monkeypatch.setattr(trigrams, "write", broken)
    with pytest.raises(RuntimeError, match="disk full"):
        ledger.append(exports(spark), "half")
    assert [rows_of(t()) for t in (ledger.raw, ledger.fact, ledger.summary, ledger.audit)] == before
    assert ledger.clean() == 3  # raw, fact and summary of the failed run
    assert [rows_of(t()) for t in (ledger.raw, ledger.fact, ledger.summary, ledger.audit)] == before


def test_two_loads_are_two_runs_and_a_repeated_one_is_one(spark, tmp_path):
    ledger = a_ledger(spark, tmp_path)
    ledger.refresh(older(spark), "a")
    ledger.append(exports(spark), "b")
    once = [rows_of(t()) for t in (ledger.raw, ledger.fact, ledger.summary)]
    audit = rows_of(ledger.audit().drop("loaded_at"))
    assert {r["run_id"] for r in ledger.audit().collect()} == {"a", "b"}
    inserted = {r["run_id"]: r["inserted"] for r in ledger.audit().filter("source_file IS NULL").collect()}
    assert sum(inserted.values()) == ledger.raw().count() and all(inserted.values())
    ledger.append(exports(spark), "b")
    stamp = re.compile(r"loaded_at=datetime[^)]*\)")
    assert [[stamp.sub("", r) for r in rows_of(t())] for t in (ledger.raw, ledger.fact, ledger.summary)] == \
        [[stamp.sub("", r) for r in rows] for rows in once]
    assert rows_of(ledger.audit().drop("loaded_at")) == audit
    ledger.append(exports(spark), "c")  # nothing new
    assert ledger.audit().filter("run_id = 'c' AND source_file IS NULL").first()["inserted"] == 0
    assert ledger.raw().count() == sum(inserted.values())
    ledger.refresh(older(spark), "d")  # the history outlives a refresh
    assert {r["run_id"] for r in ledger.audit().collect()} == {"a", "b", "c", "d"}


def test_the_stored_side_is_not_shuffled(spark, appended, tmp_path):
    landing = str(tmp_path / "landing")
    from spendlake.operators import ingest
    new = ingest.load(ingest.with_position(exports(spark)), landing_path=landing, position=True)
    tree = plan(appended.unseen(new, appended._live("raw"), landing)).split("\n\n")[0].splitlines()
    at = next(i for i, line in enumerate(tree) if "SortMergeJoin LeftOuter" in line)
    child = tree[at + 1].index(":- ")
    stored = "\n".join(tree[next(i for i in range(at + 1, len(tree)) if tree[i][child:child + 3] == "+- "):])
    assert "Scan parquet spark_catalog" in stored and "Exchange" not in stored
    assert "Exchange" not in plan(appended.repeated_keys()) and appended.repeated_keys().count() == 0


def test_summary_answers_the_reports_without_the_fact(spark, appended):
    for name in ("key_metrics", "expenses_by_category", "daily_cash_flow", "monthly_summary", "category_by_day",
                 "top_categories", "top_category_by_day", "uncategorised_share", "income_vs_expenses"):
        report = getattr(reports, name)
        from_summary = report(appended.dashboard(appended.totals()))
        assert rows_of(from_summary) == rows_of(report(filters.dashboard(appended.frame()))), name
        assert "/fact/" not in plan(from_summary)
    for name in ("data_summary", "category_matrix", "amount_by_date"):
        report = getattr(reports, name)
        assert rows_of(report(appended.totals())) == rows_of(report(appended.frame())), name
    keys = appended.summary().groupBy("date_key", "account_key", "category_key", "categorization_status",
                                      "transaction_type").count()
    assert keys.filter("count > 1").count() == 0


def test_slicers_prune_months_when_the_query_runs(spark, whole):
    sliced = filters.slicers(whole.frame(), year=2023, quarter=4, month=11)
    assert re.search(r"PartitionFilters: .*dynamicpruningexpression\(month_start", plan(sliced).replace("\n", " "))
    sliced.collect()
    read = {r["f"] for r in sliced.select(F.col("month_start").alias("f")).distinct().collect()}
    assert read == {dt.date(2023, 11, 1)}
    assert rows_of(sliced.select(*REPORT_COLUMNS)) == rows_of(
        filters.slicers(model(spark).frame, year=2023, quarter=4, month=11))


def test_default_window_reads_its_months_only(spark, whole):
    window = whole.last_days()
    assert rows_of(window.select(*REPORT_COLUMNS)) == rows_of(filters.date_range(model(spark).frame))
    scans = [s for s in plan(window).split("\n\n") if "Scan parquet" in s and "PartitionFilters" in s]
    assert scans and all(re.search(r"month_start#\d+ >= ", s) and re.search(r"month_start#\d+ <= ", s) for s in scans)


def test_latest_day_of_a_calendar_that_ends_between_rows(spark, tmp_path):
    """The last month has rows, but only behind the calendar's end."""
    days = ["2024/01/05", "2024/02/20", "2024/04/02"]
    write_csv(tmp_path / "Konto 07 - 2024-05-01 08.00.00.csv", HEADER,
              [[d, "-1,00", "07", "", "", d, "", "DKK", ""] for d in days])
    from spendlake.sources.exports import read_exports
    a_ledger(spark, tmp_path / "ledger").refresh(read_exports(spark, str(tmp_path)))
    for end, latest in (("2024-02-10", dt.date(2024, 1, 5)), ("2024-04-01", dt.date(2024, 2, 20)),
                        ("2030-12-31", dt.date(2024, 4, 2)), ("2023-12-31", None)):
        ledger = a_ledger(spark, tmp_path / "ledger", calendar=("2020-01-01", end))
        assert ledger.latest_day() == latest
        assert ledger.last_days().count() == filters.date_range(ledger.frame()).count()


@pytest.mark.parametrize("size", [9, 40])
def test_pages_joined_are_the_whole_list(spark, whole, size):
    frame = whole.frame()
    whole_list = [r["transaction_key"] for r in frame.orderBy(F.desc_nulls_last("date_day"), "transaction_key").collect()]
    assert frame.filter("date_day IS NULL").count() > 0  # rows off the calendar come last
    after, keys = None, []
    while True:
        page = whole.page(size, after)
        rows = page.collect()
        keys += [r["transaction_key"] for r in rows]
        if len(rows) < size:
            break
        after = (rows[-1]["date_day"], rows[-1]["transaction_key"])
    assert keys == whole_list
    text = plan(whole.page(size))
    assert "TakeOrderedAndProject" in text and re.search(r"PartitionFilters: .*month_start", text)


def test_search_reads_files_that_hold_the_trigrams(spark, whole):
    every = spark.read.parquet(whole.fact_table.path).inputFiles()
    for term in ("ring|bolt", "cust.mer#0*12", "olive|x+yz", "nothing like it", "", "[r]ing"):
        found = whole.search(term)
        assert rows_of(found.select(*REPORT_COLUMNS)) == rows_of(
            reports.transaction_search(whole.frame(), term).select(*REPORT_COLUMNS)), term
    rare = whole.fact().filter("month_start = '2023-11-01'").first()["counterparty_name"] or "Customer#0"
    some = whole.search("zzz|" + rare)
    assert 0 < len(some.inputFiles()) < len(every)
    assert len(whole.search("(ring)").inputFiles()) == len(every)


def test_required_trigrams():
    assert trigrams.required("Ring|Bolts") == [{"rin", "ing"}, {"bol", "olt", "lts"}]
    assert trigrams.required("abcd?efg") == [{"abc", "efg"}]
    assert trigrams.required("abc+def") == [{"abc", "def"}]
    assert trigrams.required("ab.cdæfgh") == [{"fgh"}]
    for term in (None, "", "ab", "abc|de", "a{3}bcd", "(abc)", "[abc]def", "\\babc", "abc|"):
        assert trigrams.required(term) is None, term


def test_trigrams_of_a_file_are_cut_in_batches(spark, tmp_path):
    """Each (file, trigram) once, against brute force; nothing is exploded row by row."""
    texts = ["ring", "RING bolt", "a", "", None, "Kelvin Kk", "ab\0cd", "x\ny z", "日本abc語", "straße ~~~", "\x7fabc"]
    rows = [(a, b) for a in texts for b in texts]
    want = set()
    for k in range(2):
        spark.createDataFrame(rows[k::2], "transaction_description string, counterparty_name string").coalesce(
            1).write.parquet(f"{tmp_path}/data/k={k}")
        for text in (t for row in rows[k::2] for t in row if t):
            t = text.replace("K", "k").lower()
            want |= {(k, t[i:i + 3]) for i in range(len(t) - 2) if all(" " <= c <= "~" for c in t[i:i + 3])}
    trigrams.write(spark, f"{tmp_path}/data", f"{tmp_path}/index")
    found = [(int("/k=1/" in r["file"]), r["trigram"]) for r in spark.read.parquet(f"{tmp_path}/index").collect()]
    assert len(found) == len(set(found)) and set(found) == want
    batches = trigrams._of_batches(iter(
        spark.createDataFrame([("f", b"ring\0ring\0")], "file string, text binary").toArrow().to_batches()))
    assert [b.to_pylist() for b in batches] == [[{"file": "f", "trigram": t} for t in ("ing", "rin")]]


def test_search_folds_like_the_matcher(spark, tmp_path):
    texts = ["ſkin", "SKIN", "Kiss", "kıss", "STRASSE", "straße", "istanbul", "İSTANBUL", "οδος", None]
    write_csv(tmp_path / "Konto 07 - 2024-05-01 08.00.00.csv", HEADER,
              [["2024/01/05", f"-{k + 1},00", "07", "", "", t or "", "", "DKK", ""] for k, t in enumerate(texts)])
    from spendlake.sources.exports import read_exports
    ledger = a_ledger(spark, tmp_path / "ledger")
    ledger.refresh(read_exports(spark, str(tmp_path)))
    for term in ("skin", "SKIN", "kiss", "straße", "İstanbul", "istanbul", "ΟΔΟΣ", "i", "lstan"):
        assert rows_of(ledger.search(term).select("transaction_key")) == rows_of(
            reports.transaction_search(ledger.frame(), term).select("transaction_key")), term


def test_an_empty_ledger(spark, tmp_path):
    ledger = a_ledger(spark, tmp_path)
    for _ in range(2):
        assert ledger.raw().count() == ledger.fact().count() == ledger.totals().count() == 0
        assert ledger.latest_day() is None and ledger.last_days().count() == 0
        assert ledger.page(10).count() == 0 and ledger.search("ring").count() == 0
        ledger.refresh(exports(spark).limit(0))


def test_streamed_batches_are_runs(spark, tmp_path):
    folder, ledger = tmp_path / "exports", a_ledger(spark, tmp_path / "ledger")
    folder.mkdir()
    for n, day in enumerate(("2024/01/10", "2024/02/10")):
        write_csv(folder / f"Konto 0718 - 2024-0{n + 2}-01 08.00.00.csv", HEADER,
                  [[day, f"-{n + 1},00", "0718", "", "", f"text {n}", "", "DKK", ""]])
        start_ledger_load(ledger, str(folder), str(tmp_path / "ckpt"), "bank").awaitTermination()
    assert ledger.fact().count() == 2
    total = ledger.audit().filter("source_file IS NULL").orderBy("run_id").collect()
    assert [(r["run_id"], r["inserted"]) for r in total] == [("bank 0", 1), ("bank 1", 1)]
    assert reports.key_metrics(ledger.totals()).first()["transaction_count"] == 2

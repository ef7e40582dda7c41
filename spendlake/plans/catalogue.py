"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query runs the full load path over whole driver tables through the
events adapter (``sources.adapters``) with the fixture rules, unless noted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake import fixed_values as FV
from spendlake.functions.text import parse_locale_decimal
from spendlake.operators import filters, ingest, marts, quality, reports
from spendlake.operators.categorise import best_matches, rule_matches
from spendlake.plans.ledger import Ledger
from spendlake.plans.model import Model
from spendlake.plans.pipeline import MART_NAMES, build_marts, export_marts, run_pipeline
from spendlake.plans.star import REPORT_COLUMNS, report_frame
from spendlake.session import checkpoint_dir
from spendlake.sources.adapters import write_export_files
from spendlake.sources.exports import bind, positions, read_exports, split_rejects
from spendlake.sources.parts import buckets_for
from spendlake.sources.rules import FIXTURE_RULES, MANY_RULES, ODD_RULES, rules_frame
from spendlake.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CATEGORISED_COLUMNS = ["transaction_hash", "transaction_description", "counterparty_name",
                       "transaction_type", "category_key", "categorization_status"]
STAGED_COLUMNS = ["transaction_hash", "posting_date", "amount", "balance", "currency", "sender_account",
                  "recipient_account", "counterparty_name", "transaction_description", "is_reconciled",
                  "transaction_type", "absolute_amount", "source_file"]
FIRST_RUN_STAMP = "2024-01-16"
SEARCH_TERM = "ring|bolt"
FIRST_RUN, SECOND_RUN = "first run", "second run"
SLICED_ACCOUNT = "0700000003"
PAGE_ROWS = 100
WIDE_CALENDAR = ("2018-01-01", FV.CALENDAR_END)
_FIELD_TO_HEADER = {f: h for h, f in FV.HEADER_TO_FIELD.items()}
LAYOUTS = [
    [_FIELD_TO_HEADER[f] for f in ("posting_date", "amount", "sender", "recipient", "name", "description", "balance",
                                   "currency", "reconciled")],
    [_FIELD_TO_HEADER[f] for f in ("description", "amount", "currency", "posting_date")] + ["Note"]
    + [_FIELD_TO_HEADER[f] for f in ("reconciled", "balance", "name", "recipient", "sender")],
    [_FIELD_TO_HEADER[f] for f in ("posting_date", "amount", "sender", "recipient", "name", "description", "balance",
                                   "reconciled")],
]
FILTER_CATEGORIES = ["Groceries", "Rent"]


_LEDGERS: dict[tuple, Ledger] = {}


def _ledger(spark, d, appended=False) -> Ledger:
    """A stored ledger of the events' exports in the session's shared folder, written once a
    session and kept for all queries that read it.  ``appended``: the older exports first, then
    all of them appended, else one full load."""
    key = (spark.sparkContext.applicationId, d.rstrip("/"), appended)
    if key not in _LEDGERS:
        rows = Model(spark, d).export_rows
        made = Ledger(spark, f"{checkpoint_dir(spark).rstrip('/')}/spendlake-ledger-{uuid.uuid4().hex}",
                      buckets=buckets_for(table(spark, d, "events").count()), rules=rules_frame(spark, FIXTURE_RULES))
        if appended:
            made.refresh(rows.filter(F.col("source_file").contains(FIRST_RUN_STAMP)), FIRST_RUN)
            made.append(rows, SECOND_RUN)
        else:
            made.refresh(rows, FIRST_RUN)
        _LEDGERS[key] = made
    return _LEDGERS[key]


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- load semantics --------------------------------------------------------

@register("ingest_newest_file_wins")
def _q(spark, d):
    return Model(spark, d).kept.select(*ingest.RAW_COLUMNS, "row_in_file")


@register("ingest_dedupe_by_hash")
def _q(spark, d):
    return Model(spark, d).raw


@register("ingest_audit_by_file")
def _q(spark, d):
    return ingest.load_audit(Model(spark, d).export_rows)


@register("ingest_append_new_only")
def _q(spark, d):
    """A first run loaded only the older exports; a second full run appends
    the keys the table does not hold yet."""
    m = Model(spark, d)
    first = Model(spark, source=m.export_rows.filter(F.col("source_file").contains(FIRST_RUN_STAMP)))
    return ingest.append_new_only(m.raw, first.raw)


@register("ingest_audit_append")
def _q(spark, d):
    """The audit of that second run: keys stored by the first are not inserted again."""
    m = Model(spark, d)
    first = Model(spark, source=m.export_rows.filter(F.col("source_file").contains(FIRST_RUN_STAMP)))
    return ingest.load_audit(m.export_rows, inserted=ingest.append_new_only(m.raw, first.raw))


def _exported_cells(spark, d, rows=None):
    """Positional cells as exports hold them, one layout for each third of the
    accounts: usual order; other order with a further column; no currency."""
    rows = Model(spark, d).export_rows if rows is None else rows
    no = F.col("row_in_file")
    texts = {
        "posting_date": F.coalesce("posting_date_text", F.when(no % 4 == 0, F.lit(FV.PENDING_MARKER)).otherwise(F.lit(""))),
        "amount": F.when(no % 97 == 5, F.lit("")).otherwise(_locale_text(F.col("amount"))),
        "currency": F.when(no % 89 == 7, F.lit("")).otherwise(F.col("currency")),
        "balance": F.when(no % 11 == 0, F.lit("")).otherwise(_locale_text(F.col("balance"))),
        **{f: F.coalesce(f, F.lit("")) for f in ("sender", "recipient", "name", "description", "reconciled")},
    }
    third = F.substring("source_file", 7, 10).cast("long") % 3  # of the account number
    for k, header in enumerate(LAYOUTS):
        field_at = {i: f for f, i in positions(header).items()}
        cells = [texts[field_at[i]] if i in field_at else F.lit("x") for i in range(len(header))]
        yield header, (rows.filter(third == k).select(
            *[F.nullif(c, F.lit("")).alias(f"_c{i}") for i, c in enumerate(cells)], "source_file", "row_in_file"))


def _bound(spark, d):
    return reduce(DataFrame.unionByName, [bind(cells, header) for header, cells in _exported_cells(spark, d)])


@register("ingest_bind_headers")
def _q(spark, d):
    return split_rejects(_bound(spark, d))[0]


@register("ingest_rejects")
def _q(spark, d):
    return split_rejects(_bound(spark, d))[1]


def _csv_folder(spark, d):
    """The events' exports as real CSV files of three layouts; descriptions hold line breaks and quotes."""
    rows = Model(spark, d).export_rows
    no, text = F.col("row_in_file"), F.col("description")
    text = F.when(no % 7 == 0, F.regexp_replace(text, " ", "\n")).otherwise(text)
    text = F.when(no % 10 == 0, F.concat(text, F.lit(' "x;y"'))).otherwise(text)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/spendlake-exports-{uuid.uuid4().hex}"
    for header, cells in _exported_cells(spark, d, rows.withColumn("description", text)):
        write_export_files(cells, header, folder)
    return folder


def _csv_rows(**how):
    def q(spark, d):
        return read_exports(spark, _csv_folder(spark, d), on_error="reject", **how)[0].drop("row_in_file")
    return q


register("ingest_csv_files")(_csv_rows())
register("ingest_csv_ranges")(_csv_rows(range_bytes=1000))


@register("ingest_csv_rejects")
def _q(spark, d):
    return read_exports(spark, _csv_folder(spark, d), on_error="reject")[1].drop("row_in_file")


def _locale_text(c):
    return F.translate(F.format_number(c, 2), ",.", ".,")


@register("ingest_parse_decimal")
def _q(spark, d):
    rows = Model(spark, d).export_rows
    text = _locale_text(F.col("amount"))
    btext = _locale_text(F.col("balance"))
    return rows.select("row_in_file", text.alias("amount_text"), parse_locale_decimal(text).alias("parsed_amount"),
                       btext.alias("balance_text"), parse_locale_decimal(btext).alias("parsed_balance"))


@register("ingest_parse_date")
def _q(spark, d):
    rows = Model(spark, d).export_rows
    return rows.select("row_in_file", "posting_date_text",
                       ingest.parse_posting_date(F.col("posting_date_text"), F.col("source_file")).alias("posting_date"))


@register("ingest_account_from_file")
def _q(spark, d):
    typed = Model(spark, d).typed
    return typed.groupBy("source_file", "account").agg(F.count(F.lit(1)).alias("rows"))


# --- staging and categorisation -------------------------------------------

@register("stage_transactions")
def _q(spark, d):
    return Model(spark, d).staged.select(*STAGED_COLUMNS)


def _match(pattern_type):
    def q(spark, d):
        m = Model(spark, d)
        return best_matches(rule_matches(m.staged, m.rules, pattern_type))
    return q


register("match_description")(_match("description"))
register("match_name")(_match("name"))
register("match_type")(_match("transaction_type"))


@register("categorise_transactions")
def _q(spark, d):
    return Model(spark, d).categorised.select(*CATEGORISED_COLUMNS)


@register("categorise_join_form")
def _q(spark, d):
    return Model(spark, d, method="join").categorised.select(*CATEGORISED_COLUMNS)


@register("categorise_automaton_form")
def _q(spark, d):
    return Model(spark, d, method="automaton").categorised.select(*CATEGORISED_COLUMNS)


@register("categorise_odd_rules")
def _q(spark, d):
    """Wildcards, NULL keys and NULL priorities."""
    return Model(spark, d, rules=ODD_RULES).categorised.select(*CATEGORISED_COLUMNS)


@register("categorise_many_rules")
def _q(spark, d):
    """More rules than one CASE chain takes."""
    return Model(spark, d, rules=MANY_RULES).categorised.select(*CATEGORISED_COLUMNS)


@register("categorise_array_form")
def _q(spark, d):
    return Model(spark, d, method="array").categorised.select(*CATEGORISED_COLUMNS)


@register("categorise_seed_rules")
def _q(spark, d):
    return Model(spark, d, rules=FV.DEFAULT_RULES).categorised.select(*CATEGORISED_COLUMNS)


@register("category_counts")
def _q(spark, d):
    return (Model(spark, d).categorised.groupBy("category_key", "categorization_status")
            .agg(F.count(F.lit(1)).alias("transactions"), F.sum("amount").cast("decimal(18,2)").alias("amount")))


# --- marts ------------------------------------------------------------------

@register("fct_transactions")
def _q(spark, d):
    return Model(spark, d).fact


@register("dim_account")
def _q(spark, d):
    return Model(spark, d).dim_account


@register("dim_date")
def _q(spark, d):
    """Calendar over the whole years the staged transactions span."""
    return marts.dim_date_for(Model(spark, d).staged)


@register("report_frame")
def _q(spark, d):
    return Model(spark, d).frame


@register("report_frame_joined")
def _q(spark, d):
    """The account dimension joined; no account is hot."""
    m = Model(spark, d)
    return report_frame(m.fact, m.dim_date, m.dim_category, m.dim_account)


@register("report_frame_large_dim")
def _q(spark, d):
    """The same with every account that has more than a thousandth of the rows joined
    map-side: fewer than a thousand accounts, however many rows there are."""
    m = Model(spark, d)
    hot = m.fact.count() // 1000
    return report_frame(m.fact, m.dim_date, m.dim_category, m.dim_account, hot_account_rows=hot)


# --- reports ------------------------------------------------------------------

def _on_filtered(fn):
    return lambda spark, d: fn(Model(spark, d).filtered)


def _on_frame(fn):
    return lambda spark, d: fn(Model(spark, d).frame)


def _on_fact(fn):
    return lambda spark, d: fn(Model(spark, d).fact)


register("data_summary")(_on_frame(reports.data_summary))
for _name in ["key_metrics", "key_metrics_text", "income_vs_expenses", "expenses_by_category",
              "expenses_by_group", "expenses_by_type", "daily_cash_flow", "monthly_summary",
              "monthly_summary_wide", "category_by_day", "top_categories", "top_category_by_day",
              "uncategorised_share", "category_list"]:
    register(_name)(_on_filtered(getattr(reports, _name)))
register("transaction_list")(_on_filtered(lambda f: reports.transaction_list(f)))
register("transaction_search")(_on_filtered(lambda f: reports.transaction_search(f, SEARCH_TERM)))


@register("transaction_search_indexed")
def _q(spark, d):
    """All stored transactions that match, from the files whose trigrams allow it."""
    return _ledger(spark, d).search(SEARCH_TERM).select(*REPORT_COLUMNS)


@register("transaction_page")
def _q(spark, d):
    """The second page of the stored list, from the last row of the first."""
    ledger = _ledger(spark, d)
    last = ledger.page(PAGE_ROWS).collect()[-1:]
    return ledger.page(PAGE_ROWS, after=(last[0]["date_day"], last[0]["transaction_key"]) if last else None)


register("categories_in_use")(lambda spark, d: reports.categories_in_use(Model(spark, d).dim_category,
                                                                       Model(spark, d).fact))
register("measure_total_amount")(_on_fact(reports.total_amount))
register("measure_average")(_on_fact(reports.average_transaction))
register("measures")(_on_fact(reports.measures))
register("daily_balance")(lambda spark, d: reports.daily_balance(Model(spark, d, with_position=True).fact))
register("category_matrix")(_on_frame(reports.category_matrix))
register("spending_without_transfers")(_on_frame(reports.spending_without_transfers))
register("amount_by_date")(_on_frame(reports.amount_by_date))
register("amount_by_category")(_on_frame(reports.amount_by_category))

# --- filters ------------------------------------------------------------------

register("filter_last_90_days")(lambda spark, d: _ledger(spark, d).last_days().select(*REPORT_COLUMNS))
register("filter_last_90_days_lazy")(_on_frame(lambda f: filters.date_range(f).select(*REPORT_COLUMNS)))
register("filter_category")(_on_frame(lambda f: filters.categories(f, FILTER_CATEGORIES)))
register("filter_type")(_on_frame(lambda f: filters.transaction_types(f, ["debit"])))


def _sliced(**values):
    """Calendar and account slicers over the stored fact: months are pruned when the query runs."""
    return lambda spark, d: filters.slicers(_ledger(spark, d).frame(), **values).select(*REPORT_COLUMNS)


register("filter_period")(_sliced(year=2024, quarter=1, month=1))
register("filter_quarter")(_sliced(year=2023, quarter=2))
register("filter_account")(_sliced(year=2023, account=SLICED_ACCOUNT))

# --- stored ledger --------------------------------------------------------------


@register("ledger_raw_after_append")
def _q(spark, d):
    return _ledger(spark, d, appended=True).raw().select(*ingest.RAW_COLUMNS)


@register("ledger_audit_history")
def _q(spark, d):
    return _ledger(spark, d, appended=True).audit().drop("loaded_at")


@register("ledger_repeated_keys")
def _q(spark, d):
    """Rows and keys of the stored fact, and the keys it holds twice, counted bucket by bucket."""
    ledger = _ledger(spark, d, appended=True)
    repeated = ledger.repeated_keys().agg(F.count(F.lit(1)).alias("repeated"))
    return ledger.fact().agg(F.count(F.lit(1)).alias("transactions")).withColumn("repeated", repeated.scalar())


def _on_summary(fn, filtered=True):
    """A report over the daily summary of the appended ledger."""
    def q(spark, d):
        ledger = _ledger(spark, d, appended=True)
        totals = ledger.totals()
        return fn(ledger.dashboard(totals) if filtered else totals)
    return q


SUMMARY_FILTERED = ["key_metrics", "income_vs_expenses", "expenses_by_category", "expenses_by_group",
                    "expenses_by_type", "daily_cash_flow", "monthly_summary", "category_by_day", "top_categories",
                    "top_category_by_day", "uncategorised_share"]
SUMMARY_WHOLE = ["data_summary", "category_matrix", "spending_without_transfers", "amount_by_date",
                 "amount_by_category"]
for _name in SUMMARY_FILTERED:
    register(f"summary_{_name}")(_on_summary(getattr(reports, _name)))
for _name in SUMMARY_WHOLE:
    register(f"summary_{_name}")(_on_summary(getattr(reports, _name), filtered=False))

# --- whole runs -------------------------------------------------------------------


def _run_folder(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/spendlake-run-{uuid.uuid4().hex}"


def _with_account(spark, d):
    """Export rows that pass the checks: every row names an account."""
    return Model(spark, d).export_rows.filter("sender IS NOT NULL OR recipient IS NOT NULL")


def _whole_run(spark, d, folder, **how):
    return run_pipeline(spark, folder, rules=rules_frame(spark, FIXTURE_RULES), calendar=WIDE_CALENDAR, **how)


@register("pipeline_checks")
def _q(spark, d):
    """Load, models and checks of a whole run; a failing check would end it."""
    return _whole_run(spark, d, _run_folder(spark), export_rows=_with_account(spark, d)).checks


@register("pipeline_stored_marts")
def _q(spark, d):
    """A whole run, then one that skips load and models and reports from the stored marts."""
    folder = _run_folder(spark)
    _whole_run(spark, d, folder, export_rows=_with_account(spark, d))
    return reports.key_metrics(_whole_run(spark, d, folder, skip_load=True, skip_models=True).frame)


@register("export_marts_round_trip")
def _q(spark, d):
    """Rows of each mart exported as CSV (counted while written) and read back."""
    folder = _run_folder(spark)
    m = Model(spark, d)
    build_marts(spark, m.raw, f"{folder}/marts", m.rules, run_checks=False)
    counts = export_marts(spark, f"{folder}/marts", f"{folder}/export")
    back = [spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(f"{folder}/export/{n}")
            .agg(F.lit(n).alias("mart"), F.lit(counts[n]).cast("long").alias("exported"),
                 F.count(F.lit(1)).alias("read_back")) for n in MART_NAMES]
    every = reduce(DataFrame.unionByName, back)
    return every.unionByName(every.agg(F.lit("total").alias("mart"), F.sum("exported").alias("exported"),
                                       F.sum("read_back").alias("read_back")))

# --- data-quality checks ------------------------------------------------------


def _checks(spark, d):
    m = Model(spark, d)
    return quality.run_checks(spark, quality.standard_checks(m.staged, m.fact, m.dim_date, m.dim_account))


def _checks_of(kind):
    return lambda spark, d: _checks(spark, d).filter(F.col("check_name") == kind)


register("check_unique")(_checks_of("unique"))
register("check_not_null")(_checks_of("not_null"))
register("check_accepted_values")(_checks_of("accepted_values"))
register("check_relationships")(_checks_of("relationships"))
register("check_all")(_checks)

"""Oracle SQL (DuckDB dialect) for every registered query.

Written independently of the Spark plans: the newest export is chosen with
``rank()``, the key dedupe with ``row_number()``, categorisation by a rule
join with ``row_number()`` per transaction, the reports as plain GROUP BYs.
Tables ``events``, ``part`` and ``customer`` are the driver's views.  Rule
tables and category rows are inputs and come from the package; what is done
with them is written here anew."""

from __future__ import annotations

from spendlake import fixed_values as FV
from spendlake.plans.catalogue import (FILTER_CATEGORIES, FIRST_RUN, FIRST_RUN_STAMP, PAGE_ROWS, SEARCH_TERM,
                                       SECOND_RUN, SLICED_ACCOUNT, SUMMARY_FILTERED, SUMMARY_WHOLE, WIDE_CALENDAR)
from spendlake.sources.rules import FIXTURE_RULES, MANY_RULES, ODD_RULES


def _q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _values(rows) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else _q(v)
    return ",\n    ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


ACCT = "(CASE WHEN user_id % 3 = 0 THEN '07' ELSE '08' END || lpad(CAST(user_id AS VARCHAR), 8, '0'))"

EXPORT_ROWS = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value, 0 AS copy FROM events
  UNION ALL
  SELECT event_id, ts, user_id, event_type, value, 1 AS copy FROM events WHERE event_id % 50 = 0
),
ev2 AS (
  SELECT ev.*, p.p_name, c.c_name, c.c_acctbal,
         CASE WHEN event_type IN ('purchase', 'click') THEN -1 ELSE 1 END AS sgn,
         {ACCT} AS acct
  FROM ev JOIN part p ON p.p_partkey = ev.event_id % (SELECT count(*) FROM part)
          JOIN customer c ON c.c_custkey = ev.event_id % (SELECT count(*) FROM customer)
),
export_rows AS (
  SELECT
    CASE WHEN event_type = 'error' THEN NULL ELSE strftime(CAST(ts AS DATE) - CAST(user_id % 50 * 35 AS INTEGER), '%Y/%m/%d') END AS posting_date_text,
    CAST(sgn * value AS DECIMAL(18,2)) AS amount,
    CASE WHEN sgn < 0 AND event_id % 101 <> 0 THEN acct END AS sender,
    CASE WHEN sgn > 0 AND event_id % 101 <> 0 THEN acct END AS recipient,
    CASE WHEN event_id % 13 <> 0 THEN c_name END AS name,
    CASE WHEN event_id % 17 <> 0 THEN p_name END AS description,
    CAST(c_acctbal + copy AS DECIMAL(18,2)) AS balance,
    'DKK' AS currency,
    CAST(NULL AS VARCHAR) AS reconciled,
    'Konto ' || acct || ' - ' || CASE WHEN event_id % 2 = 0 THEN '2024-02-01 08.00.00' ELSE '2024-01-16 08.00.00' END || '.csv' AS source_file,
    event_id * 2 + copy AS row_in_file
  FROM ev2
)"""


def _load_chain(src: str, prefix: str) -> str:
    """typed -> kept -> raw over the export rows CTE ``src``."""
    return f"""
{prefix}typed AS (
  SELECT
    md5(concat_ws('|', coalesce(posting_date_text, ''),
                  regexp_replace(CAST(amount AS VARCHAR), '0$', ''),
                  coalesce(description, ''), coalesce(name, ''),
                  coalesce(sender, ''), coalesce(recipient, ''))) AS transaction_hash,
    CAST(strptime(posting_date_text, '%Y/%m/%d') AS DATE) AS posting_date,
    amount, sender, recipient, name, description, balance, currency, reconciled, source_file, row_in_file,
    CASE WHEN starts_with(source_file, 'Konto ') THEN split_part(source_file, ' - ', 1) ELSE source_file END AS account
  FROM {src}
),
{prefix}kept AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, rank() OVER (PARTITION BY account, posting_date ORDER BY source_file DESC) AS rk
    FROM {prefix}typed WHERE posting_date IS NOT NULL) WHERE rk = 1
),
{prefix}raw AS (
  SELECT transaction_hash, posting_date, amount, sender, recipient, name, description, balance,
         currency, reconciled, source_file
  FROM (SELECT *, row_number() OVER (PARTITION BY transaction_hash
                                     ORDER BY source_file DESC, row_in_file ASC) AS rn
        FROM {prefix}kept) WHERE rn = 1
)"""


def _model(rules=FIXTURE_RULES) -> str:
    dims = _values(FV.CATEGORY_ROWS)
    cls = " ".join(f"WHEN category_type = {_q(k)} THEN {_q(v)}" for k, v in FV.CLASSIFICATION_BY_TYPE.items())
    return f"""
stg AS (
  SELECT transaction_hash, posting_date, amount, balance, currency,
         sender AS sender_account, recipient AS recipient_account,
         name AS counterparty_name, description AS transaction_description,
         reconciled AS is_reconciled,
         CASE WHEN amount < 0 THEN 'debit' ELSE 'credit' END AS transaction_type,
         abs(amount) AS absolute_amount, source_file
  FROM raw WHERE posting_date IS NOT NULL
),
rules(pattern_type, pattern_value, category_key, priority) AS (VALUES
    {_values(rules)}
),
matches AS (
  SELECT t.transaction_hash, r.pattern_type, r.category_key, r.priority
  FROM stg t JOIN rules r ON
       (r.pattern_type = 'description' AND lower(t.transaction_description) LIKE '%' || lower(r.pattern_value) || '%')
    OR (r.pattern_type = 'name' AND lower(t.counterparty_name) LIKE '%' || lower(r.pattern_value) || '%')
    OR (r.pattern_type = 'transaction_type' AND lower(t.transaction_type) = lower(r.pattern_value))
),
best AS (
  SELECT transaction_hash, category_key FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_hash
                                 ORDER BY priority DESC NULLS LAST, category_key ASC NULLS LAST) AS rn
    FROM matches) WHERE rn = 1
),
cat AS (
  SELECT t.*, coalesce(b.category_key, 'CAT999') AS category_key,
         CASE WHEN b.category_key IS NULL THEN 'Uncategorized' ELSE 'Matched' END AS categorization_status
  FROM stg t LEFT JOIN best b ON t.transaction_hash = b.transaction_hash
),
fct AS (
  SELECT transaction_hash AS transaction_key, posting_date AS date_key,
         coalesce(sender_account, recipient_account) AS account_key,
         amount, absolute_amount, balance, transaction_type, counterparty_name,
         transaction_description, currency, category_key, categorization_status, source_file
  FROM cat
),
dim_account AS (
  SELECT account_number AS account_key, account_number, '{FV.BANK_NAME}' AS bank_name,
         '{FV.DEFAULT_CURRENCY}' AS default_currency,
         CASE WHEN account_number LIKE '{FV.CHECKING_PREFIX}%' THEN 'Checking' ELSE 'Unknown' END AS account_type
  FROM (SELECT sender_account AS account_number FROM stg WHERE sender_account IS NOT NULL
        UNION
        SELECT recipient_account FROM stg WHERE recipient_account IS NOT NULL)
),
dim_category AS (
  SELECT *, CASE {cls} ELSE '{FV.OTHER_CLASSIFICATION}' END AS category_classification
  FROM (VALUES
    {dims}
  ) v(category_key, category_name, category_group, category_type, sort_order)
),
dim_date AS (
  SELECT CAST(g AS DATE) AS date_key, CAST(g AS DATE) AS date_day,
         CAST(year(g) AS INTEGER) AS year, CAST(quarter(g) AS INTEGER) AS quarter,
         CAST(month(g) AS INTEGER) AS month, CAST(weekofyear(g) AS INTEGER) AS week_of_year,
         CAST(isodow(g) AS INTEGER) AS day_of_week, monthname(g) AS month_name
  FROM generate_series(DATE '{FV.CALENDAR_START}', DATE '{FV.CALENDAR_END}', INTERVAL 1 DAY) s(g)
),
frame AS (
  SELECT f.transaction_key, f.date_key, f.account_key, f.category_key, f.amount, f.absolute_amount,
         f.balance, f.transaction_type, f.counterparty_name, f.transaction_description, f.currency,
         f.categorization_status,
         d.date_day, d.year, d.quarter, d.month, d.month_name, d.week_of_year, d.day_of_week,
         c.category_name, c.category_group, c.category_type, c.category_classification,
         a.account_number, a.bank_name, a.account_type
  FROM fct f
  LEFT JOIN dim_date d ON f.date_key = d.date_key
  LEFT JOIN dim_category c ON f.category_key = c.category_key
  LEFT JOIN dim_account a ON f.account_key = a.account_key
),
filtered AS (
  SELECT * FROM frame
  WHERE date_day >= (SELECT max(date_day) FROM frame) - 90
    AND date_day <= (SELECT max(date_day) FROM frame)
    AND transaction_type IN ('credit', 'debit')
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


BASE = _with(EXPORT_ROWS, _load_chain("export_rows", ""), _model())
SEED = _with(EXPORT_ROWS, _load_chain("export_rows", ""), _model(FV.DEFAULT_RULES))

M2 = "CAST({} AS DECIMAL(18,2))"


def _money(expr: str) -> str:
    return M2.format(expr)


def _by(src: str, key: str, extra: str = "") -> str:
    return (f"SELECT {key}, {_money('sum(absolute_amount)')} AS total_expense FROM {src} "
            f"WHERE transaction_type = 'debit' AND {key} IS NOT NULL {extra} GROUP BY {key}")


RAW_COLS = ("transaction_hash, posting_date, amount, sender, recipient, name, description, balance, "
            "currency, reconciled, source_file")
CAT_COLS = ("transaction_hash, transaction_description, counterparty_name, transaction_type, "
            "category_key, categorization_status")
REPORT_COLS = ("transaction_key, date_key, account_key, category_key, amount, absolute_amount, balance, "
               "transaction_type, counterparty_name, transaction_description, currency, categorization_status, "
               "date_day, year, quarter, month, month_name, week_of_year, day_of_week, category_name, "
               "category_group, category_type, category_classification, account_number, bank_name, account_type")

KEY_METRICS = f"""SELECT {_money("coalesce(sum(CASE WHEN transaction_type = 'credit' THEN amount END), 0)")} AS total_income,
  {_money("abs(coalesce(sum(CASE WHEN transaction_type = 'debit' THEN amount END), 0))")} AS total_expenses,
  {_money("coalesce(sum(CASE WHEN transaction_type = 'credit' THEN amount END), 0) + coalesce(sum(CASE WHEN transaction_type = 'debit' THEN amount END), 0)")} AS net_flow,
  count(*) AS transaction_count
FROM filtered"""

MONTHLY = f"""SELECT CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period,
  year, month, month_name, transaction_type, {_money('sum(amount)')} AS amount,
  {_money('abs(sum(amount))')} AS abs_amount,
  upper(substr(transaction_type, 1, 1)) || lower(substr(transaction_type, 2)) AS series
FROM filtered WHERE year IS NOT NULL AND month IS NOT NULL AND month_name IS NOT NULL AND transaction_type IS NOT NULL
GROUP BY year, month, month_name, transaction_type"""

TOP = (f"SELECT category_name, {_money('sum(absolute_amount)')} AS total_expense FROM filtered "
       "WHERE transaction_type = 'debit' AND category_name IS NOT NULL GROUP BY category_name "
       "ORDER BY total_expense DESC, category_name ASC LIMIT 5")

CAT_BY_DAY = (f"SELECT date_day, category_name, {_money('sum(absolute_amount)')} AS absolute_amount FROM filtered "
              "WHERE transaction_type = 'debit' AND date_day IS NOT NULL AND category_name IS NOT NULL "
              "GROUP BY date_day, category_name")


def _check_sql() -> str:
    parts = []
    def nn(t, c):
        parts.append(f"SELECT 'not_null' AS check_name, '{t}' AS table_name, '{c}' AS column_name, "
                     f"count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {t}")
    def un(t, c):
        parts.append(f"SELECT 'unique' AS check_name, '{t}' AS table_name, '{c}' AS column_name, "
                     f"(SELECT count(*) FROM (SELECT {c} FROM {t} "
                     f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)) AS failures")
    def av(t, c, vals):
        lst = ", ".join(_q(v) for v in vals)
        parts.append(f"SELECT 'accepted_values' AS check_name, '{t}' AS table_name, '{c}' AS column_name, "
                     f"count(DISTINCT {c}) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({lst})) AS failures FROM {t}")
    def rel(t, c, pt, pc):
        parts.append(f"SELECT 'relationships' AS check_name, '{t}' AS table_name, '{c}' AS column_name, "
                     f"count(*) AS failures FROM {t} WHERE {c} IS NOT NULL "
                     f"AND {c} NOT IN (SELECT {pc} FROM {pt} WHERE {pc} IS NOT NULL)")
    tmap = {"stg_transactions": "stg", "dim_date": "dim_date", "dim_account": "dim_account",
            "fct_transactions": "fct"}
    un("stg", "transaction_hash")
    for c in ["transaction_hash", "posting_date", "amount", "currency"]:
        nn("stg", c)
    av("stg", "currency", ["DKK"])
    av("stg", "transaction_type", ["debit", "credit"])
    un("dim_date", "date_key"); nn("dim_date", "date_key"); nn("dim_date", "date_day")
    un("dim_account", "account_key"); nn("dim_account", "account_key"); nn("dim_account", "account_number")
    un("fct", "transaction_key")
    for c in ["transaction_key", "date_key", "account_key", "amount"]:
        nn("fct", c)
    av("fct", "transaction_type", ["debit", "credit"])
    rel("fct", "date_key", "dim_date", "date_key")
    rel("fct", "account_key", "dim_account", "account_key")
    body = "\nUNION ALL\n".join(parts)
    inv = " ".join(f"WHEN '{v}' THEN '{k}'" for k, v in tmap.items())
    return (f"SELECT check_name, CASE table_name {inv} END AS table_name, column_name, "
            f"CAST(failures AS BIGINT) AS failures FROM ({body}) x")


CHECKS = _check_sql()

_DIM_DATE_FULL = """SELECT CAST(g AS DATE) AS date_key, CAST(g AS DATE) AS date_day,
  CAST(year(g) AS INTEGER) AS year, CAST(quarter(g) AS INTEGER) AS quarter, CAST(month(g) AS INTEGER) AS month,
  CAST(weekofyear(g) AS INTEGER) AS week_of_year, CAST(day(g) AS INTEGER) AS day_of_month,
  CAST(dayofyear(g) AS INTEGER) AS day_of_year, CAST(isodow(g) AS INTEGER) AS day_of_week,
  dayname(g) AS day_name, isodow(g) IN (6, 7) AS is_weekend, monthname(g) AS month_name,
  strftime(g, '%Y-%m') AS year_month, strftime(g, '%Y-Q') || CAST(quarter(g) AS VARCHAR) AS year_quarter,
  CAST(g AS DATE) = CAST(date_trunc('month', g) AS DATE) AS is_first_day_of_month,
  CAST(g AS DATE) = last_day(CAST(g AS DATE)) AS is_last_day_of_month
FROM (SELECT CAST(date_trunc('year', min(posting_date)) AS DATE) AS lo,
             CAST(date_trunc('year', max(posting_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS hi FROM stg) b,
     generate_series(b.lo, b.hi, INTERVAL 1 DAY) s(g)"""

FIRST_CHAIN = _load_chain(f"(SELECT * FROM export_rows WHERE source_file LIKE '%{FIRST_RUN_STAMP}%')", "first_")

def _audit(inserted: str) -> str:
    return f"""
per_file AS (
  SELECT p.source_file, p.parsed, p.pending,
         p.parsed - p.pending - coalesce(k.kept, 0) AS superseded,
         coalesce(k.kept, 0) - coalesce(i.inserted, 0) AS duplicate,
         coalesce(i.inserted, 0) AS inserted
  FROM (SELECT source_file, count(*) AS parsed, count(*) FILTER (WHERE posting_date IS NULL) AS pending
        FROM typed GROUP BY source_file) p
  LEFT JOIN (SELECT source_file, count(*) AS kept FROM kept GROUP BY source_file) k USING (source_file)
  LEFT JOIN (SELECT source_file, count(*) AS inserted FROM {inserted} GROUP BY source_file) i USING (source_file)
)
SELECT source_file, CAST(sum(parsed) AS BIGINT) AS parsed, CAST(sum(pending) AS BIGINT) AS pending,
       CAST(sum(superseded) AS BIGINT) AS superseded, CAST(sum(duplicate) AS BIGINT) AS duplicate,
       CAST(sum(inserted) AS BIGINT) AS inserted,
       CAST(sum(pending) + sum(superseded) + sum(duplicate) AS BIGINT) AS skipped
FROM per_file GROUP BY ROLLUP (source_file)"""


# Cells as exports hold them, bound to fields again.  A third of the accounts
# has no currency column: its currency is the default, never empty.
BOUND = """
bound AS (
  SELECT posting_date_text, amount, sender, recipient, name, description,
         CASE WHEN row_in_file % 11 <> 0 THEN balance END AS balance, currency, reconciled, source_file, row_in_file,
         translate(format('{:,.2f}', amount), ',.', '.,') AS amount_text,
         CASE WHEN row_in_file % 97 = 5 THEN 'empty amount'
              WHEN row_in_file % 89 = 7 AND CAST(substr(source_file, 7, 10) AS BIGINT) % 3 <> 2 THEN 'empty currency'
         END AS reason
  FROM export_rows
)"""


ORACLE: dict[str, str] = {
    "ingest_newest_file_wins": BASE + f" SELECT {RAW_COLS}, row_in_file FROM kept",
    "ingest_dedupe_by_hash": BASE + f" SELECT {RAW_COLS} FROM raw",
    "ingest_audit_by_file": BASE + "," + _audit("raw"),
    "ingest_audit_append": BASE + "," + FIRST_CHAIN + "," + _audit(
        "(SELECT * FROM raw WHERE transaction_hash NOT IN (SELECT transaction_hash FROM first_raw))"),
    "ingest_bind_headers": _with(EXPORT_ROWS, BOUND)
        + " SELECT * EXCLUDE (reason, amount_text) FROM bound WHERE reason IS NULL",
    "ingest_rejects": _with(EXPORT_ROWS, BOUND) + """ SELECT reason, source_file, row_in_file, posting_date_text,
  CASE WHEN reason <> 'empty amount' THEN amount_text END AS amount_text, description, name
FROM bound WHERE reason IS NOT NULL""",
    "ingest_append_new_only": BASE + "," + FIRST_CHAIN + f""" SELECT {RAW_COLS} FROM raw
WHERE transaction_hash NOT IN (SELECT transaction_hash FROM first_raw)""",
    "ingest_parse_decimal": BASE + """,
t AS (SELECT row_in_file, translate(format('{:,.2f}', amount), ',.', '.,') AS amount_text,
             translate(format('{:,.2f}', balance), ',.', '.,') AS balance_text FROM export_rows)
SELECT row_in_file, amount_text,
       CAST(replace(replace(amount_text, '.', ''), ',', '.') AS DECIMAL(18,2)) AS parsed_amount,
       balance_text,
       CAST(replace(replace(balance_text, '.', ''), ',', '.') AS DECIMAL(18,2)) AS parsed_balance
FROM t""",
    "ingest_parse_date": BASE + """ SELECT row_in_file, posting_date_text,
  CAST(strptime(posting_date_text, '%Y/%m/%d') AS DATE) AS posting_date FROM export_rows""",
    "ingest_account_from_file": BASE + " SELECT source_file, account, count(*) AS rows FROM typed GROUP BY source_file, account",
    "stage_transactions": BASE + " SELECT * FROM stg",
    "categorise_transactions": BASE + f" SELECT {CAT_COLS} FROM cat",
    "categorise_join_form": BASE + f" SELECT {CAT_COLS} FROM cat",
    "categorise_automaton_form": BASE + f" SELECT {CAT_COLS} FROM cat",
    "categorise_odd_rules": _with(EXPORT_ROWS, _load_chain("export_rows", ""), _model(ODD_RULES))
        + f" SELECT {CAT_COLS} FROM cat",
    "categorise_many_rules": _with(EXPORT_ROWS, _load_chain("export_rows", ""), _model(MANY_RULES))
        + f" SELECT {CAT_COLS} FROM cat",
    "categorise_array_form": BASE + f" SELECT {CAT_COLS} FROM cat",
    "categorise_seed_rules": SEED + f" SELECT {CAT_COLS} FROM cat",
    "category_counts": BASE + f""" SELECT category_key, categorization_status, count(*) AS transactions,
  {_money('sum(amount)')} AS amount FROM cat GROUP BY category_key, categorization_status""",
    "fct_transactions": BASE + " SELECT * FROM fct",
    "dim_account": BASE + " SELECT * FROM dim_account",
    "dim_date": BASE + " " + _DIM_DATE_FULL,
    "report_frame_joined": BASE + f" SELECT {REPORT_COLS} FROM frame",
    "report_frame_large_dim": BASE + f" SELECT {REPORT_COLS} FROM frame",
    "report_frame": BASE + f" SELECT {REPORT_COLS} FROM frame",
    "data_summary": BASE + " SELECT count(*) AS total_transactions, min(date_day) AS min_date, max(date_day) AS max_date FROM frame",
    "key_metrics": BASE + " " + KEY_METRICS,
    "key_metrics_text": BASE + f""", m AS ({KEY_METRICS})
SELECT format('{{:,.2f}}', total_income) || ' DKK' AS total_income_text,
       format('{{:,.2f}}', total_expenses) || ' DKK' AS total_expenses_text,
       format('{{:,.2f}}', net_flow) || ' DKK' AS net_flow_text,
       format('{{:,}}', transaction_count) AS transaction_count_text FROM m""",
    "income_vs_expenses": BASE + f""", m AS ({KEY_METRICS})
SELECT 'Income' AS type, total_income AS amount FROM m
UNION ALL SELECT 'Expenses', total_expenses FROM m""",
    "expenses_by_category": BASE + " " + _by("filtered", "category_name"),
    "expenses_by_group": BASE + " " + _by("filtered", "category_group"),
    "expenses_by_type": BASE + " " + _by("filtered", "category_type"),
    "daily_cash_flow": BASE + f""" SELECT date_day, transaction_type, {_money('sum(amount)')} AS amount
FROM filtered WHERE date_day IS NOT NULL AND transaction_type IS NOT NULL GROUP BY date_day, transaction_type""",
    "monthly_summary": BASE + " " + MONTHLY,
    "monthly_summary_wide": BASE + f""", ms AS ({MONTHLY})
SELECT period, {_money("sum(abs_amount) FILTER (WHERE transaction_type = 'credit')")} AS credit,
       {_money("sum(abs_amount) FILTER (WHERE transaction_type = 'debit')")} AS debit
FROM ms GROUP BY period""",
    "category_by_day": BASE + " " + CAT_BY_DAY,
    "top_categories": BASE + " " + TOP,
    "top_category_by_day": BASE + f""", top AS ({TOP}), cbd AS ({CAT_BY_DAY})
SELECT category_name, date_day, absolute_amount FROM cbd WHERE category_name IN (SELECT category_name FROM top)""",
    "uncategorised_share": BASE + """ SELECT count(*) FILTER (WHERE categorization_status = 'Uncategorized') AS uncategorised,
  count(*) AS transactions,
  round(CAST(100.0 * count(*) FILTER (WHERE categorization_status = 'Uncategorized') AS DOUBLE) / nullif(count(*), 0), 1) AS uncategorised_pct
FROM filtered""",
    "transaction_list": BASE + """ SELECT date_day, amount, category_name, counterparty_name, transaction_description
FROM filtered ORDER BY date_day DESC NULLS LAST, transaction_key""",
    "transaction_search": BASE + f""" SELECT * FROM filtered
WHERE coalesce(regexp_matches(transaction_description, '{SEARCH_TERM}', 'i'), false)
   OR coalesce(regexp_matches(counterparty_name, '{SEARCH_TERM}', 'i'), false)""",
    "category_list": BASE + " SELECT DISTINCT category_name FROM filtered WHERE category_name IS NOT NULL ORDER BY category_name",
    "categories_in_use": BASE + """ SELECT * FROM dim_category
WHERE category_key IN (SELECT category_key FROM fct WHERE category_key IS NOT NULL) ORDER BY sort_order, category_key""",
    "measure_total_amount": BASE + f" SELECT {_money('coalesce(sum(amount), 0)')} AS total_amount FROM fct",
    "measure_average": BASE + f" SELECT CAST(sum(absolute_amount) AS DOUBLE) / count(absolute_amount) AS average_transaction FROM fct",
    "measures": BASE + f""" SELECT {_money('coalesce(sum(amount), 0)')} AS total_amount,
  {_money("coalesce(sum(CASE WHEN transaction_type = 'credit' THEN amount END), 0)")} AS total_income,
  {_money("coalesce(sum(CASE WHEN transaction_type = 'debit' THEN amount END), 0)")} AS total_expenses,
  count(*) AS transaction_count,
  CAST(sum(absolute_amount) AS DOUBLE) / count(absolute_amount) AS average_transaction,
  {_money("coalesce(sum(CASE WHEN transaction_type = 'credit' THEN amount END), 0) + coalesce(sum(CASE WHEN transaction_type = 'debit' THEN amount END), 0)")} AS net_flow
FROM fct""",
    "daily_balance": BASE + """,
placed AS (SELECT *, row_number() OVER (PARTITION BY transaction_hash ORDER BY source_file DESC, row_in_file ASC) AS rn
           FROM kept)
SELECT account_key, date_key, balance FROM (
  SELECT coalesce(sender, recipient) AS account_key, posting_date AS date_key, balance,
         row_number() OVER (PARTITION BY coalesce(sender, recipient), posting_date
                            ORDER BY source_file DESC, row_in_file DESC, transaction_hash DESC) AS last
  FROM placed WHERE rn = 1) WHERE last = 1 AND account_key IS NOT NULL""",
    "category_matrix": BASE + f""" SELECT category_group, category_name, {_money('sum(amount)')} AS amount,
  {_money('sum(absolute_amount)')} AS absolute_amount, count(*) AS transactions,
  CAST(grouping(category_group, category_name) AS INTEGER) AS level
FROM frame GROUP BY ROLLUP (category_group, category_name)""",
    "spending_without_transfers": BASE + " " + _by("frame", "category_name", "AND category_type <> 'Transfer'"),
    "amount_by_date": BASE + f" SELECT date_day, {_money('sum(amount)')} AS amount FROM frame WHERE date_day IS NOT NULL GROUP BY date_day",
    "amount_by_category": BASE + f" SELECT category_name, {_money('sum(amount)')} AS amount FROM frame WHERE category_name IS NOT NULL GROUP BY category_name",
    "filter_last_90_days": BASE + f""" SELECT {REPORT_COLS} FROM frame
WHERE date_day >= (SELECT max(date_day) FROM frame) - 90 AND date_day <= (SELECT max(date_day) FROM frame)""",
    "filter_category": BASE + f""" SELECT {REPORT_COLS} FROM frame
WHERE category_name IN ({", ".join(_q(c) for c in FILTER_CATEGORIES)})""",
    "filter_type": BASE + f" SELECT {REPORT_COLS} FROM frame WHERE transaction_type IN ('debit')",
    "filter_period": BASE + f" SELECT {REPORT_COLS} FROM frame WHERE year = 2024 AND quarter = 1 AND month = 1",
    "check_unique": BASE + f" SELECT * FROM ({CHECKS}) WHERE check_name = 'unique'",
    "check_not_null": BASE + f" SELECT * FROM ({CHECKS}) WHERE check_name = 'not_null'",
    "check_accepted_values": BASE + f" SELECT * FROM ({CHECKS}) WHERE check_name = 'accepted_values'",
    "check_relationships": BASE + f" SELECT * FROM ({CHECKS}) WHERE check_name = 'relationships'",
    "check_all": BASE + f" SELECT * FROM ({CHECKS})",
}

for _t in ("description", "name", "transaction_type"):
    ORACLE["match_" + ("type" if _t == "transaction_type" else _t)] = BASE + f""" SELECT transaction_hash, category_key, priority FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_hash
                               ORDER BY priority DESC NULLS LAST, category_key ASC NULLS LAST) AS rn
  FROM matches WHERE pattern_type = '{_t}') WHERE rn = 1"""


# --- stored ledger: the older exports loaded, then all exports appended ---------

APPENDED = _with(EXPORT_ROWS, _load_chain("export_rows", "all_"), FIRST_CHAIN, f"""
raw AS (
  SELECT {RAW_COLS} FROM first_raw
  UNION ALL
  SELECT {RAW_COLS} FROM all_raw WHERE transaction_hash NOT IN (SELECT transaction_hash FROM first_raw)
)""", _model())


def _run_audit(prefix: str, inserted: str, run: str) -> str:
    return f"""
SELECT source_file, CAST(sum(parsed) AS BIGINT) AS parsed, CAST(sum(pending) AS BIGINT) AS pending,
       CAST(sum(parsed - pending - held) AS BIGINT) AS superseded, CAST(sum(held - added) AS BIGINT) AS duplicate,
       CAST(sum(added) AS BIGINT) AS inserted, CAST(sum(parsed - added) AS BIGINT) AS skipped, {_q(run)} AS run_id
FROM (SELECT source_file, count(*) AS parsed, count(*) FILTER (posting_date IS NULL) AS pending
      FROM {prefix}typed GROUP BY source_file)
LEFT JOIN (SELECT source_file, count(*) AS kept_rows FROM {prefix}kept GROUP BY source_file) USING (source_file)
LEFT JOIN (SELECT source_file, count(*) AS new_rows FROM {inserted} GROUP BY source_file) USING (source_file),
LATERAL (SELECT coalesce(kept_rows, 0) AS held, coalesce(new_rows, 0) AS added)
GROUP BY ROLLUP (source_file)"""


_PASSING = _with(EXPORT_ROWS, _load_chain("(SELECT * FROM export_rows WHERE sender IS NOT NULL OR recipient IS NOT NULL)",
                                          ""), _model().replace(FV.CALENDAR_START, WIDE_CALENDAR[0]))

_EDITED = """
edited AS (
  SELECT * REPLACE (CASE WHEN row_in_file % 10 = 0 THEN d || ' "x;y"' ELSE d END AS description) FROM (
    SELECT *, CASE WHEN row_in_file % 7 = 0 THEN replace(description, ' ', chr(10)) ELSE description END AS d
    FROM export_rows)
)"""
_CSV = _with(EXPORT_ROWS, _EDITED, BOUND.replace("FROM export_rows", "FROM edited"))
_CSV_ROWS = _CSV + " SELECT * EXCLUDE (reason, amount_text, row_in_file) FROM bound WHERE reason IS NULL"

ORACLE |= {
    "ingest_csv_files": _CSV_ROWS,
    "ingest_csv_ranges": _CSV_ROWS,
    "ingest_csv_rejects": _CSV + """ SELECT reason, source_file, posting_date_text,
  CASE WHEN reason <> 'empty amount' THEN amount_text END AS amount_text, description, name
FROM bound WHERE reason IS NOT NULL""",
    "transaction_search_indexed": BASE + f""" SELECT {REPORT_COLS} FROM frame
WHERE coalesce(regexp_matches(transaction_description, '{SEARCH_TERM}', 'i'), false)
   OR coalesce(regexp_matches(counterparty_name, '{SEARCH_TERM}', 'i'), false)""",
    "transaction_page": BASE + f""" SELECT transaction_key, date_day, amount, category_name, counterparty_name,
  transaction_description
FROM frame ORDER BY date_day DESC NULLS LAST, transaction_key LIMIT {PAGE_ROWS} OFFSET {PAGE_ROWS}""",
    "filter_last_90_days_lazy": ORACLE["filter_last_90_days"],
    "filter_quarter": BASE + f" SELECT {REPORT_COLS} FROM frame WHERE year = 2023 AND quarter = 2",
    "filter_account": BASE + f" SELECT {REPORT_COLS} FROM frame WHERE year = 2023 AND account_number = {_q(SLICED_ACCOUNT)}",
    "ledger_raw_after_append": APPENDED + f" SELECT {RAW_COLS} FROM raw",
    "ledger_audit_history": APPENDED + _run_audit("first_", "first_raw", FIRST_RUN) + " UNION ALL " + _run_audit(
        "all_", "(SELECT * FROM all_raw WHERE transaction_hash NOT IN (SELECT transaction_hash FROM first_raw))",
        SECOND_RUN),
    "ledger_repeated_keys": APPENDED + """ SELECT count(*) AS transactions,
  count(*) - count(DISTINCT transaction_key) AS repeated FROM fct""",
    "pipeline_checks": _PASSING + f" SELECT * FROM ({CHECKS})",
    "pipeline_stored_marts": _PASSING + " " + KEY_METRICS.replace("FROM filtered", "FROM frame"),
    "export_marts_round_trip": BASE + """,
sizes AS (
  SELECT 'dim_account' AS mart, count(*) AS n FROM dim_account UNION ALL SELECT 'dim_category', count(*) FROM dim_category
  UNION ALL SELECT 'dim_date', count(*) FROM dim_date UNION ALL SELECT 'fct_transactions', count(*) FROM fct)
SELECT mart, n AS exported, n AS read_back FROM sizes
UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT), CAST(sum(n) AS BIGINT) FROM sizes""",
}
for _n in [*SUMMARY_FILTERED, *SUMMARY_WHOLE]:
    ORACLE[f"summary_{_n}"] = APPENDED + ORACLE[_n].removeprefix(BASE)

"""DuckDB SQL for the cross-engine check of every registered query.

The leading CTEs rebuild the same stand-in inputs as ``finlake.sources`` from
the driver's tables; the model CTEs state the rules in DuckDB's own terms (ASOF
JOIN for the rates, global ``row_number`` for keys, joined value lists for the
category lookups), so they check the Spark formulations independently.
Tie-breaks the reference leaves open are fixed identically on both sides.
"""

from __future__ import annotations

from finlake.functions import vocab as V
from finlake.plans.checks import DECLARED


def _list(xs) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


def _lit(v) -> str:
    return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


def _values(mapping: dict) -> str:
    return ", ".join(f"({_lit(k)}, {_lit(v)})" for k, v in mapping.items())


BATCH_RAW = f"""
batch_extract AS (
  SELECT
    CASE WHEN o.o_orderkey % 103 = 0 THEN NULL ELSE 'txn_' || CAST(o.o_orderkey AS VARCHAR) END AS transaction_id,
    'acc_' || CAST(c.c_custkey AS VARCHAR) AS account_id,
    ' ' || c.c_name || ' ' AS account_name,
    CASE WHEN c.c_custkey % 3 = 0 THEN 'CURRENT' WHEN c.c_custkey % 3 = 1 THEN 'Savings' ELSE 'credit' END AS account_type,
    ' Bank ' || CAST(c.c_nationkey AS VARCHAR) AS bank_name,
    CASE WHEN c.c_custkey % 5 = 3 THEN 'usd' WHEN c.c_custkey % 5 = 4 THEN 'EUR' ELSE 'GBP' END AS currency,
    CASE WHEN o.o_orderkey % 101 = 0 THEN CAST(0.0 AS DOUBLE) ELSE o.o_totalprice END AS amount,
    CASE WHEN o.o_orderstatus <> 'F' THEN 'debit' WHEN o.o_orderkey % 2 = 0 THEN 'credit' ELSE 'Credit' END AS transaction_type,
    CASE WHEN o.o_orderstatus = 'F' THEN ({_list(V.INCOME_CATEGORIES)})[o.o_orderkey % 4 + 1]
         ELSE ' ' || ({_list(V.EXPENSE_CATEGORIES)})[o.o_orderkey % 18 + 1] || ' ' END AS category,
    CASE WHEN o.o_orderstatus = 'F' THEN 'Income' ELSE 'expense' END AS category_type,
    'Merchant ' || CAST(o.o_orderkey % 97 AS VARCHAR) AS merchant,
    CASE WHEN o.o_orderkey % 53 <> 0 THEN CAST(o.o_orderdate AS DATE) + 9131 END AS transaction_date,
    CAST(CAST(o.o_orderdate AS DATE) + 9131 AS TIMESTAMP) + to_seconds(o.o_orderkey % 86400) AS transaction_timestamp
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
batch_raw AS (
  SELECT transaction_id, account_id, account_name, account_type, bank_name, currency, amount,
         transaction_type, category, category_type, merchant,
         merchant || ' - ' || category AS description,
         transaction_date, transaction_timestamp,
         TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at,
         'MockTransactionsIngestion' AS _source,
         CASE WHEN transaction_type = 'credit' THEN amount ELSE -amount END AS signed_amount,
         CAST(year(transaction_date) AS INTEGER) AS transaction_year,
         CAST(month(transaction_date) AS INTEGER) AS transaction_month,
         CAST(isodow(transaction_date) - 1 AS INTEGER) AS transaction_day_of_week
  FROM batch_extract
)"""

# events -> messages -> parsed rows; every 50th event is delivered twice.
STREAM = """
ev AS (
  SELECT event_id, ts + to_days(CAST(event_id % 5 * 30 AS INTEGER)) AS ts, user_id, event_type, value
  FROM events, range(CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END)
),
ev_flags AS (
  SELECT *, (event_id % 17 = 0 AND event_id % 13 <> 0 AND event_type <> 'signup') AS explicit_null_cat
  FROM ev
),
stream_all AS (
  SELECT
    'acc_' || CAST(user_id AS VARCHAR) AS key,
    CASE WHEN event_id % 101 = 0 THEN 'malformed_json'
         WHEN event_id % 97 = 0 THEN 'missing_required'
         WHEN event_id % 83 = 0 THEN 'invalid_amount'
         WHEN event_id % 89 = 0 THEN 'invalid_timestamp' END AS reject_reason,
    'evt_' || CAST(event_id AS VARCHAR) AS transaction_id,
    'acc_' || CAST(user_id AS VARCHAR) AS account_id,
    CASE WHEN event_id % 3 = 0 THEN 'Streaming Account' ELSE 'User ' || CAST(user_id AS VARCHAR) END AS account_name,
    CASE WHEN event_id % 8 = 0 THEN 'current' ELSE 'savings' END AS account_type,
    'Digital Bank' AS bank_name,
    CASE WHEN event_id % 5 = 3 THEN 'USD' WHEN event_id % 5 = 4 THEN 'EUR' ELSE 'GBP' END AS currency,
    abs(CASE WHEN event_id % 7 = 0 THEN -value ELSE value END) AS amount,
    CASE WHEN event_id % 11 = 0 THEN 'debit' WHEN event_type = 'signup' THEN 'credit' ELSE 'debit' END AS transaction_type,
    CASE WHEN event_type = 'signup' THEN 'income' WHEN event_id % 13 = 0 THEN 'other'
         WHEN explicit_null_cat THEN NULL ELSE event_type END AS category,
    CASE WHEN event_id % 4 = 0 THEN 'Unknown' ELSE 'Shop ' || CAST(user_id % 20 AS VARCHAR) END AS merchant,
    CASE WHEN event_id % 6 = 0 THEN '' ELSE 'Event ' || event_type END AS description,
    CAST(ts AS DATE) AS transaction_date,
    CASE WHEN event_id % 3 = 2 THEN ts - INTERVAL 1 HOUR ELSE ts END AS transaction_timestamp,
    TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at,
    'KafkaConsumer' AS _source,
    CASE WHEN event_id % 11 <> 0 AND event_type <> 'signup' THEN -abs(value) ELSE abs(value) END AS signed_amount
  FROM ev_flags
),
stream_raw AS (
  SELECT transaction_id, account_id, account_name, account_type, bank_name, currency, amount,
         transaction_type, category,
         CASE WHEN category = 'income' THEN 'income' ELSE 'expense' END AS category_type,
         merchant, description, transaction_date, transaction_timestamp, _ingested_at, _source,
         signed_amount,
         CAST(year(transaction_date) AS INTEGER) AS transaction_year,
         CAST(month(transaction_date) AS INTEGER) AS transaction_month,
         CAST(isodow(transaction_date) - 1 AS INTEGER) AS transaction_day_of_week
  FROM stream_all WHERE reject_reason IS NULL
),
raw_transactions AS (
  SELECT * FROM batch_raw UNION ALL SELECT * FROM stream_raw
)"""

RATES = """
rate_days AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) + 9131 AS d FROM orders
),
rates_clean AS (
  SELECT CAST(d AS TIMESTAMP) AS rate_date, ccy AS target_currency,
         CASE WHEN ccy = 'USD' THEN CAST(1.2 AS DOUBLE) ELSE CAST(1.1 AS DOUBLE) END
           + (dayofyear(d) % 50) / CAST(1000.0 AS DOUBLE) AS rate
  FROM (SELECT d, unnest(['USD', 'EUR']) AS ccy FROM rate_days
        WHERE isodow(d) <= 5 AND d >= DATE '2020-03-02')
),
rates_run1 AS (
  SELECT rate_date,
         CASE WHEN dayofmonth(rate_date) = 5 AND target_currency = 'USD' THEN ' gbp ' ELSE 'GBP' END AS base_currency,
         CASE WHEN dayofmonth(rate_date) = 5 AND target_currency = 'USD' THEN ' usd ' ELSE target_currency END AS target_currency,
         rate
  FROM rates_clean
  UNION ALL
  SELECT rate_date, 'GBP', target_currency, CAST(0.0 AS DOUBLE) FROM rates_clean
  WHERE dayofmonth(rate_date) = 10 AND target_currency = 'USD'
  UNION ALL
  SELECT rate_date, 'GBP', target_currency, CAST(NULL AS DOUBLE) FROM rates_clean
  WHERE dayofmonth(rate_date) = 20 AND target_currency = 'EUR'
),
rates_run2 AS (
  SELECT rate_date, 'GBP' AS base_currency, target_currency, rate + CAST(0.005 AS DOUBLE) AS rate
  FROM rates_clean WHERE dayofmonth(rate_date) = 15
),
raw_exchange_rates AS (
  SELECT rate_date, base_currency, target_currency, round_even(rate, 6) AS rate,
         TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at, 'ExchangeRatesIngestion' AS _source,
         CASE WHEN rate = 0 THEN NULL ELSE round_even(1.0 / rate, 6) END AS inverse_rate
  FROM rates_run1
  UNION ALL
  SELECT rate_date, base_currency, target_currency, round_even(rate, 6),
         TIMESTAMP '2024-01-01 01:00:00', 'ExchangeRatesIngestion',
         CASE WHEN rate = 0 THEN NULL ELSE round_even(1.0 / rate, 6) END
  FROM rates_run2
)"""

STAGING = """
stg_transactions AS (
  SELECT transaction_id, account_id, trim(account_name) AS account_name,
         lower(account_type) AS account_type, trim(bank_name) AS bank_name,
         upper(currency) AS currency,
         CAST(amount AS DECIMAL(18, 2)) AS amount,
         CAST(signed_amount AS DECIMAL(18, 2)) AS signed_amount,
         lower(transaction_type) AS transaction_type, trim(category) AS category,
         lower(category_type) AS category_type, trim(merchant) AS merchant,
         trim(description) AS description,
         CAST(transaction_date AS DATE) AS transaction_date,
         CAST(transaction_timestamp AS TIMESTAMP) AS transaction_timestamp,
         transaction_year, transaction_month, transaction_day_of_week, _ingested_at, _source
  FROM raw_transactions
  WHERE transaction_id IS NOT NULL AND amount > 0
),
stg_exchange_rates AS (
  SELECT CAST(rate_date AS DATE) AS rate_date,
         upper(trim(base_currency)) AS base_currency,
         upper(trim(target_currency)) AS target_currency,
         CAST(rate AS DECIMAL(18, 6)) AS rate,
         CAST(inverse_rate AS DECIMAL(18, 6)) AS inverse_rate,
         _ingested_at, _source
  FROM raw_exchange_rates
  WHERE rate IS NOT NULL AND rate > 0
)"""

CONVERSION = """
day_rates AS (
  SELECT target_currency AS code, rate_date AS day,
         first(rate ORDER BY _ingested_at DESC NULLS LAST, rate DESC) AS per_pound
  FROM stg_exchange_rates WHERE base_currency = 'GBP' GROUP BY ALL
),
priced AS (
  SELECT t.*, r.per_pound, r.day AS priced_on
  FROM (SELECT *, nullif(currency, 'GBP') AS foreign_code FROM stg_transactions) t
  ASOF LEFT JOIN day_rates r ON t.foreign_code = r.code AND t.transaction_date >= r.day
),
int_transactions_with_gbp AS (
  SELECT * EXCLUDE (foreign_code, per_pound, priced_on),
         coalesce(round(amount / nullif(per_pound, 0), 2), CAST(amount AS DOUBLE)) AS amount_gbp,
         coalesce(round(signed_amount / nullif(per_pound, 0), 2), CAST(signed_amount AS DOUBLE)) AS signed_amount_gbp,
         nullif(per_pound, 0) AS exchange_rate_used, if(per_pound = 0, NULL, priced_on) AS exchange_rate_date,
         coalesce(per_pound <> 0, false) AS was_converted
  FROM priced
)"""

DIMS = f"""
calendar AS (
  SELECT CAST(range AS DATE) AS d
  FROM range(DATE '{V.DATE_SPINE_START}', DATE '{V.DATE_SPINE_END}' + INTERVAL 1 DAY, INTERVAL 1 DAY)
),
dim_dates AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
         dayofweek(d) AS day_of_week, dayname(d) AS day_name, day(d) AS day_of_month,
         dayofyear(d) AS day_of_year, weekofyear(d) AS week_of_year, month(d) AS month_number,
         monthname(d) AS month_name, monthname(d)[:3] AS month_short, quarter(d) AS quarter_number,
         concat('Q', quarter(d)) AS quarter_name, year(d) AS year_number,
         year(d) - CAST(month(d) < 4 AS BIGINT) AS fiscal_year, isodow(d) > 5 AS is_weekend,
         CAST(d AS VARCHAR) AS iso_date, CAST(d AS VARCHAR)[:7] AS year_month
  FROM calendar
),
dim_accounts AS (
  SELECT row_number() OVER (ORDER BY account_id NULLS LAST) AS account_key,
         account_id, account_name, account_type, currency, true AS is_active
  FROM (SELECT account_id, account_name, account_type, currency,
               row_number() OVER (PARTITION BY account_id
                                  ORDER BY account_name NULLS LAST, account_type NULLS LAST,
                                           currency NULLS LAST) AS rn
        FROM stg_transactions) WHERE rn = 1
),
parents(name, parent) AS (VALUES {_values(V.PARENT_CATEGORY)}),
budgets(name, budget) AS (VALUES {_values(V.BUDGET_CATEGORY)}),
ranks(parent, place) AS (VALUES {_values(V.PARENT_SORT_ORDER)}),
used AS (
  SELECT category AS name, category_type, coalesce(parent, {_lit(V.PARENT_DEFAULT)}) AS parent,
         coalesce(budget, {_lit(V.BUDGET_DEFAULT)}) AS budget
  FROM (SELECT category, category_type FROM stg_transactions GROUP BY ALL) c
  LEFT JOIN parents p ON p.name = c.category LEFT JOIN budgets b ON b.name = c.category
  WHERE category IS NOT NULL
),
dim_categories AS (
  SELECT row_number() OVER (ORDER BY category_type DESC NULLS LAST, name) AS category_key,
         name AS category_id, name AS category_name, category_type,
         used.parent AS parent_category, budget AS budget_category,
         CAST(coalesce(place, {_lit(V.SORT_ORDER_DEFAULT)}) AS INTEGER) AS sort_order
  FROM used LEFT JOIN ranks ON ranks.parent = used.parent
)"""

FACT = """
fact_transactions AS (
  SELECT
    row_number() OVER (ORDER BY t.transaction_timestamp NULLS LAST, t.transaction_id NULLS LAST) AS transaction_key,
    t.transaction_id, d.date_key, a.account_key, c.category_key,
    t.merchant, t.description, t.transaction_type, t.amount, t.signed_amount, t.currency,
    t.amount_gbp, t.signed_amount_gbp, t.exchange_rate_used, t.exchange_rate_date,
    t.was_converted, t.transaction_date, t.transaction_timestamp, t._ingested_at
  FROM int_transactions_with_gbp t
  LEFT JOIN dim_accounts a ON t.account_id = a.account_id
  LEFT JOIN dim_categories c ON t.category = c.category_id
  LEFT JOIN dim_dates d ON t.transaction_date = d.full_date
),
wide AS (
  SELECT f.transaction_id, f.transaction_date, f.amount, f.signed_amount, f.amount_gbp,
         f.signed_amount_gbp, f.transaction_type, f.merchant, f.description,
         a.account_name, a.account_type, c.category_name, c.parent_category, c.category_type,
         d.day_name, d.month_name, d.year_number
  FROM fact_transactions f
  LEFT JOIN dim_accounts a ON f.account_key = a.account_key
  LEFT JOIN dim_categories c ON f.category_key = c.category_key
  LEFT JOIN dim_dates d ON f.date_key = d.date_key
)"""

RAW = BATCH_RAW + "," + STREAM
ALL_RAW = RAW + "," + RATES
WAREHOUSE = ALL_RAW + "," + STAGING + "," + CONVERSION + "," + DIMS + "," + FACT


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def present(sql: str, dates=(), decimals=()) -> str:
    """Same presentation as the Spark side: DATE -> TIMESTAMP, DECIMAL (and the
    nullable integer keys listed with them) -> DOUBLE."""
    repl = [f"CAST({c} AS TIMESTAMP) AS {c}" for c in dates] + \
           [f"CAST({c} AS DOUBLE) AS {c}" for c in decimals]
    if not repl:
        return sql
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM ({sql}) AS q"


PENCE = "CAST(amount_gbp AS DECIMAL(28, 2))"
POUNDS = f"CAST(sum({PENCE}) AS DOUBLE)"
MONEY = "'£' || format('{:,.2f}', %s)"
DAYS = _list(V.DAY_ORDER)


def _dq_sql(tests: tuple[str, ...]) -> str:
    parts = []
    for tc in DECLARED:
        for ck in tc.checks:
            if ck.test not in tests:
                continue
            t, c = tc.table, ck.column
            head = f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{ck.test}' AS test_name, "
            if ck.test == "not_null":
                parts.append(head + f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {t}")
            elif ck.test == "accepted_values":
                parts.append(head + f"CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN "
                             f"({', '.join(repr(v) for v in ck.values)})) AS BIGINT) AS failures FROM {t}")
            elif ck.test == "unique":
                parts.append(head + f"CAST(count(*) AS BIGINT) AS failures FROM "
                             f"(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
            elif ck.test == "relationships":
                parts.append(head + f"CAST(count(*) AS BIGINT) AS failures FROM {t} ch "
                             f"WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
                             f"(SELECT 1 FROM {ck.to} p WHERE p.{ck.field} = ch.{c})")
    return "\nUNION ALL\n".join(parts)


TITLE = ("array_to_string(list_transform(range(1, length({0}) + 1), lambda i: "
         "CASE WHEN i = 1 OR NOT regexp_matches(substr({0}, i - 1, 1), '\\p{{L}}') "
         "THEN upper(substr({0}, i, 1)) ELSE lower(substr({0}, i, 1)) END), '')")
ISO = ("CASE WHEN epoch_us({0}) % 1000000 = 0 THEN strftime({0}, '%Y-%m-%dT%H:%M:%S') "
       "ELSE strftime({0}, '%Y-%m-%dT%H:%M:%S.%f') END")
MESSAGE_FIELDS = ("'account_id': account_id, 'account_name': account_name, 'account_type': account_type, "
                  "'currency': currency, 'amount': amount, 'transaction_type': transaction_type, "
                  "'category': category, 'merchant': merchant, "
                  "'description': merchant || ' - ' || cat_title, "
                  "'transaction_date': strftime(transaction_timestamp, '%Y-%m-%d'), "
                  "'transaction_timestamp': ts_iso, 'event_time': ts_iso")
PUBLISH = ("SELECT account_id AS key, CASE WHEN transaction_id IS NULL "
           "THEN to_json({" + MESSAGE_FIELDS + "}) "
           "ELSE to_json({'transaction_id': transaction_id, " + MESSAGE_FIELDS + "}) END AS value "
           "FROM (SELECT *, " + TITLE.format("category") + " AS cat_title, "
           + ISO.format("transaction_timestamp") + " AS ts_iso FROM batch_raw)")

TX_DATES = ("transaction_date",)
TX_DECIMALS = ("amount", "signed_amount")
PARTS = ("transaction_year", "transaction_month", "transaction_day_of_week")  # null without a date


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["stg_transactions"] = present(_with(RAW + "," + STAGING.split("stg_exchange_rates AS")[0].rstrip().rstrip(","),
                                          "SELECT * FROM stg_transactions"), TX_DATES, TX_DECIMALS + PARTS)
    q["stg_exchange_rates"] = present(
        _with(RATES + "," + "stg_exchange_rates AS" + STAGING.split("stg_exchange_rates AS")[1],
              "SELECT * FROM stg_exchange_rates"), ("rate_date",), ("rate", "inverse_rate"))
    q["int_transactions_with_gbp"] = present(
        _with(ALL_RAW + "," + STAGING + "," + CONVERSION, "SELECT * FROM int_transactions_with_gbp"),
        ("transaction_date", "exchange_rate_date"), ("amount", "signed_amount", "exchange_rate_used") + PARTS)
    q["asof_interval"] = present(
        _with(ALL_RAW + "," + STAGING + "," + CONVERSION,
              "SELECT transaction_id, currency, transaction_date, CAST(per_pound AS DOUBLE) AS rate, "
              "priced_on AS exchange_rate_date FROM priced WHERE foreign_code IS NOT NULL"),
        ("transaction_date", "exchange_rate_date"))
    q["dim_dates_in_use"] = present(
        _with(RAW + "," + STAGING.split("stg_exchange_rates AS")[0].rstrip().rstrip(",") + "," +
              DIMS.split("dim_accounts AS")[0].rstrip().rstrip(","),
              "SELECT * FROM dim_dates WHERE full_date IN (SELECT transaction_date FROM stg_transactions)"),
        ("full_date",))
    q["dim_accounts"] = _with(WAREHOUSE, "SELECT * FROM dim_accounts")
    q["dim_categories"] = _with(WAREHOUSE, "SELECT * FROM dim_categories")
    q["fact_transactions"] = present(_with(WAREHOUSE, "SELECT * FROM fact_transactions"),
                                     ("transaction_date", "exchange_rate_date"),
                                     ("amount", "signed_amount", "exchange_rate_used",
                                      "date_key", "account_key", "category_key"))
    q["surrogate_key"] = _with(
        RAW + "," + STAGING.split("stg_exchange_rates AS")[0].rstrip().rstrip(","),
        "SELECT transaction_id, transaction_timestamp, row_number() OVER "
        "(ORDER BY transaction_timestamp NULLS LAST, transaction_id NULLS LAST) AS transaction_key "
        "FROM stg_transactions")
    q["wide_transactions"] = present(_with(WAREHOUSE, "SELECT * FROM wide ORDER BY transaction_date DESC"),
                                     TX_DATES, TX_DECIMALS + ("year_number",))
    side = "coalesce(sum(" + PENCE + ") FILTER (WHERE transaction_type = '{}'), 0)"
    q["summary_stats"] = _with(
        WAREHOUSE, f"SELECT count(*) AS total_transactions, CAST({side.format('credit')} AS DOUBLE) AS total_income, "
                   f"CAST({side.format('debit')} AS DOUBLE) AS total_expenses, "
                   "count(DISTINCT merchant) AS unique_merchants FROM fact_transactions")
    q["net_position"] = present(
        _with(WAREHOUSE, "SELECT money_in AS total_income, money_out AS total_expenses, "
                         "money_in - money_out AS net_position, "
                         "if(money_in > money_out, 'Surplus', 'Deficit') AS position_label FROM "
                         f"(SELECT {side.format('credit')} AS money_in, {side.format('debit')} AS money_out "
                         "FROM fact_transactions)"),
        decimals=("total_income", "total_expenses", "net_position"))
    q["spend_by_category"] = _with(WAREHOUSE,
                                   f"SELECT category_name, {POUNDS} AS amount_gbp FROM wide "
                                   "WHERE transaction_type = 'debit' AND category_name IS NOT NULL "
                                   "GROUP BY category_name ORDER BY amount_gbp, category_name")
    q["daily_totals"] = present(_with(WAREHOUSE,
                                      f"SELECT transaction_date, transaction_type, {POUNDS} AS amount_gbp "
                                      "FROM wide WHERE transaction_date IS NOT NULL AND transaction_type IS NOT NULL "
                                      "GROUP BY transaction_date, transaction_type ORDER BY 1, 2"), TX_DATES)
    q["top_merchants"] = _with(WAREHOUSE,
                               "SELECT merchant, total_spend, " + MONEY % "total_spend" + " AS total_spend_display, "
                               f"transaction_count FROM (SELECT merchant, {POUNDS} AS total_spend, "
                               "count(transaction_id) AS transaction_count FROM wide WHERE transaction_type = 'debit' "
                               "AND merchant IS NOT NULL GROUP BY merchant) ORDER BY total_spend DESC, merchant LIMIT 10")
    q["parent_category_breakdown"] = _with(WAREHOUSE,
                                           f"SELECT parent_category, {POUNDS} AS amount_gbp FROM wide "
                                           "WHERE transaction_type = 'debit' AND parent_category IS NOT NULL "
                                           "GROUP BY parent_category ORDER BY parent_category")
    q["recent_transactions"] = present(_with(WAREHOUSE,
                                             "SELECT transaction_id, transaction_date, merchant, category_name, "
                                             "CASE WHEN transaction_type = 'credit' THEN '+' ELSE '-' END || "
                                             + MONEY % "amount_gbp" + " AS amount_display FROM wide "
                                             "ORDER BY transaction_date DESC NULLS LAST, transaction_id NULLS LAST LIMIT 20"),
                                       TX_DATES)
    q["day_of_week_spend"] = _with(WAREHOUSE,
                                   f"SELECT day_name, {POUNDS} AS amount_gbp, "
                                   f"CAST(CASE WHEN list_position({DAYS}, day_name) > 0 THEN list_position({DAYS}, day_name) "
                                   "ELSE 8 END AS BIGINT) AS day_order FROM wide "
                                   "WHERE transaction_type = 'debit' AND day_name IS NOT NULL GROUP BY day_name "
                                   "ORDER BY day_order, day_name")
    q["category_distribution"] = _with(RAW, "SELECT category, COUNT(*) AS count, round(AVG(amount), 2) AS avg_amount "
                                            "FROM raw_transactions GROUP BY category ORDER BY count DESC")
    q["rates_flatten"] = _with(RATES, "SELECT rate_date, 'GBP' AS base_currency, target_currency, rate FROM rates_clean "
                                      "WHERE CAST(rate_date AS DATE) >= DATE '2020-01-01' "
                                      "AND target_currency IN ('USD', 'EUR')")
    q["rates_enrich"] = _with(RATES, "SELECT * FROM raw_exchange_rates")
    q["signed_amount_date_parts"] = present(_with(BATCH_RAW,
                                                  "SELECT transaction_id, amount, transaction_type, signed_amount, "
                                                  "transaction_date, transaction_year, transaction_month, "
                                                  "transaction_day_of_week FROM batch_raw"), TX_DATES, PARTS)
    q["stream_parse"] = present(_with(STREAM.split("raw_transactions AS")[0].rstrip().rstrip(","),
                                      "SELECT * EXCLUDE (_ingested_at) FROM stream_raw"), TX_DATES, PARTS)
    q["stream_rejects"] = _with(STREAM.split("raw_transactions AS")[0].rstrip().rstrip(","),
                                "SELECT key, reject_reason AS reason FROM stream_all WHERE reject_reason IS NOT NULL")
    q["stream_ingest"] = present(_with(STREAM.split("raw_transactions AS")[0].rstrip().rstrip(","),
                                       "SELECT DISTINCT * EXCLUDE (_ingested_at) FROM stream_raw"), TX_DATES, PARTS)
    q["stream_dead_letters"], q["stream_state_dedup"] = q["stream_rejects"], q["stream_ingest"]
    q["wide_colocated"] = q["wide_transactions"]
    q["mart_footers"] = _with(WAREHOUSE, """
        SELECT 'fact_transactions' AS table_name, count(*) AS rows, min(transaction_key) AS low, max(transaction_key) AS high
        FROM fact_transactions UNION ALL
        SELECT 'dim_accounts', count(*), min(account_key), max(account_key) FROM dim_accounts UNION ALL
        SELECT 'dim_categories', count(*), min(category_key), max(category_key) FROM dim_categories""")
    q["replace_rates"] = _with(RATES, "SELECT * FROM raw_exchange_rates WHERE _ingested_at = TIMESTAMP '2024-01-01 01:00:00'")
    q["dedup_append"] = present(_with(RAW, "SELECT DISTINCT * FROM stream_raw UNION ALL SELECT * FROM batch_raw"),
                                TX_DATES, PARTS)
    q["publish_messages"] = _with(BATCH_RAW, PUBLISH)
    for name, tests in (("dq_unique", ("unique",)), ("dq_not_null", ("not_null",)),
                        ("dq_accepted_values", ("accepted_values",)),
                        ("dq_relationships", ("relationships",)),
                        ("dq_report", ("unique", "not_null", "accepted_values", "relationships"))):
        q[name] = _with(WAREHOUSE, _dq_sql(tests))
    return q

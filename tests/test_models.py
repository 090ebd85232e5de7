import datetime as dt

from pyspark.sql import functions as F

from finlake.plans import dims, staging
from finlake.schemas import RAW_TRANSACTIONS

D = dt.date
TS = dt.datetime


def _raw(spark, rows):
    base = dict(transaction_id="t", account_id="acc_1", account_name=" Name ", account_type="CURRENT",
                bank_name=" Bank ", currency="usd ", amount=10.0, transaction_type="Debit",
                category=" Groceries ", category_type="Expense", merchant=" M ", description=" d ",
                transaction_date=D(2024, 1, 1), transaction_timestamp=TS(2024, 1, 1, 10),
                _ingested_at=TS(2024, 1, 2), _source="s", signed_amount=-10.0,
                transaction_year=2024, transaction_month=1, transaction_day_of_week=0)
    data = []
    for r in rows:
        x = dict(base, **r)
        data.append(tuple(x[f.name] for f in RAW_TRANSACTIONS.fields))
    return spark.createDataFrame(data, RAW_TRANSACTIONS)


def test_stg_transactions_cleans_and_filters(spark):
    raw = _raw(spark, [dict(transaction_id="a"), dict(transaction_id=None), dict(transaction_id="c", amount=0.0),
                       dict(transaction_id="d", amount=None), dict(transaction_id="e", amount=2.675)])
    out = {r.transaction_id: r for r in staging.stg_transactions(raw).collect()}
    assert set(out) == {"a", "e"}
    a = out["a"]
    assert (a.account_name, a.account_type, a.bank_name, a.currency, a.transaction_type,
            a.category, a.category_type, a.merchant) == \
        ("Name", "current", "Bank", "USD ", "debit", "Groceries", "expense", "M")
    assert str(out["e"].amount) == "2.68"  # half-up cast to decimal(18,2)


def test_stg_exchange_rates(spark):
    rows = [(TS(2024, 1, 1), " gbp ", " usd ", 1.2, 0.833333, TS(2024, 1, 1), "s"),
            (TS(2024, 1, 1), "GBP", "EUR", 0.0, None, TS(2024, 1, 1), "s"),
            (TS(2024, 1, 1), "GBP", "EUR", None, None, TS(2024, 1, 1), "s")]
    df = spark.createDataFrame(rows, "rate_date timestamp_ntz, base_currency string, target_currency string, "
                                     "rate double, inverse_rate double, _ingested_at timestamp_ntz, _source string")
    out = staging.stg_exchange_rates(df).collect()
    assert len(out) == 1
    assert (out[0].rate_date, out[0].base_currency, out[0].target_currency) == (D(2024, 1, 1), "GBP", "USD")


def test_dim_dates(spark):
    dd = dims.dim_dates(spark)
    assert dd.count() == 2922
    r = {x.full_date: x for x in dd.filter(F.col("full_date").isin(D(2021, 1, 1), D(2024, 1, 7),
                                                                   D(2024, 4, 1))).collect()}
    jan1 = r[D(2021, 1, 1)]
    assert (jan1.date_key, jan1.week_of_year, jan1.day_name, jan1.day_of_week) == (20210101, 53, "Friday", 5)
    sun = r[D(2024, 1, 7)]
    assert (sun.day_of_week, sun.is_weekend, sun.fiscal_year, sun.quarter_name) == (0, True, 2023, "Q1")
    apr = r[D(2024, 4, 1)]
    assert (apr.fiscal_year, apr.month_name, apr.month_short, apr.year_month, apr.iso_date) == \
        (2024, "April", "Apr", "2024-04", "2024-04-01")


def test_dim_accounts_smallest_name_and_dense_keys(spark):
    raw = _raw(spark, [dict(transaction_id="1", account_id="acc_2", account_name="Zed"),
                       dict(transaction_id="2", account_id="acc_2", account_name="Amy"),
                       dict(transaction_id="3", account_id="acc_1", account_name=None),
                       dict(transaction_id="4", account_id="acc_1", account_name="Bob")])
    out = dims.dim_accounts(staging.stg_transactions(raw)).orderBy("account_key").collect()
    assert [(r.account_key, r.account_id, r.account_name) for r in out] == [(1, "acc_1", "Bob"), (2, "acc_2", "Amy")]
    assert all(r.is_active for r in out)


def test_dim_categories_mapping_and_order(spark):
    raw = _raw(spark, [dict(transaction_id="1", category="Salary", category_type="income"),
                       dict(transaction_id="2", category="Groceries", category_type="expense"),
                       dict(transaction_id="3", category="groceries", category_type="expense"),
                       dict(transaction_id="4", category="Transport", category_type="expense"),
                       dict(transaction_id="5", category=None, category_type="expense")])
    out = dims.dim_categories(staging.stg_transactions(raw)).orderBy("category_key").collect()
    got = [(r.category_key, r.category_id, r.parent_category, r.budget_category, r.sort_order) for r in out]
    assert got == [(1, "Salary", "Employment Income", "Discretionary", 1),
                   (2, "Groceries", "Essential", "Essential", 5),
                   (3, "Transport", "Transport", "Semi-Essential", 6),
                   (4, "groceries", "Other", "Discretionary", 9)]


def test_rounding_matches_reference_engine_and_pandas(spark):
    import duckdb
    import numpy as np
    from finlake.functions.columns import round_half_away, round_half_even
    vals = [384940.47 / 1.2, -384940.47 / 1.2, 2.675, 1.005, 0.125, -0.125, 1234.565, 1 / 1.2170000000000001]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [(r.a, r.e) for r in df.select(round_half_away("x", 2).alias("a"),
                                         round_half_even("x", 6).alias("e")).collect()]
    con = duckdb.connect()
    want_a = [con.execute("select round(?::DOUBLE, 2)", [v]).fetchone()[0] for v in vals]
    want_e = [float(np.round(v, 6)) for v in vals]
    assert [a for a, _ in got] == want_a
    assert [e for _, e in got] == want_e
    assert got[0][0] == 320783.72   # the double sits just below the decimal tie

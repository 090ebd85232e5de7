"""Stand-in inputs derived from the driver tables.

These functions only shape driver rows into the schemas the jobs consume
(what the reference's generators and API would deliver).  They do none of the
jobs' work: cleaning, conversion, keys and reports all run in ``finlake.plans``
on whatever these return.  The same derivation is written as SQL CTEs in
``finlake.oracle`` for the DuckDB cross-check.

* transactions extract  = orders joined with customer (deliberately dirty)
* exchange-rate extract = weekday order dates (shifted into 2020+) x {USD, EUR}
  from two ingestion runs, with padded codes, zero / null rates and revisions
* rates documents       = one JSON document per month of clean extract rows
* stream messages       = events of five months rendered as JSON messages (defaults,
  four kinds of bad records, duplicates, three timestamp spellings)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.vocab import EXPENSE_CATEGORIES, INCOME_CATEGORIES
from finlake.plans import ingest
from finlake.sources.tables import driver_table

# Shift of the order dates (1995-01-01 -> 2020-01-01).
DATE_SHIFT_DAYS = 9131
RATES_FIRST_DAY = "2020-03-02"
RUN1_AT = dt.datetime(2024, 1, 1, 0, 0, 0)
RUN2_AT = dt.datetime(2024, 1, 1, 1, 0, 0)
STREAM_AT = dt.datetime(2024, 2, 1, 0, 0, 0)
RATE_BASES = [("USD", 1.2), ("EUR", 1.1)]


def transactions_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the transaction generator would emit: 14 columns, dirty on purpose."""
    o = driver_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = driver_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    # customer is not size-bounded: plain join, the planner / AQE pick the strategy
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    k, cust, status = F.col("o_orderkey"), F.col("c_custkey"), F.col("o_orderstatus")
    is_f = status == F.lit("F")
    income = F.array(*[F.lit(x) for x in INCOME_CATEGORIES])
    expense = F.array(*[F.lit(x) for x in EXPENSE_CATEGORIES])
    category = F.when(is_f, F.element_at(income, (k % 4 + 1).cast("int"))).otherwise(
        F.concat(F.lit(" "), F.element_at(expense, (k % 18 + 1).cast("int")), F.lit(" ")))
    merchant = F.concat(F.lit("Merchant "), (k % 97).cast("string"))
    tx_date = F.date_add(F.to_date("o_orderdate"), DATE_SHIFT_DAYS)
    return j.select(
        F.when(k % 103 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("txn_"), k.cast("string"))).alias("transaction_id"),
        F.concat(F.lit("acc_"), cust.cast("string")).alias("account_id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("account_name"),
        F.when(cust % 3 == 0, F.lit("CURRENT")).when(cust % 3 == 1, F.lit("Savings"))
         .otherwise(F.lit("credit")).alias("account_type"),
        F.concat(F.lit(" Bank "), F.col("c_nationkey").cast("string")).alias("bank_name"),
        F.when(cust % 5 == 3, F.lit("usd")).when(cust % 5 == 4, F.lit("EUR"))
         .otherwise(F.lit("GBP")).alias("currency"),
        F.when(k % 101 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("amount"),
        F.when(~is_f, F.lit("debit")).when(k % 2 == 0, F.lit("credit")).otherwise(F.lit("Credit"))
         .alias("transaction_type"),
        category.alias("category"),
        F.when(is_f, F.lit("Income")).otherwise(F.lit("expense")).alias("category_type"),
        merchant.alias("merchant"),
        F.concat(merchant, F.lit(" - "), category).alias("description"),
        F.when(k % 53 != 0, tx_date).alias("transaction_date"),
        (tx_date.cast("timestamp_ntz") + F.make_dt_interval(secs=(k % 86400).cast("int")))
        .alias("transaction_timestamp"),
    )


def batch_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch feed: ingestion transform of the extract (one run)."""
    return ingest.transactions_transform(
        transactions_extract(spark, sf_dir), RUN1_AT, "MockTransactionsIngestion")


def stream_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream feed: good messages as the consumer appends them (no de-duplication)."""
    from finlake.streaming import messages
    return messages.to_raw(stream_messages(spark, sf_dir),
                           ingested_at=F.lit(STREAM_AT).cast("timestamp_ntz"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw.transactions = batch feed + stream feed appended to one table."""
    return batch_transactions(spark, sf_dir).unionByName(stream_transactions(spark, sf_dir))


def _rate_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.date_add(F.to_date("o_orderdate"), DATE_SHIFT_DAYS)
    days = driver_table(spark, sf_dir, "orders").select(d.alias("d")).distinct()
    return days.filter((F.weekday("d") < 5) & (F.col("d") >= F.lit(RATES_FIRST_DAY).cast("date")))


def _base_rate(code: Column, d: Column) -> Column:
    base = F.when(code == F.lit("USD"), F.lit(1.2)).otherwise(F.lit(1.1))
    return base + (F.dayofyear(d) % 50) / F.lit(1000.0)


def rates_clean_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clean row per (weekday, currency): rate_date, target_currency, rate."""
    codes = F.explode(F.array(*[F.lit(c) for c, _ in RATE_BASES])).alias("target_currency")
    rows = _rate_days(spark, sf_dir).select("d", codes)
    return rows.select(
        F.col("d").cast("timestamp_ntz").alias("rate_date"),
        F.col("target_currency"),
        _base_rate(F.col("target_currency"), F.col("d")).alias("rate"))


def rates_run1_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First hourly run: every (weekday, currency), with dirty rows mixed in:
    padded lower-case codes on the 5th (USD), a zero USD rate on the 10th and
    a null EUR rate on the 20th of each month."""
    clean = rates_clean_extract(spark, sf_dir)
    dom = F.dayofmonth("rate_date")
    padded = (dom == 5) & (F.col("target_currency") == F.lit("USD"))
    main = clean.select(
        "rate_date",
        F.when(padded, F.lit(" gbp ")).otherwise(F.lit("GBP")).alias("base_currency"),
        F.when(padded, F.lit(" usd ")).otherwise(F.col("target_currency")).alias("target_currency"),
        "rate")
    zero = clean.filter((dom == 10) & (F.col("target_currency") == F.lit("USD"))).select(
        "rate_date", F.lit("GBP").alias("base_currency"), "target_currency",
        F.lit(0.0).alias("rate"))
    null = clean.filter((dom == 20) & (F.col("target_currency") == F.lit("EUR"))).select(
        "rate_date", F.lit("GBP").alias("base_currency"), "target_currency",
        F.lit(None).cast("double").alias("rate"))
    return main.unionByName(zero).unionByName(null)


def rates_run2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second hourly run: revised rates (+0.005) for the 15th of each month."""
    clean = rates_clean_extract(spark, sf_dir)
    return clean.filter(F.dayofmonth("rate_date") == 15).select(
        "rate_date", F.lit("GBP").alias("base_currency"), "target_currency",
        (F.col("rate") + F.lit(0.005)).alias("rate"))


def raw_exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw.exchange_rates as the two runs would have appended it (lazy form)."""
    run1 = ingest.rates_transform(rates_run1_extract(spark, sf_dir), RUN1_AT)
    return run1.unionByName(ingest.rates_transform(rates_run2_extract(spark, sf_dir), RUN2_AT))


def rates_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per month: {"base": "GBP", "rates": {date: {ccy: rate}}}.

    Bounded per document (<= 31 days x currencies); column ``value``.
    """
    clean = rates_clean_extract(spark, sf_dir).withColumn(
        "day", F.date_format("rate_date", "yyyy-MM-dd"))
    per_day = clean.groupBy("day").agg(
        F.map_from_entries(F.collect_list(F.struct("target_currency", "rate"))).alias("ccy"))
    per_month = per_day.groupBy(F.substring("day", 1, 7).alias("month")).agg(
        F.map_from_entries(F.collect_list(F.struct("day", "ccy"))).alias("rates"))
    return per_month.select(
        "month", F.to_json(F.struct(F.lit("GBP").alias("base"), F.col("rates"))).alias("value"))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (key, value) JSON messages as a producer would publish them.

    Keys absent from a message are built as null struct fields (to_json drops
    them); one family carries an explicit JSON null for ``category``.  Four families
    cannot be read: text that is no JSON, no amount, an amount in quotes, and no
    timestamp but a word.  The events are spread over five months.
    """
    i = F.col("event_id")
    e = driver_table(spark, sf_dir, "events").select(
        "event_id", (F.col("ts") + F.make_dt_interval(days=(i % 5 * 30).cast("int"))).alias("ts"), "user_id",
        "event_type", "value")
    signup = F.col("event_type") == F.lit("signup")

    def absent_if(cond: Column, val: Column) -> Column:
        return F.when(cond, F.lit(None)).otherwise(val)

    explicit_null_cat = (i % 17 == 0) & (i % 13 != 0) & ~signup
    form = i % 3
    ts_text = F.when(form == 0, _iso(F.col("ts"))) \
        .when(form == 1, F.concat(_iso(F.col("ts")), F.lit("Z"))) \
        .otherwise(F.concat(_iso(F.col("ts")), F.lit("+01:00")))
    ts_text = F.when(i % 89 == 0, F.lit("soon")).otherwise(ts_text)
    merchant = F.concat(F.lit("Shop "), (F.col("user_id") % 20).cast("string"))
    msg = F.struct(
        F.concat(F.lit("evt_"), i.cast("string")).alias("transaction_id"),
        F.concat(F.lit("acc_"), F.col("user_id").cast("string")).alias("account_id"),
        absent_if(i % 3 == 0, F.concat(F.lit("User "), F.col("user_id").cast("string"))).alias("account_name"),
        absent_if(i % 8 == 0, F.lit("savings")).alias("account_type"),
        F.when(i % 5 == 3, F.lit("USD")).when(i % 5 == 4, F.lit("EUR"))
         .when(i % 5 == 0, F.lit(None)).otherwise(F.lit("GBP")).alias("currency"),
        absent_if(i % 97 == 0, F.when(i % 7 == 0, -F.col("value")).otherwise(F.col("value"))).alias("amount"),
        absent_if(i % 11 == 0, F.when(signup, F.lit("credit")).otherwise(F.lit("debit"))).alias("transaction_type"),
        F.when(signup, F.lit("income")).when((i % 13 == 0) | explicit_null_cat, F.lit(None))
         .otherwise(F.col("event_type")).alias("category"),
        absent_if(i % 4 == 0, merchant).alias("merchant"),
        absent_if(i % 6 == 0, F.concat(F.lit("Event "), F.col("event_type"))).alias("description"),
        F.date_format("ts", "yyyy-MM-dd").alias("transaction_date"),
        ts_text.alias("transaction_timestamp"),
        _iso(F.col("ts")).alias("event_time"),
    )
    body = F.to_json(msg)
    body = F.when(explicit_null_cat, F.concat(F.lit('{"category":null,'), F.substr(body, F.lit(2)))) \
        .otherwise(body)
    quoted = F.regexp_replace(body, r'"amount":([^,]+)', r'"amount":"$1"')
    body = F.when(i % 83 == 0, quoted).otherwise(body)
    value = F.when(i % 101 == 0, F.concat(F.lit("{not json "), i.cast("string"))).otherwise(body)
    msgs = e.select(F.concat(F.lit("acc_"), F.col("user_id").cast("string")).alias("key"),
                    value.alias("value"), "event_id", "ts")
    # every 50th event is delivered twice
    return msgs.unionByName(msgs.filter(F.col("event_id") % 50 == 0))

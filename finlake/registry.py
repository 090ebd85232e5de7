"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables of ``sf_dir`` (directly or through the
raw tables the library's ingestion jobs land from them) and runs the whole
tables through the library's operators.

Presentation for the cross-engine check: DATE columns are shown as
TIMESTAMP (midnight), DECIMAL columns, the fact's nullable foreign keys and the
parts of nullable dates as DOUBLE, identically in ``finlake.oracle``; audit columns holding the current
time are left out.
The library functions themselves keep the reference's types.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.operators.quality import PER_ROW, run_checks
from finlake.operators.ranges import dense_key
from finlake.plans import checks, conversion, dims, ingest, reports, staging, warehouse
from finlake.session import configure, scratch_dir
from finlake.sinks.files import Files
from finlake.sinks.tables import load
from finlake.sources import landing, rates_json
from finlake.sources import standins as S
from finlake.sources.tables import footer_stats, read_table
from finlake.streaming import consumer, messages, producer

AUDIT = ("created_at", "updated_at", "_created_at")


NULLABLE_PARTS = ("transaction_year", "transaction_month", "transaction_day_of_week", "year_number")


def present(df: DataFrame, as_double: tuple[str, ...] = NULLABLE_PARTS) -> DataFrame:
    """``as_double``: integer columns that can hold nulls (left-join keys, parts of a
    null date) — a client would otherwise get a float column from one engine and a nullable
    integer column from the other."""
    cols = []
    for f in df.schema.fields:
        if f.name in AUDIT:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType) or f.name in as_double:
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


FACT_NULLABLE_KEYS = ("date_key", "account_key", "category_key")


def _raw_tx(spark, sf):
    return landing.raw_transactions(spark, sf)


def _raw_rates(spark, sf):
    return landing.raw_exchange_rates(spark, sf)


def _wh(spark, sf, with_fact_key=True) -> warehouse.Warehouse:
    configure(spark)
    return warehouse.build(_raw_tx(spark, sf), _raw_rates(spark, sf), with_fact_key=with_fact_key)


def _stg(spark, sf):
    configure(spark)
    return staging.stg_transactions(_raw_tx(spark, sf))


def q_stg_transactions(spark, sf):
    return present(_stg(spark, sf))


def q_stg_exchange_rates(spark, sf):
    configure(spark)
    return present(staging.stg_exchange_rates(_raw_rates(spark, sf)))


def q_int_transactions_with_gbp(spark, sf):
    return present(_wh(spark, sf).int_transactions_with_gbp)


def q_asof_interval(spark, sf):
    """As-of match alone: latest GBP rate on or before each foreign transaction's date
    (null when the currency has no earlier rate)."""
    configure(spark)
    stg_tx = _stg(spark, sf)
    stg_rates = staging.stg_exchange_rates(_raw_rates(spark, sf))
    foreign = stg_tx.filter(F.col("currency") != F.lit("GBP")) \
        .select("transaction_id", "currency", "transaction_date")
    j = conversion.latest_rates(foreign, stg_rates)
    return present(j.select(
        "transaction_id", "currency", "transaction_date",
        F.col("_rate").cast("double").alias("rate"), "exchange_rate_date"))


def q_dim_dates_in_use(spark, sf):
    """The date dimension rows of every date carrying a transaction."""
    configure(spark)
    used = _stg(spark, sf).select(F.col("transaction_date").alias("full_date")).distinct()
    dd = dims.dim_dates(spark)
    return present(dd.join(used, "full_date", "left_semi").select(*dd.columns), ())


def q_dim_accounts(spark, sf):
    return present(dims.dim_accounts(_stg(spark, sf)))


def q_dim_categories(spark, sf):
    return present(dims.dim_categories(_stg(spark, sf)))


def q_fact_transactions(spark, sf):
    return present(_wh(spark, sf).fact_transactions, FACT_NULLABLE_KEYS)


def q_surrogate_key(spark, sf):
    """KEY1 on staged transactions: dense keys in (timestamp, id) order."""
    stg = _stg(spark, sf).select("transaction_id", "transaction_timestamp")
    return dense_key(stg, ["transaction_timestamp", "transaction_id"], "transaction_key")


class _Marts:
    def __init__(self, tables: dict[str, DataFrame]):
        self.__dict__.update(tables)


def _marts(spark, sf):
    """Reports read the materialised marts, as the reference dashboard does."""
    m = _Marts(landing.marts(spark, sf))
    return m, m.fact_transactions


def q_wide_transactions(spark, sf):
    m, fact = _marts(spark, sf)
    return present(reports.wide_transactions(fact, m.dim_accounts, m.dim_categories, m.dim_dates))


def q_wide_colocated(spark, sf):
    """The same report over a fact and an account dimension that are bucketed for each other."""
    configure(spark)
    name = "finlake_colocated_" + landing.app_id(spark).replace("-", "_").lower()
    m = warehouse.save_colocated(landing.marts(spark, sf), name, f"{scratch_dir(spark, 'colocated')}",
                                 int(spark.conf.get("spark.sql.shuffle.partitions")))
    return present(reports.wide_transactions(m["fact_transactions"], m["dim_accounts"], m["dim_categories"],
                                             m["dim_dates"]))


def q_mart_footers(spark, sf):
    """Row counts and key ranges of the keyed marts, from their Parquet footers."""
    configure(spark)
    folders = landing.mart_folders(spark, sf)
    keys = {"fact_transactions": "transaction_key", "dim_accounts": "account_key", "dim_categories": "category_key"}
    return functools.reduce(DataFrame.unionByName, [
        footer_stats(spark, folders[t], [k]).select(F.lit(t).alias("table_name"), "rows", F.col(f"min_{k}").alias("low"),
                                                    F.col(f"max_{k}").alias("high")) for t, k in keys.items()])


def q_replace_rates(spark, sf):
    """Replace load: the first rates run, replaced by the second, then by an empty one (which
    leaves it); the target is versioned and read through its current version."""
    configure(spark)
    target = f"{scratch_dir(spark, 'replace_rates')}/raw_exchange_rates"
    second = ingest.rates_transform(S.rates_run2_extract(spark, sf), S.RUN2_AT)
    load(ingest.rates_transform(S.rates_run1_extract(spark, sf), S.RUN1_AT), target, mode="replace", versioned=True)
    load(second, target, mode="replace")
    load(second.filter("rate < 0"), target, mode="replace")
    return read_table(spark, target)


def q_summary_stats(spark, sf):
    _, fact = _marts(spark, sf)
    return reports.summary_stats(fact)


def q_net_position(spark, sf):
    _, fact = _marts(spark, sf)
    return reports.net_position(fact)


def q_spend_by_category(spark, sf):
    wh, fact = _marts(spark, sf)
    return reports.spend_by_category(fact, wh.dim_categories)


def q_daily_totals(spark, sf):
    _, fact = _marts(spark, sf)
    return present(reports.daily_totals(fact))


def q_top_merchants(spark, sf):
    _, fact = _marts(spark, sf)
    return reports.top_merchants(fact)


def q_parent_category_breakdown(spark, sf):
    wh, fact = _marts(spark, sf)
    return reports.parent_category_breakdown(fact, wh.dim_categories)


def q_recent_transactions(spark, sf):
    wh, fact = _marts(spark, sf)
    return present(reports.recent_transactions(fact, wh.dim_categories))


def q_day_of_week_spend(spark, sf):
    wh, fact = _marts(spark, sf)
    return reports.day_of_week_spend(fact, wh.dim_dates)


def q_category_distribution(spark, sf):
    configure(spark)
    return reports.category_distribution(_raw_tx(spark, sf))


def q_rates_flatten(spark, sf):
    """Monthly rates documents -> parse -> flatten, all dates, USD and EUR."""
    configure(spark)
    docs = rates_json.parse_documents(S.rates_documents(spark, sf))
    return rates_json.flatten_rates(docs, "GBP", ["USD", "EUR"], "2020-01-01", "9999-12-31")


def q_rates_enrich(spark, sf):
    """Both extract runs through the rates ingestion transform (inverse, rounding, stamps)."""
    configure(spark)
    run1 = ingest.rates_transform(S.rates_run1_extract(spark, sf), S.RUN1_AT)
    return run1.unionByName(ingest.rates_transform(S.rates_run2_extract(spark, sf), S.RUN2_AT))


def q_signed_amount_date_parts(spark, sf):
    configure(spark)
    b = S.batch_transactions(spark, sf)
    return present(b.select("transaction_id", "amount", "transaction_type", "signed_amount",
                            "transaction_date", "transaction_year", "transaction_month",
                            "transaction_day_of_week"))


def q_stream_parse(spark, sf):
    """Message -> raw row (batch mode over the whole message set), good rows only."""
    configure(spark)
    parsed = messages.parse(S.stream_messages(spark, sf))
    return present(messages.valid_rows(parsed).drop("_ingested_at"))


def q_stream_rejects(spark, sf):
    configure(spark)
    parsed = messages.parse(S.stream_messages(spark, sf).select("key", "value"))
    return messages.rejected_rows(parsed).select("key", "reason")


INBOX_FILES = 6
INBOX_ROWS = 100_000  # messages per file


def _inbox(spark, sf, root: str) -> tuple[str, int]:
    """The messages as a folder of files, dealt by the whole message; ``INBOX_FILES`` of them or the
    multiple that the number of messages needs.  Folder and number of files."""
    path = f"{root}/inbox"
    msgs = S.stream_messages(spark, sf).select("key", "value")
    files = INBOX_FILES * max(1, -(-msgs.count() // (INBOX_FILES * INBOX_ROWS)))
    msgs.repartition(files, "key", "value").write.parquet(path)
    return path, files


def _lose_last_commit(spark, checkpoint: str) -> None:
    """Leave a checkpoint as a crash does that comes after a micro-batch's writes and before the
    query's own commit: the query will replay its last epoch."""
    files = Files(spark, checkpoint)
    last = max(int(n) for n in files.names(f"{checkpoint}/commits") if n.isdigit())
    files.delete(f"{checkpoint}/commits/{last}")


def _ingest_with_replays(spark, sf) -> tuple[str, str]:
    """The consumer over three micro-batches, its last one replayed after a lost commit; then a
    second query that reads the whole inbox again in another split.  Raw table and dead letters."""
    configure(spark)
    root = scratch_dir(spark, "stream_ingest")
    inbox, files = _inbox(spark, sf, root)
    target, dead = f"{root}/raw_transactions", f"{root}/dead_letter"
    keyed = {"dedupe_keys": ["transaction_id"], "partition_by": ["transaction_year", "transaction_month"]}
    once = f"{root}/checkpoint"
    for _ in range(2):
        consumer.drain(consumer.file_message_stream(spark, inbox, files // 3), target, once,
                       dead_letter_target=dead, **keyed)
        _lose_last_commit(spark, once)
    consumer.drain(consumer.file_message_stream(spark, inbox, files // 2), target, f"{root}/second", **keyed)
    return target, dead


def q_stream_ingest(spark, sf):
    """Available-now consumer with exact de-duplication through the key index, over three
    micro-batches, with a replayed epoch and a second query that reads every message again;
    the target is partitioned by transaction year / month and read back."""
    return present(spark.read.parquet(_ingest_with_replays(spark, sf)[0]).drop("_ingested_at"))


def q_stream_dead_letters(spark, sf):
    """The dead letters of the first query of ``stream_ingest``: each once, replay or not."""
    return spark.read.parquet(_ingest_with_replays(spark, sf)[1]).select("key", "reason")


def q_stream_state_dedup(spark, sf):
    """The consumer with de-duplication in the state store over three micro-batches, its last one
    replayed after a lost commit; every message comes within the delay."""
    configure(spark)
    root = scratch_dir(spark, "stream_state")
    inbox, files = _inbox(spark, sf, root)
    target, chk = f"{root}/raw_transactions", f"{root}/checkpoint"
    for _ in range(2):
        consumer.finish(*consumer.start_with_state(consumer.file_message_stream(spark, inbox, files // 3),
                                                   target, chk, "1 day"))
        _lose_last_commit(spark, chk)
    return present(spark.read.parquet(target).drop("_ingested_at"))


def q_dedup_append(spark, sf):
    """Idempotent append: the stream feed, then a replay of the whole raw table."""
    configure(spark)
    target = f"{scratch_dir(spark, 'dedup_append')}/raw_transactions"
    load(S.stream_transactions(spark, sf), target, mode="append", dedupe_keys=["transaction_id"])
    load(_raw_tx(spark, sf), target, mode="append", dedupe_keys=["transaction_id"])
    return present(spark.read.parquet(target))


def q_publish_messages(spark, sf):
    """The batch feed rendered as keyed JSON messages (key/value frame)."""
    configure(spark)
    return producer.to_messages(S.batch_transactions(spark, sf))


def _dq(tests):
    def run(spark, sf):
        """Declared checks over the raw tables, the staging / intermediate views
        and the materialised marts (the reference tests after building).  What the
        landing and the mart build counted while writing is not scanned for again."""
        wh = _wh(spark, sf)
        tables = {name: getattr(wh, name) for name in warehouse.MODELS if name not in warehouse.MARTS}
        tables.update(landing.marts(spark, sf))
        logged = landing.logged_failures(spark, sf) if set(tests) & set(PER_ROW) else None
        return run_checks(tables, checks.DECLARED, tests, logged)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_transactions": q_stg_transactions,
    "stg_exchange_rates": q_stg_exchange_rates,
    "asof_interval": q_asof_interval,
    "int_transactions_with_gbp": q_int_transactions_with_gbp,
    "dim_dates_in_use": q_dim_dates_in_use,
    "dim_accounts": q_dim_accounts,
    "dim_categories": q_dim_categories,
    "fact_transactions": q_fact_transactions,
    "surrogate_key": q_surrogate_key,
    "wide_transactions": q_wide_transactions,
    "wide_colocated": q_wide_colocated,
    "mart_footers": q_mart_footers,
    "replace_rates": q_replace_rates,
    "summary_stats": q_summary_stats,
    "net_position": q_net_position,
    "spend_by_category": q_spend_by_category,
    "daily_totals": q_daily_totals,
    "top_merchants": q_top_merchants,
    "parent_category_breakdown": q_parent_category_breakdown,
    "recent_transactions": q_recent_transactions,
    "day_of_week_spend": q_day_of_week_spend,
    "category_distribution": q_category_distribution,
    "rates_flatten": q_rates_flatten,
    "rates_enrich": q_rates_enrich,
    "signed_amount_date_parts": q_signed_amount_date_parts,
    "stream_parse": q_stream_parse,
    "stream_rejects": q_stream_rejects,
    "stream_ingest": q_stream_ingest,
    "stream_dead_letters": q_stream_dead_letters,
    "stream_state_dedup": q_stream_state_dedup,
    "dedup_append": q_dedup_append,
    "publish_messages": q_publish_messages,
    "dq_unique": _dq(("unique",)),
    "dq_not_null": _dq(("not_null",)),
    "dq_accepted_values": _dq(("accepted_values",)),
    "dq_relationships": _dq(("relationships",)),
    "dq_report": _dq(("unique", "not_null", "accepted_values", "relationships")),
}

# Queries without a SQL oracle (checked on row counts only).
ROWS_ONLY: tuple[str, ...] = ()

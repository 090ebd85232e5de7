"""Land the raw tables from the driver tables, through the library's own jobs.

``raw.transactions`` and ``raw.exchange_rates`` are what the reference's
ingestion writes.  Here they are produced the same way, once per session and
input folder, under the shared ``spark.checkpoint.dir``:

1. batch feed: transactions extract -> ``plans.ingest.run`` (append);
2. stream feed: messages landed as a key/value file stream -> the streaming
   consumer (available-now, no de-duplication, dead letters kept aside);
3. rates: two hourly extract runs -> ``plans.ingest.run`` (append).

Queries then read Parquet tables (lineage cut), like the reference's models
read its raw schema.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.plans import checks, ingest
from finlake.session import app_id, configure, scratch_dir
from finlake.sinks import check_log
from finlake.sources import standins as S
from finlake.sources.tables import table_exists
from finlake.streaming import consumer

INBOX_FILES = 64  # files per micro-batch: bounds what the consumer keeps parsed

_LOCK = threading.RLock()
_LANDED: dict[tuple[str, str], dict[str, str]] = {}
_MARTS: dict[tuple[str, str], str] = {}


def land(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Paths of the landed raw tables for ``sf_dir`` (created on first use)."""
    configure(spark)
    key = (app_id(spark), os.path.abspath(sf_dir))
    with _LOCK:
        paths = _LANDED.get(key)
        if paths and all(table_exists(spark, p) for p in paths.values()):
            return paths
        root = scratch_dir(spark, "landing")
        paths = {
            "transactions": f"{root}/raw/transactions",
            "exchange_rates": f"{root}/raw/exchange_rates",
            "rejected_messages": f"{root}/raw/rejected_messages",
        }
        ingest.run(S.transactions_extract(spark, sf_dir),
                   [lambda df: ingest.transactions_transform(df, S.RUN1_AT)],
                   paths["transactions"], mode="append", ingested_at=S.RUN1_AT,
                   observed=checks.of("raw_transactions"))
        inbox = f"{root}/inbox/messages"
        S.stream_messages(spark, sf_dir).select("key", "value").write.mode("overwrite").parquet(inbox)
        consumer.drain(consumer.file_message_stream(spark, inbox, INBOX_FILES), paths["transactions"],
                       f"{root}/checkpoints/consumer",
                       dead_letter_target=paths["rejected_messages"],
                       ingested_at=F.lit(S.STREAM_AT).cast("timestamp_ntz"),
                       checks=checks.of("raw_transactions"))
        ingest.run(S.rates_run1_extract(spark, sf_dir),
                   [lambda df: ingest.rates_transform(df, S.RUN1_AT)],
                   paths["exchange_rates"], mode="append", ingested_at=S.RUN1_AT,
                   observed=checks.of("raw_exchange_rates"))
        ingest.run(S.rates_run2_extract(spark, sf_dir),
                   [lambda df: ingest.rates_transform(df, S.RUN2_AT)],
                   paths["exchange_rates"], mode="append", ingested_at=S.RUN2_AT,
                   observed=checks.of("raw_exchange_rates"))
        _LANDED[key] = paths
        return paths


def marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The marts built from the landed raw tables and written once per session
    (the reference's model build); dashboards and checks read these tables."""
    from finlake.plans import warehouse

    return warehouse.read_marts(spark, _mart_root(spark, sf_dir))


def mart_folders(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    from finlake.plans import warehouse

    return warehouse.mart_folders(spark, _mart_root(spark, sf_dir))


def logged_failures(spark: SparkSession, sf_dir: str) -> dict[str, dict[str, int]]:
    """Per table the check counts that the landing and the mart build logged."""
    paths = land(spark, sf_dir)
    folders = {"raw_transactions": paths["transactions"], "raw_exchange_rates": paths["exchange_rates"],
               **mart_folders(spark, sf_dir)}
    return {t: check_log.failures(spark, f) for t, f in folders.items()}


def _mart_root(spark: SparkSession, sf_dir: str) -> str:
    from finlake.plans import warehouse

    configure(spark)
    key = (app_id(spark), os.path.abspath(sf_dir))
    with _LOCK:
        root = _MARTS.get(key)
        if root is None or not all(table_exists(spark, f) for f in warehouse.mart_folders(spark, root).values()):
            root = scratch_dir(spark, "marts")
            wh = warehouse.build(raw_transactions(spark, sf_dir), raw_exchange_rates(spark, sf_dir))
            warehouse.materialise(wh, root)
            _MARTS[key] = root
        return root


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(land(spark, sf_dir)["transactions"])


def raw_exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(land(spark, sf_dir)["exchange_rates"])


def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(land(spark, sf_dir)["rejected_messages"])

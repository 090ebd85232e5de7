"""Publishing transactions as keyed JSON messages (SNK6, re-aimed write path).

The reference simulator invents transactions and sends them one by one; here
any DataFrame of transactions is rendered to the topic's ``key``/``value``
frame on the executors and written in bulk (Kafka sink, or files for tests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions import columns as C
from finlake.sources.kafka import kafka_write


def _iso(ts) -> F.Column:
    # Python isoformat(): microseconds only when non-zero
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == F.lit("000000"), whole).otherwise(F.concat(whole, F.lit("."), micros))


def to_messages(tx: DataFrame, event_time: str = "transaction_timestamp") -> DataFrame:
    """Transactions -> (key = account_id, value = JSON message)."""
    ts = F.col("transaction_timestamp")
    msg = F.struct(
        "transaction_id", "account_id", "account_name", "account_type", "currency", "amount",
        "transaction_type", "category", "merchant",
        F.concat(F.col("merchant"), F.lit(" - "), C.title_case("category")).alias("description"),
        F.date_format(ts, "yyyy-MM-dd").alias("transaction_date"),
        _iso(ts).alias("transaction_timestamp"),
        _iso(F.col(event_time)).alias("event_time"),
    )
    return tx.select(F.col("account_id").alias("key"), F.to_json(msg).alias("value"))


def publish(tx: DataFrame, target: str = "kafka", **opts) -> None:
    """Write the message frame to Kafka (``target='kafka'``) or to a Parquet path."""
    frame = to_messages(tx)
    if target == "kafka":
        kafka_write(frame, **opts)
    else:
        frame.write.mode("append").parquet(target)

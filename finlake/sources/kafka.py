"""Kafka source / sink options (SRC6, SNK6).

The connector jar is not part of every installation; these functions only
build the reader / writer.  Consumer-group semantics map to the streaming
checkpoint (offsets are committed there, not to the broker).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_options(bootstrap_servers: str, topic: str = "transactions", starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True,
                 group_id: str | None = None) -> dict[str, str]:
    """Options of the stream reader.  ``group_id`` names the consumer group to the broker (quotas,
    monitoring); offsets are committed to the checkpoint all the same."""
    out = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
           "startingOffsets": starting_offsets, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if group_id:
        out["kafka.group.id"] = group_id
    return out


def write_options(bootstrap_servers: str, topic: str = "transactions") -> dict[str, str]:
    """Options of the writer: acknowledged by all replicas, three retries, as the reference's producer."""
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic,
            "kafka.acks": "all", "kafka.retries": "3"}


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    """The topic as a key/value stream; ``options`` are those of ``read_options``."""
    reader = spark.readStream.format("kafka").options(**read_options(**options))
    return reader.load().select(F.col("key").cast("string").alias("key"),
                                F.col("value").cast("string").alias("value"))


def kafka_write(frame: DataFrame, **options) -> None:
    """Publish a key/value frame; ``options`` are those of ``write_options``."""
    (frame.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
     .write.format("kafka").options(**write_options(**options)).save())

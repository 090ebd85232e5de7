"""Streaming ingest of transaction messages (SNK5, STR5-STR9).

``readStream`` (Kafka, or a file stream of the same ``key``/``value`` frame)
-> ``foreachBatch``: each micro-batch is parsed statelessly
(``finlake.streaming.messages``, persisted for the split), good rows are
appended to raw.transactions and bad rows to a dead-letter table.  A batch of
more than ``ROWS_PER_PART`` messages is dealt out in parts of that size before: parsed rows
are many times their file's size, and what a task keeps must not follow the files' sizes.

Offsets live in the checkpoint, so a restarted query resumes where it stopped and
replays at most its last micro-batch.  Both outputs of a micro-batch are one entry
of the commit ledger beside the raw table, keyed by the query's identity and the
epoch: a replay writes good rows, rows without a key and dead letters exactly
once, wherever the crash came.

Repeated *messages* are a matter of de-duplication:

* ``dedupe_keys``: every micro-batch is compared with the key index of the whole
  table, so a message that comes again is found however late, and whatever query
  or checkpoint reads it;
* ``start_with_state``: Spark's state store remembers the keys of a bounded time
  (``withWatermark`` + ``dropDuplicatesWithinWatermark``).  The cost per batch
  depends on that time, not on the table.

Triggers: ``available_now=True`` drains what is there and stops (the
reference's bounded run); otherwise a processing-time trigger runs forever.
Micro-batch size is bounded by ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``
on the source (the reference's ``batch_size``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from finlake.operators.quality import Check
from finlake.sinks import tables as sink
from finlake.sinks.key_index import KEY, key_of
from finlake.sinks.ledger import Ledger, stream_id
from finlake.sources.kafka import kafka_stream
from finlake.streaming import messages

MESSAGE_FRAME = "key STRING, value STRING"
SEEN_AT = "_seen_at"
ROWS_PER_PART = 100_000  # messages that one task parses and keeps


def file_message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                        fmt: str = "parquet") -> DataFrame:
    """A file stream with the Kafka-like ``key``/``value`` frame (used where no broker exists)."""
    reader = spark.readStream.format(fmt).schema(MESSAGE_FRAME)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def message_stream(spark: SparkSession, source: str = "kafka", **opts) -> DataFrame:
    """``source='kafka'`` (needs the Kafka connector on the classpath) or a file path.
    Options are those of ``kafka_stream`` / ``file_message_stream``; an unknown one is an error."""
    if source == "kafka":
        return kafka_stream(spark, **opts)
    return file_message_stream(spark, source, **opts)


def write_batch(batch: DataFrame, raw_target: str, dead_letter_target: str | None,
                dedupe_keys: Sequence[str] | None = None,
                ingested_at: Column | None = None,
                partition_by: Sequence[str] | None = None, checks: Sequence[Check] = (),
                query: str | None = None, epoch_id: int = 0) -> dict[str, int]:
    """One micro-batch: parse, split, append.  Returns rows written per output.

    The same (``query``, ``epoch_id``) is written once; without a query the batch
    is taken as a new one."""
    spark = batch.sparkSession
    ledger = Ledger(spark, f"{sink.table_folder(spark, raw_target)}/_ledger")
    parsed = messages.parse(_dealt(batch), ingested_at=ingested_at).persist()
    try:
        outputs = [sink.Output("good", messages.valid_rows(parsed), raw_target, dedupe_keys, partition_by,
                               checks)]
        if dead_letter_target:
            outputs.append(sink.Output("rejected", messages.rejected_rows(parsed), dead_letter_target))
        return sink.append_once(ledger, query or f"batch-{uuid.uuid4().hex}", epoch_id, outputs)
    finally:
        parsed.unpersist()


def _dealt(batch: DataFrame) -> DataFrame:
    """The messages of a batch in parts of ``ROWS_PER_PART``, however they came; a small batch as it is."""
    rows = batch.count()
    return batch.repartition(-(-rows // ROWS_PER_PART)) if rows > ROWS_PER_PART else batch


def start(stream: DataFrame, raw_target: str, checkpoint: str,
          dead_letter_target: str | None = None, dedupe_keys: Sequence[str] | None = None,
          available_now: bool = True, processing_time: str = "10 seconds",
          ingested_at: Column | None = None, query_name: str | None = None,
          partition_by: Sequence[str] | None = None, checks: Sequence[Check] = ()) -> StreamingQuery:
    """Start the consumer.

    ``dedupe_keys`` (e.g. ``["transaction_id"]``): duplicates inside a batch are
    dropped, and keys that the table's index holds.  ``partition_by`` lays out a
    new raw table, e.g. by transaction year and month.  A catalog table has to
    exist before the stream starts.  ``checks`` are counted as rows are written.
    """

    def _fn(batch: DataFrame, epoch_id: int) -> None:
        write_batch(batch, raw_target, dead_letter_target, dedupe_keys, ingested_at, partition_by, checks,
                    stream_id(batch.sparkSession, checkpoint), epoch_id)

    return _run(stream.writeStream.foreachBatch(_fn), checkpoint, available_now, processing_time, query_name)


def start_with_state(stream: DataFrame, raw_target: str, checkpoint: str, delay: str,
                     dead_letter_target: str | None = None, keys: Sequence[str] = ("transaction_id",),
                     time_column: str = "_ingested_at", available_now: bool = True,
                     processing_time: str = "10 seconds", ingested_at: Column | None = None,
                     partition_by: Sequence[str] | None = None) -> list[StreamingQuery]:
    """Start the consumer with de-duplication in the state store; the table is never read.

    A row is dropped when one with the same key came within ``delay`` before it, by
    ``time_column``; a repeat that comes later is written again.  Rows with a null key
    are known by their whole content.

    ``time_column="_ingested_at"`` is the time of arrival: no row is ever late.  With an
    event time (``"transaction_timestamp"``) rows older than the watermark, the newest
    event time less ``delay`` as of the batch before the last, are late: Spark cannot
    tell any more whether they are repeats and leaves them out; the query's progress
    counts them as ``numRowsDroppedByWatermark``.

    Messages that do not parse need no state: a second query over the same stream takes
    them to ``dead_letter_target`` (checkpoint ``<checkpoint>-rejected``).  Both write
    through the ledger, exactly once; the queries are returned."""
    parsed = messages.parse(stream, ingested_at=ingested_at)
    good = messages.valid_rows(parsed)
    first = (good.withColumn(KEY, key_of(good.columns, keys))
             .withColumn(SEEN_AT, F.col(time_column).cast("timestamp"))
             .withWatermark(SEEN_AT, delay).dropDuplicatesWithinWatermark([KEY]).drop(KEY, SEEN_AT))
    outputs = [(first, "good", raw_target, partition_by, checkpoint)]
    if dead_letter_target:
        outputs.append((messages.rejected_rows(parsed), "rejected", dead_letter_target, None,
                        f"{checkpoint.rstrip('/')}-rejected"))
    return [_run(rows.writeStream.foreachBatch(_appender(name, target, parts, raw_target, at)),
                 at, available_now, processing_time, None) for rows, name, target, parts, at in outputs]


def _appender(name: str, target: str, partition_by: Sequence[str] | None, raw_target: str, checkpoint: str):
    def _fn(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        ledger = Ledger(spark, f"{sink.table_folder(spark, raw_target)}/_ledger")
        query = stream_id(spark, checkpoint)
        replay = ledger.state(query, epoch_id) is not None
        sink.append_once(ledger, query, epoch_id, [sink.Output(name, batch, target, None, partition_by)])
        if replay:  # nothing is written again, but the state of the batch has to be
            batch.write.format("noop").mode("append").save()
    return _fn


def _run(writer: DataStreamWriter, checkpoint: str, available_now: bool, processing_time: str,
         query_name: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime=processing_time)
    return writer.start()


def finish(*queries: StreamingQuery) -> None:
    """Wait for available-now queries; the first failure is raised."""
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def drain(stream: DataFrame, raw_target: str, checkpoint: str, **kw) -> None:
    """Run an available-now consumer to completion (bounded run)."""
    finish(start(stream, raw_target, checkpoint, available_now=True, **kw))

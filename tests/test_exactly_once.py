"""Ledger, key index and state-store de-duplication: batches, crashes, replays, late rows."""
import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from finlake.sinks import key_index
from finlake.sinks import tables as sink
from finlake.sinks.key_index import KEY, KeyIndex
from finlake.sinks.ledger import Ledger, stream_id
from finlake.sources.kafka import read_options, write_options
from finlake.sources.tables import row_count, table_exists
from finlake.streaming import consumer, messages

FIRST = {"transaction_id": "p0", "account_id": "acc", "amount": 4.25, "transaction_type": "debit",
         "transaction_timestamp": "2024-03-01T08:00:00"}


def frame(spark, *msgs):
    return spark.createDataFrame([("k", m if isinstance(m, str) else json.dumps(m)) for m in msgs],
                                 "key string, value string")


def batch(spark):
    """Four keys (one repeated), two different rows without a key, three dead letters."""
    return frame(spark, *[dict(FIRST, transaction_id=f"p{i}") for i in (0, 1, 2, 3, 1)],
                 dict(FIRST, transaction_id=None, merchant="x"), dict(FIRST, transaction_id=None, merchant="y"),
                 "{oops", dict(FIRST, amount="5"), dict(FIRST, transaction_timestamp="soon"))


def held(spark, raw, dead):
    good = Counter((r.transaction_id, r.merchant) for r in spark.read.parquet(raw).collect())
    return good, Counter(r.reason for r in spark.read.parquet(dead).collect())


WANT = (Counter([("p0", "Unknown"), ("p1", "Unknown"), ("p2", "Unknown"), ("p3", "Unknown"), (None, "x"), (None, "y")]),
        Counter(["malformed_json", "invalid_amount", "invalid_timestamp"]))


class Crash(RuntimeError):
    pass


@pytest.mark.parametrize("point", ["staging", "prepare", "moving", "marking"])
def test_a_replay_after_any_crash_leaves_every_row_once(spark, tmp_path, monkeypatch, point):
    raw, dead = str(tmp_path / "raw"), str(tmp_path / "dead")

    def write(epoch):
        return consumer.write_batch(batch(spark), raw, dead, ["transaction_id"], query="q", epoch_id=epoch)

    with monkeypatch.context() as m:
        moved = []
        if point == "staging":  # the first output is staged, the second is not
            whole = sink._stage
            m.setattr(sink, "_stage", lambda *a: (_ for _ in ()).throw(Crash()) if a[3].name == "rejected" else whole(*a))
        elif point == "prepare":
            m.setattr(Ledger, "prepare", lambda *a: (_ for _ in ()).throw(Crash()))
        elif point == "moving":  # between the two tables
            move = sink.Ledger(spark, raw).files.__class__.move

            def stop(self, source, target):
                if len(moved) >= 2:
                    raise Crash()
                moved.append(target)
                move(self, source, target)
            m.setattr(sink.Ledger(spark, raw).files.__class__, "move", stop)
        else:
            m.setattr(Ledger, "_write", lambda self, name, *a, w=Ledger._write: (
                (_ for _ in ()).throw(Crash()) if "/done/" in name else w(self, name, *a)))
        with pytest.raises(Crash):
            write(7)
    if point in ("staging", "prepare"):
        assert not table_exists(spark, raw) and not table_exists(spark, dead)
    for _ in range(3):
        assert write(7)["rejected"] == 3
        assert held(spark, raw, dead) == WANT
    # the same messages as a later batch: no row again, dead letters are another batch's
    assert write(8)["good"] == 0
    assert held(spark, raw, dead) == (WANT[0], WANT[1] + WANT[1])
    ledger = Ledger(spark, f"{raw}/_ledger")
    assert ledger.recover() == 0 and sorted(r.epoch for r in ledger.table().collect()) == [7, 8]


def test_a_crashed_batch_counts_when_another_query_writes(spark, tmp_path, monkeypatch):
    raw, dead = str(tmp_path / "raw"), str(tmp_path / "dead")
    with monkeypatch.context() as m:
        m.setattr(Ledger, "publish", lambda *a: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            consumer.write_batch(batch(spark), raw, dead, ["transaction_id"], query="a", epoch_id=0)
    consumer.write_batch(batch(spark), raw, None, ["transaction_id"], query="b", epoch_id=0)
    assert held(spark, raw, dead) == WANT


def test_writers_that_finish_one_batch_together(spark, tmp_path, monkeypatch):
    """Several writers meet one prepared batch: each of its files is moved once."""
    from concurrent.futures import ThreadPoolExecutor
    raw, dead = str(tmp_path / "raw"), str(tmp_path / "dead")
    for epoch in range(3):
        with monkeypatch.context() as m:
            m.setattr(Ledger, "publish", lambda *a: (_ for _ in ()).throw(Crash()))
            with pytest.raises(Crash):
                msgs = [dict(FIRST, transaction_id=f"e{epoch}m{i}") for i in range(40)]
                consumer.write_batch(frame(spark, *msgs, "{bad").repartition(12), raw, dead, query="q", epoch_id=epoch)
        with ThreadPoolExecutor(6) as pool:
            list(pool.map(lambda _: Ledger(spark, f"{raw}/_ledger").recover(), range(6)))
        assert spark.read.parquet(raw).count() == 40 * (epoch + 1) and spark.read.parquet(dead).count() == epoch + 1
        assert Ledger(spark, f"{raw}/_ledger").state("q", epoch) == "done" and Ledger(spark, f"{raw}/_ledger").idle()


def lose_last_commit(checkpoint):
    """What a crash after the batch's writes and before the stream's own commit leaves behind."""
    last = max((n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()), key=int)
    for n in (last, f".{last}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{n}"):
            os.remove(f"{checkpoint}/commits/{n}")
    return int(last)


def test_stream_in_any_split_with_a_lost_commit(spark, tmp_path):
    inbox, raw, dead = (str(tmp_path / n) for n in ("inbox", "raw", "dead"))
    every = batch(spark).collect()
    for i in range(3):
        spark.createDataFrame(every[i::3], "key string, value string").coalesce(1).write.mode("append").parquet(inbox)
    one = str(tmp_path / "one")
    run = lambda files, chk, letters: consumer.drain(
        consumer.file_message_stream(spark, inbox, files), raw, chk, dead_letter_target=letters,
        dedupe_keys=["transaction_id"], partition_by=["transaction_year", "transaction_month"])
    run(1, one, dead)
    assert lose_last_commit(one) == 2
    run(1, one, dead)
    assert held(spark, raw, dead) == WANT
    assert Ledger(spark, f"{raw}/_ledger").state(stream_id(spark, one), 2) == "done"
    run(2, str(tmp_path / "two"), None)  # another query, another split
    assert held(spark, raw, dead) == WANT


def test_append_shuffles_the_batch_and_never_the_index(spark, tmp_path):
    target = str(tmp_path / "t")
    KeyIndex(spark, target, ["id"], buckets=4).create(0)
    sink.load(spark.range(1000).selectExpr("id", "id * 2 AS v"), target, dedupe_keys=["id"])
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        index = KeyIndex.of(spark, target)
        new = index.new_rows(spark.range(900, 1100).selectExpr("id", "id * 2 AS v"))
        assert new.count() == 100
        plan = new._jdf.queryExecution().executedPlan().toString()
        tree = new._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "LeftAnti" in plan and "Bucketed: true" in plan
    # one exchange only, the batch's, and the scan reads the key column alone
    initial = plan.split("Initial Plan")[-1] if "Initial Plan" in plan else plan
    assert initial.count("Exchange hashpartitioning") == 1, plan
    assert f"ReadSchema: struct<{KEY}:string>" in tree


def test_rows_without_a_key_are_known_by_their_content(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.createDataFrame([(None, "a"), (None, "b"), (None, "a"), (1, "c")], "id bigint, v string")
    assert sink.load(rows, target, dedupe_keys=["id"]) == 3
    assert sink.load(rows, target, dedupe_keys=["id"]) == 0
    assert sink.load(rows.withColumn("id", F.lit(2).cast("bigint")), target, dedupe_keys=["id"]) == 1


def test_index_of_a_table_that_was_loaded_without_one(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.range(10).selectExpr("id", "id % 3 AS v")
    sink.load(rows, target)
    sink.load(rows, target)  # plain appends repeat rows
    assert sink.load(rows.unionByName(spark.range(10, 12).selectExpr("id", "id % 3 AS v")), target, dedupe_keys=["id"]) == 2
    assert sink.load(spark.range(20, 25).selectExpr("id", "id % 3 AS v"), target) == 5  # a plain append is indexed, too
    assert sink.load(spark.range(20, 26).selectExpr("id", "id % 3 AS v"), target, dedupe_keys=["id"]) == 1
    assert row_count(spark, target) == 28
    with pytest.raises(ValueError, match="indexed by"):
        sink.load(rows, target, dedupe_keys=["v"])


def test_compaction_keeps_every_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "KEYS_PER_BUCKET", 50)
    target = str(tmp_path / "t")
    for i in range(4):
        sink.load(spark.range(i * 50, i * 50 + 60).selectExpr("id", "id AS v"), target, dedupe_keys=["id"])
    index = KeyIndex.of(spark, target)
    files = lambda: len(list(index.files.data_files(index.location)))
    before = index.read().count()
    assert index.buckets == 2 < files() and index.compact(1)
    assert index.buckets == 5 >= files() and index.read().count() == before == 210
    assert KeyIndex.of(spark, target).version == 1
    assert sink.load(spark.range(0, 211).selectExpr("id", "id AS v"), target, dedupe_keys=["id"]) == 1


def test_catalog_table_with_an_index(spark):
    rows = spark.range(6).selectExpr("id AS payment", "cast(id % 3 AS int) AS month")
    try:
        assert sink.load(rows.filter("payment < 0"), "index_test.payments", dedupe_keys=["payment"]) == 0
        assert sink.load(rows, "index_test.payments", dedupe_keys=["payment"], partition_by=["month"]) == 6
        more = spark.range(9).selectExpr("id AS payment", "cast(id % 4 AS int) AS month")
        assert sink.load(more, "index_test.payments", dedupe_keys=["payment"]) == 3
        assert row_count(spark, "index_test.payments") == 9
        assert spark.table("index_test.payments").filter("month = 3").count() == 1  # payment 7
    finally:
        spark.sql("DROP SCHEMA IF EXISTS index_test CASCADE")


@pytest.mark.parametrize("keys", [None, ["id"]])
def test_first_load_into_a_folder_without_files(spark, tmp_path, keys):
    target = tmp_path / "t"
    attempt = target / "_temporary" / "0" / "_temporary" / "attempt_0"
    attempt.mkdir(parents=True)
    (attempt / "part-0.parquet").write_bytes(b"half")
    assert not table_exists(spark, str(target)) and row_count(spark, str(target)) == 0
    assert sink.load(spark.range(3).selectExpr("id", "id AS v"), str(target), dedupe_keys=keys) == 3
    assert row_count(spark, str(target)) == 3


def test_files_per_partition_are_bounded(spark, tmp_path):
    """One hot month and sixty small ones from many tasks: small months get one file."""
    rows = spark.range(0, 60_000, 1, 16).selectExpr("id", "cast(if(id % 3 = 0, 0, id % 61) AS int) AS month")
    for name, keys in (("plain", None), ("indexed", ["id"])):
        target = str(tmp_path / name)
        assert sink.load(rows, target, dedupe_keys=keys, partition_by=["month"]) == 60_000
        files = Counter(f.split("month=")[1].split("/")[0] for f in spark.read.parquet(target).inputFiles())
        assert len(files) == 61 and all(n == 1 for m, n in files.items() if m != "0")


def state_messages(spark, inbox, *batches):
    for msgs in batches:
        frame(spark, *msgs).coalesce(1).write.mode("append").parquet(inbox)


def test_state_store_drops_repeats_without_reading_the_table(spark, tmp_path):
    inbox, raw, dead, chk = (str(tmp_path / n) for n in ("inbox", "raw", "dead", "chk"))
    five = [dict(FIRST, transaction_id=f"s{i}") for i in range(5)]
    none = dict(FIRST, transaction_id=None)
    state_messages(spark, inbox, [*five, none], [*five, five[0], "{bad"], [*five[2:], none, dict(FIRST, transaction_id="s9")])
    run = lambda: consumer.finish(*consumer.start_with_state(
        consumer.file_message_stream(spark, inbox, 1), raw, chk, "1 hour", dead))
    run()
    want = Counter([*(f"s{i}" for i in range(5)), "s9", None])
    assert Counter(r.transaction_id for r in spark.read.parquet(raw).collect()) == want
    assert KeyIndex.of(spark, raw) is None  # no index, nothing of the target is read
    assert lose_last_commit(chk) >= 2 and lose_last_commit(f"{chk}-rejected") >= 2
    run()  # replayed epochs are in the ledger
    state_messages(spark, inbox, [five[4], dict(FIRST, transaction_id="s10")])
    run()  # and the state outlives a restart
    assert Counter(r.transaction_id for r in spark.read.parquet(raw).collect()) == want + Counter(["s10"])
    assert [r.reason for r in spark.read.parquet(dead).collect()] == ["malformed_json"]


def test_state_store_on_event_time_leaves_late_rows_out(spark, tmp_path):
    inbox, raw, chk = (str(tmp_path / n) for n in ("inbox", "raw", "chk"))
    at = lambda i, t: dict(FIRST, transaction_id=i, transaction_timestamp=f"2024-03-01T{t}:00")
    state_messages(spark, inbox, [at("a", "08:00"), at("b", "12:00")], [at("c", "11:30")],
                   [at("a", "11:50"), at("b", "12:01"), at("old", "09:00")])
    queries = consumer.start_with_state(consumer.file_message_stream(spark, inbox, 1), raw, chk, "1 hour",
                                        time_column="transaction_timestamp")
    consumer.finish(*queries)
    got = Counter(r.transaction_id for r in spark.read.parquet(raw).collect())
    # "old" is before the watermark (11:00): late, left out and counted.  The repeat of "a" came more than
    # an hour after the first one, whose key is forgotten, so it is written again.
    assert got == Counter({"a": 2, "b": 1, "c": 1})
    dropped = [s["numRowsDroppedByWatermark"] for p in queries[0].recentProgress for s in p["stateOperators"]]
    assert sum(dropped) == 1


def test_stream_options():
    got = read_options("b:9092", topic="t", max_offsets_per_trigger=10, group_id="g", fail_on_data_loss=False)
    assert got == {"kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "earliest",
                   "failOnDataLoss": "false", "maxOffsetsPerTrigger": "10", "kafka.group.id": "g"}
    assert "kafka.group.id" not in read_options("b:9092")
    assert write_options("b:9092")["kafka.acks"] == "all"


def test_misspelt_stream_options_are_errors(spark, tmp_path):
    with pytest.raises(TypeError):
        consumer.message_stream(spark, str(tmp_path), max_file_per_trigger=2)


def test_valid_rows_match_a_batch_parse(spark):
    assert messages.valid_rows(messages.parse(batch(spark))).count() == 7

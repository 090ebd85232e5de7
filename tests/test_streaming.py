import json


from finlake.streaming import consumer, messages, producer


def _msgs(spark, *values):
    return spark.createDataFrame([(f"k{i}", v if isinstance(v, str) else json.dumps(v))
                                  for i, v in enumerate(values)], "key string, value string")


BASE = {"transaction_id": "t1", "account_id": "a1", "amount": -12.5,
        "transaction_timestamp": "2024-01-01T00:30:00+01:00"}


def test_defaults_nulls_and_sign(spark):
    df = _msgs(spark, BASE,
               dict(BASE, transaction_id="t2", transaction_type="debit", category=None, currency="USD"),
               dict(BASE, transaction_id="t3", transaction_type="credit", category="income"))
    out = {r.transaction_id: r for r in messages.to_raw(df).collect()}
    t1 = out["t1"]
    # missing keys take defaults; missing type -> 'debit' with a positive signed amount (kept defect)
    assert (t1.account_name, t1.account_type, t1.bank_name, t1.currency, t1.transaction_type,
            t1.category, t1.category_type, t1.merchant, t1.description) == \
        ("Streaming Account", "current", "Digital Bank", "GBP", "debit", "other", "expense", "Unknown", "")
    assert (t1.amount, t1.signed_amount) == (12.5, 12.5)
    # explicit null stays null; explicit debit is negative
    assert out["t2"].category is None and out["t2"].category_type == "expense"
    assert out["t2"].signed_amount == -12.5 and out["t2"].currency == "USD"
    assert out["t3"].category_type == "income" and out["t3"].signed_amount == 12.5
    # date as written in its own offset; instant stored as UTC wall clock
    assert str(t1.transaction_date) == "2024-01-01"
    assert str(t1.transaction_timestamp) == "2023-12-31 23:30:00"
    assert t1.transaction_day_of_week == 0 and t1._source == "KafkaConsumer"


def test_rejects_have_reasons(spark):
    df = _msgs(spark, "{not json", {"account_id": "a", "amount": 1, "transaction_timestamp": "2024-01-01"},
               dict(BASE, amount="5"), dict(BASE, transaction_timestamp="yesterday"), BASE)
    parsed = messages.parse(df)
    assert messages.valid_rows(parsed).count() == 1
    reasons = sorted(r.reason for r in messages.rejected_rows(parsed).collect())
    assert reasons == ["invalid_amount", "invalid_timestamp", "malformed_json", "missing_required"]


def test_consumer_replay_and_restart(spark, tmp_path):
    inbox, target, dead = str(tmp_path / "inbox"), str(tmp_path / "raw"), str(tmp_path / "dead")
    msgs = [dict(BASE, transaction_id=f"t{i}") for i in range(5)]
    _msgs(spark, *msgs, msgs[0], "{bad").write.mode("append").parquet(inbox)
    ckpt = str(tmp_path / "ckpt")
    consumer.drain(consumer.file_message_stream(spark, inbox), target, ckpt,
                   dead_letter_target=dead, dedupe_keys=["transaction_id"])
    assert spark.read.parquet(target).count() == 5
    assert spark.read.parquet(dead).count() == 1
    # restart with the same checkpoint: nothing new
    consumer.drain(consumer.file_message_stream(spark, inbox), target, ckpt,
                   dead_letter_target=dead, dedupe_keys=["transaction_id"])
    assert spark.read.parquet(target).count() == 5
    # new file with one new and two known ids
    _msgs(spark, msgs[1], msgs[2], dict(BASE, transaction_id="t9")).write.mode("append").parquet(inbox)
    consumer.drain(consumer.file_message_stream(spark, inbox), target, ckpt,
                   dead_letter_target=dead, dedupe_keys=["transaction_id"])
    assert spark.read.parquet(target).count() == 6
    # a replay from scratch (new checkpoint) writes nothing twice
    consumer.drain(consumer.file_message_stream(spark, inbox), target, str(tmp_path / "ckpt2"),
                   dedupe_keys=["transaction_id"])
    assert spark.read.parquet(target).count() == 6


def test_stream_equals_batch(spark, tmp_path):
    inbox, target = str(tmp_path / "inbox"), str(tmp_path / "raw")
    df = _msgs(spark, *[dict(BASE, transaction_id=f"t{i}", amount=i + 0.5) for i in range(20)])
    df.write.parquet(inbox)
    consumer.drain(consumer.file_message_stream(spark, inbox), target, str(tmp_path / "c"))
    cols = [c for c in spark.read.parquet(target).columns if c != "_ingested_at"]
    streamed = spark.read.parquet(target).select(cols)
    batch = messages.to_raw(df).select(cols)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_producer_round_trip(spark):
    df = messages.to_raw(_msgs(spark, dict(BASE, category="groceries", merchant="Shop", account_name="N",
                                           account_type="current", currency="GBP", transaction_type="debit")))
    frame = producer.to_messages(df)
    r = frame.first()
    assert r.key == "a1"
    m = json.loads(r.value)
    assert m["description"] == "Shop - Groceries" and m["transaction_timestamp"] == "2023-12-31T23:30:00"
    back = messages.to_raw(frame).first()
    assert back.transaction_id == "t1" and back.amount == 12.5


def test_title_case_matches_python(spark):
    from finlake.functions.columns import title_case
    words = ["rent/mortgage", "TfL/Oyster", "health & fitness", "2nd go", "", None, "o'neil", "été/hiver"]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r[0] for r in df.select(title_case("s")).collect()]
    assert got == [w.title() if w is not None else None for w in words]


def test_processing_time_consumer_picks_up_new_files(spark, tmp_path):
    inbox, target = str(tmp_path / "inbox"), str(tmp_path / "raw")
    _msgs(spark, *[dict(BASE, transaction_id=f"a{i}") for i in range(3)]).write.mode("append").parquet(inbox)
    q = consumer.start(consumer.file_message_stream(spark, inbox), target, str(tmp_path / "c"),
                       dedupe_keys=["transaction_id"], available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        _msgs(spark, *[dict(BASE, transaction_id=f"b{i}") for i in range(2)]).write.mode("append").parquet(inbox)
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(target).count() == 5


def test_landing_is_once_per_session(spark):
    from finlake.sources import landing
    sf = "/root/testdata/sf0.001"
    first = landing.land(spark, sf)
    assert landing.land(spark, sf) == first
    raw = landing.raw_transactions(spark, sf)
    assert {r._source for r in raw.select("_source").distinct().collect()} == \
        {"MockTransactionsIngestion", "KafkaConsumer"}
    assert landing.rejected_messages(spark, sf).count() > 0


def test_message_stream_and_publish_to_files(spark, tmp_path):
    src = messages.to_raw(_msgs(spark, *[dict(BASE, transaction_id=f"p{i}") for i in range(4)]))
    inbox = str(tmp_path / "inbox")
    producer.publish(src, inbox)                     # key/value frame written as Parquet
    target = str(tmp_path / "raw")
    consumer.drain(consumer.message_stream(spark, inbox), target, str(tmp_path / "c"))
    back = spark.read.parquet(target)
    assert sorted(r.transaction_id for r in back.collect()) == [f"p{i}" for i in range(4)]


def test_timestamps_must_be_full_iso(spark):
    from finlake.streaming import messages
    bad = ["2024", "2024-01", "2024-1-5", "2024-01-05 10:00:00 UTC"]
    good = ["2024-01-05T10:00:00", "2024-01-05T10:00:00.123456+00:00", "2024-01-05"]
    rows = [(t, '{"transaction_id":"t","account_id":"a","amount":1.0,"transaction_type":"debit",'
                f'"category":"c","merchant":"m","transaction_timestamp":"{t}"}}') for t in bad + good]
    parsed = messages.parse(spark.createDataFrame(rows, "key string, value string"))
    got = {r.key: r._reject_reason for r in parsed.select("key", "_reject_reason").collect()}
    assert all(got[t] == "invalid_timestamp" for t in bad)
    assert not any(got[t] == "invalid_timestamp" for t in good)


def test_a_large_batch_is_dealt_out(spark, tmp_path, monkeypatch):
    """What one task parses and keeps does not follow the size of the files that the messages came in."""
    monkeypatch.setattr(consumer, "ROWS_PER_PART", 10, raising=False)
    msgs = [dict(BASE, transaction_id=f"t{i}") for i in range(95)]
    batch = _msgs(spark, *msgs, "{bad").coalesce(1)
    target, dead = str(tmp_path / "raw"), str(tmp_path / "dead")
    assert consumer.write_batch(batch, target, dead) == {"good": 95, "rejected": 1}
    raw = spark.read.parquet(target)
    assert {r.transaction_id for r in raw.select("transaction_id").collect()} == {f"t{i}" for i in range(95)}
    sizes = [r["count"] for r in raw.groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 12
    assert [r.key for r in spark.read.parquet(dead).collect()] == ["k95"]


def test_inbox_files_follow_the_messages(spark, tmp_path, monkeypatch):
    from finlake import registry

    rows = spark.createDataFrame([(f"k{i % 7}", f"m{i}") for i in range(500)], "key string, value string")
    monkeypatch.setattr(registry.S, "stream_messages", lambda *_: rows)
    monkeypatch.setattr(registry, "INBOX_ROWS", 20, raising=False)
    path, files = registry._inbox(spark, "", str(tmp_path))
    inbox = spark.read.parquet(path)
    sizes = [r["count"] for r in inbox.groupBy("_metadata.file_path").count().collect()]
    assert files == 30 and sum(sizes) == 500 and max(sizes) <= 60
    monkeypatch.setattr(registry, "INBOX_ROWS", 1000)
    assert registry._inbox(spark, "", str(tmp_path / "few"))[1] == registry.INBOX_FILES

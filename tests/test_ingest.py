import datetime as dt

import pytest
from pyspark.sql import functions as F

from finlake.plans import ingest
from finlake.sinks import tables as sink
from finlake.sources.tables import row_count, table_exists

AT = dt.datetime(2024, 1, 1, 12, 0, 0)


def payments(spark, first, last):
    """Payments ``first`` to ``last``, one a day, of three branches."""
    return spark.range(first, last + 1).selectExpr(
        "id AS payment", "date_add(date'2023-11-28', cast(id AS int)) AS paid_on",
        "element_at(array('north', 'south', 'west'), cast(id % 3 AS int) + 1) AS branch")


def paid(spark, target):
    return sorted(r.payment for r in spark.read.parquet(target).collect())


def test_stamp_adds_metadata(spark):
    out = ingest.stamp(payments(spark, 1, 5), AT, "branch feed").collect()
    assert {(r._source, r._ingested_at) for r in out} == {("branch feed", AT)} and len(out) == 5


def test_replaced_then_appended_by_branch(spark, tmp_table):
    """A replace first makes the table, later loads keep its folders; a second replace drops all before."""
    assert sink.load(payments(spark, 10, 40), tmp_table, mode="replace", partition_by=["branch"]) == 31
    assert sink.load(payments(spark, 41, 44), tmp_table) == 4
    assert paid(spark, tmp_table) == list(range(10, 45))
    west = spark.read.parquet(tmp_table).filter("branch = 'west'")
    assert sorted(r.payment for r in west.collect()) == [n for n in range(10, 45) if n % 3 == 2]
    assert sink.load(payments(spark, 1, 2), tmp_table, mode="replace", partition_by=["branch"]) == 2
    assert paid(spark, tmp_table) == [1, 2]


def test_nothing_to_load(spark, tmp_table):
    nothing = payments(spark, 1, 9).filter("paid_on IS NULL")
    assert [sink.load(nothing, tmp_table, mode=m) for m in ("append", "replace")] == [0, 0]
    assert not table_exists(spark, tmp_table)
    sink.load(payments(spark, 1, 9), tmp_table)
    assert sink.load(nothing, tmp_table, mode="replace") == 0
    assert row_count(spark, tmp_table) == 9


def test_empty_first_load_leaves_another_feed_alone(spark, tmp_table):
    feed = spark.range(7).selectExpr("id AS payment", "id % 2 AS odd")
    sink.load(feed, tmp_table)
    assert sink.load(feed.filter("payment < 0"), tmp_table) == 0
    assert row_count(spark, tmp_table) == 7


def test_catalog_table_makes_its_schema_and_keeps_its_partitions(spark):
    feed = spark.range(6).selectExpr("id AS payment", "cast(id % 3 AS int) AS month")
    try:
        assert sink.load(feed, "ledger_test.payments", partition_by=["month"]) == 6
        assert sink.load(feed, "ledger_test.payments") == 6
        assert row_count(spark, "ledger_test.payments") == 12
        assert [c.name for c in spark.catalog.listColumns("ledger_test.payments") if c.isPartition] == ["month"]
    finally:
        spark.sql("DROP SCHEMA IF EXISTS ledger_test CASCADE")


def test_append_is_by_name_with_schema_check(spark, tmp_table):
    sink.load(payments(spark, 1, 3), tmp_table)
    assert sink.load(payments(spark, 4, 6).select("branch", "payment", "paid_on"), tmp_table) == 3
    assert paid(spark, tmp_table) == [1, 2, 3, 4, 5, 6]
    for wrong in (payments(spark, 7, 7).withColumn("extra", F.lit(1)), payments(spark, 7, 7).drop("paid_on"),
                  payments(spark, 7, 7).withColumn("payment", F.col("payment").cast("string"))):
        with pytest.raises(sink.SchemaMismatch):
            sink.load(wrong, tmp_table)


def test_idempotent_append(spark, tmp_table):
    twice = payments(spark, 1, 3).unionByName(payments(spark, 1, 3))
    assert sink.load(twice, tmp_table, dedupe_keys=["payment"]) == 3
    assert sink.load(payments(spark, 3, 5), tmp_table, dedupe_keys=["payment"]) == 2
    assert sink.load(twice, tmp_table, dedupe_keys=["payment"]) == 0
    assert paid(spark, tmp_table) == [1, 2, 3, 4, 5]


def test_null_keys_are_known_by_their_content(spark, tmp_table):
    rows = payments(spark, 1, 4).withColumn("payment", F.when(F.col("payment") > 2, F.col("payment")))
    assert sink.load(rows, tmp_table, dedupe_keys=["payment"]) == 4
    assert sink.load(rows, tmp_table, dedupe_keys=["payment"]) == 0
    assert sink.load(rows.withColumn("branch", F.lit("east")), tmp_table, dedupe_keys=["payment"]) == 2


def test_run_returns_stats(spark, tmp_table):
    stats = ingest.run(payments(spark, 1, 3), [lambda d: ingest.stamp(d, AT, "T")], tmp_table, ingested_at=AT)
    assert set(stats) == {"table", "rows_extracted", "rows_loaded", "ingested_at", "duration_seconds"}
    assert stats["rows_extracted"] == 3 and stats["rows_loaded"] == 3
    assert stats["ingested_at"] == AT.isoformat()
    empty = ingest.run(payments(spark, 3, 2), [], tmp_table + "2")
    assert empty["rows_loaded"] == 0 and empty["rows_extracted"] == 0


def test_transactions_transform_signed_amount_and_date_parts(spark):
    rows = [("t1", 10.0, "credit", dt.date(2024, 1, 1)),   # Monday
            ("t2", 5.5, "debit", dt.date(2024, 1, 7)),     # Sunday
            ("t3", 2.0, None, dt.date(2023, 12, 31))]
    df = spark.createDataFrame(rows, "transaction_id string, amount double, transaction_type string, "
                                     "transaction_date date")
    for c in ["account_id", "account_name", "account_type", "bank_name", "currency", "category",
              "category_type", "merchant", "description"]:
        df = df.withColumn(c, F.lit("x"))
    df = df.withColumn("transaction_timestamp", F.col("transaction_date").cast("timestamp_ntz"))
    out = {r.transaction_id: r for r in ingest.transactions_transform(df, AT).collect()}
    assert out["t1"].signed_amount == 10.0 and out["t2"].signed_amount == -5.5
    assert out["t3"].signed_amount == -2.0  # null type counts as a debit
    assert (out["t1"].transaction_year, out["t1"].transaction_month,
            out["t1"].transaction_day_of_week) == (2024, 1, 0)
    assert out["t2"].transaction_day_of_week == 6


def test_rates_transform_inverse_and_rounding(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "GBP", "USD", 1.25),
                                (dt.datetime(2024, 1, 1), "GBP", "EUR", 1.123456789),
                                (dt.datetime(2024, 1, 1), "GBP", "JPY", 0.0)],
                               "rate_date timestamp_ntz, base_currency string, target_currency string, rate double")
    out = {r.target_currency: r for r in ingest.rates_transform(df, AT).collect()}
    assert out["USD"].inverse_rate == 0.8
    assert out["EUR"].rate == 1.123457 and out["EUR"].inverse_rate == round(1 / 1.123456789, 6)
    assert out["JPY"].inverse_rate is None
    assert out["USD"]._source == "ExchangeRatesIngestion"


def test_ingest_exchange_rates_job(spark, tmp_path):
    import json
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.json").write_text(json.dumps({"base": "GBP", "rates": {"2024-01-01": {"USD": 1.25, "EUR": 1.1}}}))
    target = str(tmp_path / "rates")
    stats = ingest.ingest_exchange_rates(spark, str(docs), target, start_date="2024-01-01",
                                         end_date="2024-01-31", ingested_at=AT)
    assert stats["rows_loaded"] == 2
    rows = {r.target_currency: r for r in spark.read.parquet(target).collect()}
    assert rows["USD"].inverse_rate == 0.8 and rows["USD"]._ingested_at == AT


def test_scoped_dedupe_on_partitioned_target(spark, tmp_table):
    rows = [(1, "a", 2024, 1), (2, "b", 2024, 1), (3, "c", 2024, 2)]
    df = spark.createDataFrame(rows, "id bigint, value string, y int, m int")
    assert sink.load(df, tmp_table, partition_by=["y", "m"]) == 3
    again = spark.createDataFrame([(1, "a", 2024, 1), (3, "c", 2024, 2), (4, "d", 2024, 3)],
                                  "id bigint, value string, y int, m int")
    assert sink.load(again, tmp_table, dedupe_keys=["id"], dedupe_scope=["y", "m"]) == 1
    out = spark.read.parquet(tmp_table)
    assert sorted(r.id for r in out.collect()) == [1, 2, 3, 4]
    import os
    assert os.path.isdir(os.path.join(tmp_table, "y=2024", "m=3"))


def test_ingest_transactions_job_and_sample(spark, tmp_path):
    from finlake.sources import standins as S
    from finlake.sources.tables import sample
    extract = S.transactions_extract(spark, "/root/testdata/sf0.001")
    target = str(tmp_path / "raw")
    stats = ingest.ingest_transactions(extract, target, dedupe_keys=["transaction_id"], ingested_at=AT)
    n = extract.count()
    assert extract.filter("transaction_id is null").count() > 0
    assert stats["rows_extracted"] == n and stats["rows_loaded"] == n
    again = ingest.ingest_transactions(extract, target, dedupe_keys=["transaction_id"], ingested_at=AT)
    assert again["rows_loaded"] == 0  # rows without a key are known by their content
    assert sample(spark, target).count() == 5
    assert row_count(spark, target) == n


def test_replace_emptied_by_a_transform_keeps_the_table(spark, tmp_table):
    sink.load(payments(spark, 1, 7), tmp_table)
    stats = ingest.run(payments(spark, 8, 9), [lambda d: d.filter("branch = 'east'")], tmp_table, mode="replace")
    assert stats["rows_loaded"] == 0 and stats["rows_extracted"] == 2
    assert row_count(spark, tmp_table) == 7


def test_one_id_in_two_months_is_one_row_in_any_split(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z")], "id bigint, month int, v string")
    whole, split = str(tmp_path / "whole"), str(tmp_path / "split")
    sink.load(rows, whole, dedupe_keys=["id"])
    for m in (1, 2):
        sink.load(rows.filter(f"month = {m}"), split, dedupe_keys=["id"])
    read = lambda p: sorted(map(tuple, spark.read.parquet(p).collect()))
    assert read(whole) == read(split) == [(1, 1, "x"), (2, 1, "z")]


def test_scoped_replay_of_a_null_scope_writes_nothing_twice(spark, tmp_table):
    df = spark.createDataFrame([("a", None, 1.0), ("b", 2024, 2.0)], "id string, y int, v double")
    assert sink.load(df, tmp_table, dedupe_keys=["id"], dedupe_scope=["y"]) == 2
    assert sink.load(df, tmp_table, dedupe_keys=["id"], dedupe_scope=["y"]) == 0

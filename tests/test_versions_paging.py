"""Versioned replaces, keyset pages, footer counts, the co-located layout, zero rates and the as-of split."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from finlake.operators import asof
from finlake.plans import conversion, reports, warehouse
from finlake.sinks import tables as sink
from finlake.sinks.versions import Versions, resolve
from finlake.sources import landing
from finlake.sources import standins as S
from finlake.sources.tables import footer_stats, read_table, row_count, table_exists

SF = "/root/testdata/sf0.001"


def days(spark, first, last):
    return spark.range(first, last).selectExpr("id", "date_add(date'2024-01-01', cast(id AS int)) AS day", "cast(id % 2 AS int) AS side")


def test_a_reader_sees_old_rows_or_new_ones(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    assert sink.load(days(spark, 0, 5), target, mode="replace", versioned=True) == 5
    old = read_table(spark, target)
    whole = sink._write

    def watched(df, folder, *rest):
        """While the new version is written, and after it is but before the switch."""
        assert read_table(spark, target).count() == 5
        n = whole(df, folder, *rest)
        assert read_table(spark, target).count() == 5
        return n
    with monkeypatch.context() as m:
        m.setattr(sink, "_write", watched)
        assert sink.load(days(spark, 10, 13), target, mode="replace") == 3
    assert sorted(r.id for r in read_table(spark, target).collect()) == [10, 11, 12]
    assert sorted(r.id for r in old.collect()) == [0, 1, 2, 3, 4]  # a running reader keeps its version
    for i in range(3):
        sink.load(days(spark, i, i + 1), target, mode="replace")
    assert len(os.listdir(f"{target}/_versions")) == 2  # swept
    assert sink.load(days(spark, 0, 0), target, mode="replace") == 0 and row_count(spark, target) == 1


def test_a_crash_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    sink.load(days(spark, 0, 5), target, mode="replace", versioned=True)
    with monkeypatch.context() as m:
        m.setattr(Versions, "switch", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            sink.load(days(spark, 7, 9), target, mode="replace")
    assert row_count(spark, target) == 5


def test_appends_follow_the_version(spark, tmp_path):
    target = str(tmp_path / "t")
    sink.load(days(spark, 0, 4), target, mode="replace", versioned=True, partition_by=["side"])
    assert sink.load(days(spark, 4, 6), target) == 2
    assert sink.load(days(spark, 0, 8), target, dedupe_keys=["id"]) == 2
    assert row_count(spark, target) == 8 and table_exists(spark, target)
    assert {d for d in os.listdir(resolve(spark, target)) if "=" in d} == {"side=0", "side=1"}
    sink.load(days(spark, 0, 1), target, mode="replace")  # the index went with the old version
    assert sink.load(days(spark, 0, 3), target, dedupe_keys=["id"]) == 2


def test_marts_switch_together(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "marts")
    wh = warehouse.build(S.raw_transactions(spark, SF), S.raw_exchange_rates(spark, SF))
    counts = warehouse.materialise(wh, root)
    first = warehouse.mart_folders(spark, root)
    seen = []
    write = warehouse.write_mart

    def watched(df, folder, *rest, **kw):
        n = write(df, folder, *rest, **kw)
        seen.append({m: f.count() for m, f in warehouse.read_marts(spark, root).items()})
        return n
    monkeypatch.setattr(warehouse, "write_mart", watched)
    some = warehouse.build(S.raw_transactions(spark, SF).filter("transaction_id LIKE '%1'"), S.raw_exchange_rates(spark, SF))
    again = warehouse.materialise(some, root)
    assert seen == [counts] * 4  # every moment of the build showed the whole old build
    now = warehouse.mart_folders(spark, root)
    assert now != first and {m: spark.read.parquet(f).count() for m, f in now.items()} == again
    assert again["fact_transactions"] < counts["fact_transactions"]


FACT = [("2024-01-03", "b", 7), ("2024-01-03", "b", 2), ("2024-01-03", None, 4), ("2024-01-03", None, 1), ("2024-01-05", "a", 3),
        (None, "z", 5), (None, None, 6), (None, "z", 9), ("2024-01-01", "c", 8), ("2024-01-03", "a", 10)]


@pytest.mark.parametrize("size", [1, 2, 3, 10, 50])
def test_pages_concatenate_to_the_whole_report(spark, size):
    fact = spark.createDataFrame(FACT, "transaction_date string, transaction_id string, transaction_key long") \
        .withColumn("transaction_date", F.to_date("transaction_date"))
    got = [tuple(r) for p in reports.pages(fact, size) for r in p]
    want = sorted(FACT, key=lambda r: (r[0] is None, -int((r[0] or "0").replace("-", "")), r[1] is None, r[1] or "", r[2]))
    assert [(d and str(d), i, k) for d, i, k in got] == want
    assert list(reports.pages(fact.filter("false"), size)) == []


def test_a_page_skips_what_lies_after_its_cursor(spark, tmp_path):
    fact = spark.range(5000).selectExpr("date_add(date'2020-01-01', cast(id AS int)) AS transaction_date",
                                        "concat('t', id) AS transaction_id", "id AS transaction_key")
    fact.repartitionByRange(50, "transaction_date").write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    after = stored.filter("transaction_key = 120").first()
    third = reports.page(stored, 7, after)
    assert [r.transaction_key for r in third.collect()] == list(range(119, 112, -1))
    plan = third._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "TakeOrderedAndProject" in plan and f"LessThanOrEqual(transaction_date,{after.transaction_date})" in plan.replace(" ", "")


def test_footer_counts_read_no_row(spark, tmp_path):
    target = str(tmp_path / "t")
    sink.load(days(spark, 3, 40), target)
    sink.load(days(spark, 90, 95), target)
    got = footer_stats(spark, target, ["id", "day"])
    assert tuple(got.first()) == (42, 3, 94, dt.date(2024, 1, 4), dt.date(2024, 4, 4))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT" in plan.replace("(*)", "") or "PushedAggregation: [COUNT(*)" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was


def test_colocated_join_moves_neither_table(spark, tmp_path):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    marts = landing.marts(spark, SF)
    want = sorted(map(str, reports.wide_transactions(marts["fact_transactions"], marts["dim_accounts"], marts["dim_categories"],
                                                     marts["dim_dates"]).collect()))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the accounts were too many
        m = warehouse.save_colocated(marts, "colocated_test", str(tmp_path / "c"), 8)
        f, a = m["fact_transactions"], m["dim_accounts"]
        joined = f.join(a.select("account_key", "account_name"), "account_key", "left")
        joined.write.format("noop").mode("overwrite").save()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        got = reports.wide_transactions(f, a, m["dim_categories"].hint("broadcast"), m["dim_dates"])
        assert sorted(map(str, got.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
        spark.sql("DROP SCHEMA IF EXISTS colocated_test CASCADE")


TX = "transaction_id string, currency string, transaction_date date, amount decimal(18,2), signed_amount decimal(18,2)"
RATE = "rate_date date, base_currency string, target_currency string, rate decimal(18,6), inverse_rate decimal(18,6), _ingested_at timestamp_ntz"


def converted(spark, bound):
    from decimal import Decimal
    day = dt.date(2024, 1, 5)
    tx = [(f"t{i}", c, d, Decimal("10.00"), Decimal("-10.00")) for i, (c, d) in enumerate(
        [("USD", day), ("EUR", day), ("GBP", day), (None, day), ("USD", None), ("USD", dt.date(2023, 1, 1)), ("JPY", day), ("GBP", None)])]
    rates = [(dt.date(2024, 1, 1), "GBP", c, Decimal(r), None, dt.datetime(2024, 1, 1)) for c, r in
             (("USD", "1.250000"), ("EUR", "0.000000"), ("GBP", "3.000000"))]
    out = conversion.int_transactions_with_gbp(spark.createDataFrame(tx, TX), spark.createDataFrame(rates, RATE), bound)
    return out, {r.transaction_id: (r.amount_gbp, r.exchange_rate_used and float(r.exchange_rate_used),
                                    r.exchange_rate_date and str(r.exchange_rate_date), r.was_converted) for r in out.collect()}


@pytest.mark.parametrize("bound", [asof.DEFAULT_MAX_BROADCAST_ROWS, 0])
def test_zero_and_missing_rates_keep_the_own_amount(spark, bound):
    out, got = converted(spark, bound)
    own = (10.0, None, None, False)
    assert got == {"t0": (8.0, 1.25, "2024-01-01", True), "t1": own, "t2": own, "t3": own, "t4": own, "t5": own, "t6": own, "t7": own}


def test_rows_without_a_rate_to_find_stay_out_of_the_shuffle(spark):
    out, _ = converted(spark, 0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("Join LeftOuter") == 1
    left = plan.split("Join LeftOuter")[1]
    assert "NOT (currency" in left.replace("#", " #").replace("  ", " ") or "= GBP" in left


def test_the_oracle_takes_a_zero_rate_as_none():
    import duckdb
    from finlake import oracle
    con = duckdb.connect()
    sql = ("WITH stg_exchange_rates AS (SELECT DATE '2024-01-01' AS rate_date, 'GBP' AS base_currency, 'EUR' AS target_currency, "
           "CAST(0 AS DECIMAL(18, 6)) AS rate, TIMESTAMP '2024-01-01' AS _ingested_at), "
           "stg_transactions AS (SELECT 't' AS transaction_id, 'EUR' AS currency, DATE '2024-01-05' AS transaction_date, "
           "CAST(10 AS DECIMAL(18, 2)) AS amount, CAST(-10 AS DECIMAL(18, 2)) AS signed_amount)," + oracle.CONVERSION +
           " SELECT amount_gbp, signed_amount_gbp, exchange_rate_used, exchange_rate_date, was_converted FROM int_transactions_with_gbp")
    assert con.execute(sql).fetchall() == [(10.0, -10.0, None, None, False)]

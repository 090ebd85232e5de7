"""Checks counted by the writes, one scan per table, one scan for all relationships."""
from collections import Counter

from pyspark.sql import functions as F

from finlake.operators.quality import Check, TableChecks, run_checks
from finlake.plans import checks, warehouse
from finlake.sinks import check_log
from finlake.sinks import tables as sink
from finlake.sources import landing
from finlake.sources import standins as S

SF = "/root/testdata/sf0.001"
OWN = [Check("id", "unique"), Check("tag", "unique"), Check("id", "not_null"), Check("tag", "not_null"),
       Check("kind", "accepted_values", ("a", "b"))]
ROWS = [(1, "x", "a"), (1, "y", "b"), (None, "y", "c"), (None, None, None), (2, "y", "a"), (3, "z", "c")]
WANT = {("id", "unique"): 1, ("tag", "unique"): 1, ("id", "not_null"): 2, ("tag", "not_null"): 1,
        ("kind", "accepted_values"): 2}


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id long, tag string, kind string")


def result(df):
    return {(r.column_name, r.test_name): r.failures for r in df.collect()}


def test_one_scan_answers_all_checks_of_a_table(spark, tmp_table):
    frame(spark).write.parquet(tmp_table)
    df = spark.read.parquet(tmp_table)
    out = run_checks({"t": df}, [TableChecks("t", OWN)])
    assert result(out) == WANT
    assert out._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
    one = [c for c in OWN if c.column != "tag"]
    assert result(run_checks({"t": df}, [TableChecks("t", one)])) == {k: n for k, n in WANT.items() if k[0] != "tag"}
    assert set(result(run_checks({"t": df.filter("false")}, [TableChecks("t", OWN)])).values()) == {0}


def test_writes_log_their_failures(spark, tmp_table):
    label = {ck.label: (ck.column, ck.test) for ck in OWN}
    per_row = {k: n for k, n in WANT.items() if k[1] != "unique"}
    logged = lambda: {label[k]: n for k, n in check_log.failures(spark, tmp_table).items()}
    sink.load(frame(spark), tmp_table, checks=OWN)
    assert logged() == per_row
    sink.load(frame(spark), tmp_table, checks=OWN)
    assert logged() == {k: 2 * n for k, n in per_row.items()}
    df = spark.read.parquet(tmp_table)
    out = run_checks({"t": df}, [TableChecks("t", OWN)], ("not_null", "accepted_values"), {"t": check_log.failures(spark, tmp_table)})
    assert result(out) == {k: 2 * n for k, n in per_row.items()}
    assert "FileScan" not in out._jdf.queryExecution().sparkPlan().toString()
    sink.load(frame(spark), tmp_table)  # a write that does not observe: the log is no longer whole
    assert logged() == {}
    sink.load(frame(spark, ROWS[:3]), tmp_table, mode="replace", checks=OWN)  # a replace starts anew
    assert logged() == {("id", "not_null"): 1, ("tag", "not_null"): 0, ("kind", "accepted_values"): 1}


def test_deduplicated_appends_log_what_they_write(spark, tmp_table):
    for _ in range(2):
        sink.load(frame(spark), tmp_table, dedupe_keys=["id"], checks=OWN)
    want = run_checks({"t": spark.read.parquet(tmp_table)}, [TableChecks("t", OWN)], ("not_null", "accepted_values"))
    got = check_log.failures(spark, tmp_table)
    assert {(ck.column, ck.test): got[ck.label] for ck in OWN if ck.label in got} == result(want)


def test_landing_and_marts_are_logged_whole(spark):
    logged = landing.logged_failures(spark, SF)
    for table in ("raw_transactions", "raw_exchange_rates", *warehouse.MARTS):
        assert set(logged[table]) == {c.label for c in checks.of(table) if c.test in ("not_null", "accepted_values")}
    wh = warehouse.build(landing.raw_transactions(spark, SF), landing.raw_exchange_rates(spark, SF))
    tables = {n: getattr(wh, n) for n in warehouse.MODELS if n not in warehouse.MARTS} | landing.marts(spark, SF)
    scanned = run_checks(tables, checks.DECLARED)
    taken = run_checks(tables, checks.DECLARED, logged=logged)
    assert Counter(map(tuple, scanned.collect())) == Counter(map(tuple, taken.collect()))
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString().count("FileScan")
    assert plan(taken) <= 14 and plan(scanned) <= 20


def test_relationships_of_a_table_share_one_scan(spark, tmp_path):
    child = str(tmp_path / "child")
    spark.range(1000).selectExpr("if(id % 7 = 0, null, if(id % 3 = 0, 1, id)) AS a", "cast(id % 5 AS int) AS b",
                                 "concat('k', id % 4) AS c").write.parquet(child)
    parents = {"pa": spark.range(900).selectExpr("id AS ka"), "pb": spark.range(4).selectExpr("cast(id AS bigint) AS kb"),
               "pc": spark.createDataFrame([("k0",), ("k0",), ("k3",)], "kc string")}
    cks = [Check("a", "relationships", to="pa", field="ka"), Check("b", "relationships", to="pb", field="kb"),
           Check("c", "relationships", to="pc", field="kc")]
    df = spark.read.parquet(child)
    out = run_checks({"t": df, **parents}, [TableChecks("t", cks)])
    want = {(x, "relationships"): df.filter(F.col(x).isNotNull()).join(parents[p], F.col(x) == F.col(k), "left_anti").count()
            for x, p, k in (("a", "pa", "ka"), ("b", "pb", "kb"), ("c", "pc", "kc"))}
    assert result(out) == want and all(want.values())
    assert out._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1


def test_raw_standins_feed_the_same_counts(spark):
    """The log of the landed raw table against the feeds themselves."""
    raw = S.raw_transactions(spark, SF)
    logged = landing.logged_failures(spark, SF)["raw_transactions"]
    assert logged["transaction_id|not_null"] == raw.filter("transaction_id IS NULL").count() > 0

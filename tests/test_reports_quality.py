import datetime as dt

from finlake.operators.quality import Check, TableChecks, run_checks
from finlake.plans import checks, dims, reports

D = dt.date


def _marts(spark):
    fact = spark.createDataFrame([
        ("t1", 20240101, 1, 1, "Tesco", "debit", 10.0, D(2024, 1, 1)),
        ("t2", 20240101, 1, 1, "Tesco", "debit", 5.5, D(2024, 1, 1)),
        ("t3", 20240102, 1, 2, "Acme", "credit", 100.0, D(2024, 1, 2)),
        ("t4", 20240107, 2, 3, "Cafe", "debit", 3.25, D(2024, 1, 7)),
        ("t5", None, 2, None, None, "debit", 1.0, D(2031, 1, 1))],
        "transaction_id string, date_key int, account_key long, category_key long, merchant string, "
        "transaction_type string, amount_gbp double, transaction_date date")
    cats = spark.createDataFrame([(1, "Groceries", "Essential"), (2, "Salary", "Employment Income"),
                                  (3, "Eating Out", "Lifestyle")],
                                 "category_key long, category_name string, parent_category string")
    return fact, cats, dims.dim_dates(spark)


def test_summary_and_net(spark):
    fact, _, _ = _marts(spark)
    s = reports.summary_stats(fact).first()
    assert (s.total_transactions, s.total_income, s.total_expenses, s.unique_merchants) == (5, 100.0, 19.75, 3)
    n = reports.net_position(fact).first()
    assert (n.net_position, n.position_label) == (80.25, "Surplus")


def test_spend_reports(spark):
    fact, cats, dd = _marts(spark)
    assert [(r.category_name, r.amount_gbp) for r in reports.spend_by_category(fact, cats).collect()] == \
        [("Eating Out", 3.25), ("Groceries", 15.5)]
    assert {r.parent_category: r.amount_gbp for r in reports.parent_category_breakdown(fact, cats).collect()} == \
        {"Essential": 15.5, "Lifestyle": 3.25}
    dow = [(r.day_name, r.amount_gbp) for r in reports.day_of_week_spend(fact, dd).collect()]
    assert dow == [("Monday", 15.5), ("Sunday", 3.25)]   # absent days are not filled
    daily = reports.daily_totals(fact).collect()
    assert len(daily) == 4 and daily[0].amount_gbp == 15.5


def test_top_merchants_and_recent(spark):
    fact, cats, _ = _marts(spark)
    top = reports.top_merchants(fact, k=2).collect()
    assert [(r.merchant, r.total_spend, r.total_spend_display, r.transaction_count) for r in top] == \
        [("Tesco", 15.5, "£15.50", 2), ("Cafe", 3.25, "£3.25", 1)]
    recent = reports.recent_transactions(fact, cats, k=3).collect()
    assert [r.transaction_id for r in recent] == ["t5", "t4", "t3"]
    assert recent[2].amount_display == "+£100.00" and recent[1].amount_display == "-£3.25"


def test_category_distribution(spark):
    raw = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0), (None, 4.0)], "category string, amount double")
    out = [(r.category, r["count"], r.avg_amount) for r in reports.category_distribution(raw).collect()]
    assert out[0] == ("a", 2, 1.5) and ("b", 1, 3.0) in out and (None, 1, 4.0) in out


def test_declared_checks_count():
    assert checks.count_checks() == 65


def test_checks_find_violations(spark):
    child = spark.createDataFrame([(1, "x", 10), (1, "bad", 20), (None, "y", 99), (3, None, None)],
                                  "id long, kind string, parent long")
    parent = spark.createDataFrame([(10,), (20,)], "pid long")
    declared = [TableChecks("child", [Check("id", "unique"), Check("id", "not_null"),
                                      Check("kind", "accepted_values", ("x", "y")),
                                      Check("parent", "relationships", to="parent", field="pid")])]
    out = {(r.column_name, r.test_name): r.failures
           for r in run_checks({"child": child, "parent": parent}, declared).collect()}
    assert out == {("id", "unique"): 1, ("id", "not_null"): 1, ("kind", "accepted_values"): 1,
                   ("parent", "relationships"): 1}


def test_materialise_marts(spark, tmp_path):
    from finlake.plans import warehouse
    from finlake.sources import standins as S
    sf = "/root/testdata/sf0.001"
    wh = warehouse.build(S.raw_transactions(spark, sf), S.raw_exchange_rates(spark, sf))
    counts = warehouse.materialise(wh, str(tmp_path / "marts"))
    assert counts["dim_dates"] == 2922
    marts = warehouse.read_marts(spark, str(tmp_path / "marts"))
    fact = marts["fact_transactions"]
    assert fact.count() == counts["fact_transactions"] == wh.stg_transactions.count()
    keys = fact.agg({"transaction_key": "max"}).first()[0]
    assert keys == counts["fact_transactions"]


def test_display_tables_and_empty_guard(spark):
    fact, cats, _ = _marts(spark)
    top = reports.top_merchants(fact, k=1, display=True)
    assert top.columns == ["Merchant", "Total Spend", "Transactions"]
    assert top.first()["Total Spend"] == "£15.50"
    recent = reports.recent_transactions(fact, cats, k=2, display=True)
    assert recent.columns == ["Date", "Merchant", "Category", "Amount"]
    assert reports.has_rows(fact) and not reports.has_rows(fact.filter("false"))


def test_bounded_collect(spark):
    import pytest
    assert len(reports.to_pandas_bounded(spark.range(5), 10)) == 5
    with pytest.raises(ValueError):
        reports.to_pandas_bounded(spark.range(50), 10)


def test_views_answer_dashboard_sql(spark):
    from finlake.plans import warehouse
    from finlake.sources import standins as S
    sf = "/root/testdata/sf0.001"
    wh = warehouse.build(S.raw_transactions(spark, sf), S.raw_exchange_rates(spark, sf))
    wh.register_views(["stg_transactions", "int_transactions_with_gbp", "fact_transactions"])
    per_type = {r.transaction_type: r for r in spark.sql(
        "SELECT transaction_type, count(*) AS n, CAST(sum(CAST(amount_gbp AS DECIMAL(28, 2))) AS DOUBLE) AS pounds "
        "FROM fact_transactions GROUP BY transaction_type").collect()}
    got = reports.summary_stats(wh.fact_transactions).first()
    assert got.total_transactions == sum(r.n for r in per_type.values())
    assert (got.total_income, got.total_expenses) == (per_type["credit"].pounds, per_type["debit"].pounds)
    assert got.unique_merchants == spark.sql(
        "SELECT DISTINCT merchant FROM fact_transactions WHERE merchant IS NOT NULL").count()


def test_refresh_builds_and_tests(spark, tmp_path):
    from finlake.plans import warehouse
    from finlake.sources import standins as S
    sf = "/root/testdata/sf0.001"
    out = warehouse.refresh(S.raw_transactions(spark, sf), S.raw_exchange_rates(spark, sf),
                            str(tmp_path / "marts"))
    assert out["checks_run"] == 65 and out["counts"]["dim_dates"] == 2922
    failed = {(f["table_name"], f["column_name"], f["test_name"]) for f in out["failed_checks"]}
    # the stand-in feeds are dirty on purpose: null ids, wrong-case types, repeated messages
    assert ("raw_transactions", "transaction_id", "not_null") in failed
    assert ("raw_transactions", "transaction_type", "accepted_values") in failed
    assert ("dim_dates", "date_key", "unique") not in failed


def test_materialise_partitioned_fact(spark, tmp_path):
    import os
    from finlake.plans import warehouse
    from finlake.sources import standins as S
    sf = "/root/testdata/sf0.001"
    wh = warehouse.build(S.raw_transactions(spark, sf), S.raw_exchange_rates(spark, sf))
    root = str(tmp_path / "marts")
    counts = warehouse.materialise(wh, root, fact_partition_by=["transaction_date"])
    assert not any(p.is_file() for p in (tmp_path / "marts" / "_staging").rglob("*"))  # nothing is left behind
    fact = warehouse.read_marts(spark, root)["fact_transactions"]
    folder = warehouse.mart_folders(spark, root)["fact_transactions"]
    assert any(d.startswith("transaction_date=") for d in os.listdir(folder))
    one_day = fact.filter("transaction_date = date'2024-01-05'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in plan
    assert one_day.count() <= counts["fact_transactions"]

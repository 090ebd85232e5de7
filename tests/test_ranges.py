"""Dense keys from split points: equal to a global row_number, joins evaluated once."""
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from finlake.operators.ranges import dense_key, ordering, range_of, split_points
from finlake.plans import dims, facts, warehouse
from finlake.sources import standins as S

SF = "/root/testdata/sf0.001"
CASES = {
    "nulls": lambda r, i: (i, r.choice([None, *range(50)]), None),
    "hot": lambda r, i: (i, 7 if i % 3 == 0 else i, f"t{r.randrange(10 ** 6):06d}"),
    "texts": lambda r, i: (i, r.randrange(3), r.choice([None, "", "é", "Z", "a" * r.randrange(9)])),
    "one value": lambda r, i: (i, 1, "x"),
}


def plain(df, order):
    """The one-task form."""
    return df.withColumn("want", F.row_number().over(Window.orderBy(*ordering(order))))


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("order", [["v", "s", "id"], ["-v", "s", "-id"], ["-s", "-v", "id"]])
def test_equals_row_number(spark, case, order):
    r = random.Random(5)
    df = spark.createDataFrame([CASES[case](r, i) for i in range(2000)], "id long, v long, s string").repartition(5)
    got = plain(dense_key(df, order, "k", rows_per_range=90), order)
    assert got.filter("k <> want").count() == 0 and got.count() == 2000


@pytest.mark.parametrize("kind", ["double", "decimal(12,3)", "date", "timestamp_ntz", "timestamp", "boolean", "int"])
def test_sort_columns_of_many_types(spark, kind):
    cast = {"date": "date_add(date'2020-01-01', cast(id % 300 AS int))",
            "timestamp_ntz": "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 0.000011)",
            "timestamp": "timestamp'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 0.000011)",
            "boolean": "id % 2 = 0"}.get(kind, f"cast((id * 37 % 1000) / 7 AS {kind})")
    df = spark.range(600).selectExpr("id", f"if(id % 11 = 0, null, {cast}) AS v")
    got = plain(dense_key(df, ["-v", "id"], "k", rows_per_range=50), ["-v", "id"])
    assert got.filter("k <> want").count() == 0


def test_ranges_are_of_like_size(spark):
    """A third of all rows share the first column: the second one cuts them."""
    df = spark.range(30_000).selectExpr("id", "if(id % 3 = 0, 5, id % 1000) AS v").repartition(6)
    points = split_points(df, ["v", "id"], 30, 30_000)
    sizes = [r["count"] for r in range_of(df, ["v", "id"], points).groupBy("_key_range").count().collect()]
    assert len(sizes) == 30 and max(sizes) < 4000


def test_empty_and_single(spark):
    df = spark.range(1).selectExpr("id", "cast(null AS string) AS s")
    assert dense_key(df, ["s"], "k").first()["k"] == 1
    assert dense_key(df.filter("false"), ["s"], "k").count() == 0


def test_fact_joins_run_once_and_leave_nothing_behind(spark):
    """Counts how often the joined rows are evaluated: a counting column on the input of the
    joins, which only passes over whole rows can reach."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    root = spark.conf.get("spark.checkpoint.dir")
    before = {p for p, _, _ in os.walk(root)}
    wh = warehouse.build(S.raw_transactions(spark, SF), S.raw_exchange_rates(spark, SF))
    int_tx = wh.int_transactions_with_gbp.withColumn("merchant", counted.asNondeterministic()("merchant"))
    fact = facts.fact_transactions(int_tx, wh.dim_accounts, wh.dim_categories, wh.dim_dates,
                                   stg_tx=wh.stg_transactions, rows_per_range=100)
    assert seen.value == 0  # fitting the ranges reads sort keys alone
    fact.write.format("noop").mode("overwrite").save()
    rows = wh.stg_transactions.count()
    assert seen.value == rows
    assert {p for p, _, _ in os.walk(root)} == before
    keys = wh.fact_transactions.agg(F.min("transaction_key"), F.max("transaction_key"), F.countDistinct("transaction_key"))
    assert keys.first() == (1, rows, rows)


def test_fact_keys_are_dense_when_a_category_fans_out(spark):
    """A category with two types has two dimension rows, so its transactions count twice."""
    raw = S.raw_transactions(spark, SF)
    wh = warehouse.build(raw.withColumn("category_type", F.when(
        (F.col("category") == "signup") | (F.hash("transaction_id") % 2 == 0), F.col("category_type")).otherwise("other")),
        S.raw_exchange_rates(spark, SF))
    assert dims.dim_categories(wh.stg_transactions).groupBy("category_id").count().filter("count > 1").count() > 0
    fact = facts.fact_transactions(wh.int_transactions_with_gbp, wh.dim_accounts, wh.dim_categories, wh.dim_dates,
                                   stg_tx=wh.stg_transactions, rows_per_range=64)
    order = ["transaction_timestamp", "transaction_id", "category_key"]
    got = plain(fact.select("transaction_key", *order), [*order, "transaction_key"])
    assert got.filter("transaction_key <> want").count() == 0
    assert got.count() > wh.stg_transactions.count()

"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from finlake import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 9)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, str):
        return _norm(v.item())
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)),
                  key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "customer", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sdf) > 0
        return
    ddf = duck.execute(sql).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert len(sdf) == len(ddf)
    assert _rows(sdf) == _rows(ddf)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "transaction_key" in df.columns


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_plan_has_no_python_or_nested_loops(spark, name):
    df = E.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert bad not in plan, f"{name}: {bad}"


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) <= set(E.oracle_sql())


def test_scratch_data_lives_under_the_checkpoint_dir(spark):
    from finlake.session import checkpoint_root
    from finlake.sources import landing
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == root.rstrip("/")
    for path in landing.land(spark, SF).values():
        assert path.startswith(root.rstrip("/") + "/finlake/")

"""Property tests: the scale-oriented operators equal their textbook formulations."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from finlake.operators.asof import asof_join
from finlake.operators.dedup import first_per_key

names = st.one_of(st.none(), st.sampled_from(["a", "b", "B", "c", "zz"]))
rows = st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), names, names, names), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_first_per_key_equals_rank_one(spark, data):
    df = spark.createDataFrame(data, "k string, name string, t string, c string")
    got = sorted(tuple(r) for r in first_per_key(df, ["k"], ["name"], ["t", "c"])
                 .select("k", "name", "t", "c").collect())
    w = Window.partitionBy("k").orderBy(*[F.col(c).asc_nulls_last() for c in ("name", "t", "c")])
    want = sorted(tuple(r) for r in df.withColumn("rn", F.row_number().over(w))
                  .filter("rn = 1").select("k", "name", "t", "c").collect())
    assert got == want


days = st.integers(min_value=0, max_value=60)
rates = st.lists(st.tuples(st.sampled_from(["USD", "EUR"]), days, st.floats(0.5, 2.0)), max_size=15)
txs = st.lists(st.tuples(st.sampled_from(["USD", "EUR", "JPY", None]), days), min_size=1, max_size=30)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(r=rates, t=txs)
def test_asof_equals_brute_force(spark, r, t):
    base = dt.date(2024, 1, 1)
    uniq = {(c, d): (c, base + dt.timedelta(days=d), v) for c, d, v in r}
    rdf = spark.createDataFrame(list(uniq.values()) or [("USD", base, 1.0)][:0],
                                "ccy string, d date, rate double")
    tdf = spark.createDataFrame([(f"t{i}", c, base + dt.timedelta(days=d)) for i, (c, d) in enumerate(t)],
                                "id string, ccy string, d date")
    got = {x.id: x.rate for x in asof_join(tdf, rdf, left_key="ccy", right_key="ccy", left_date="d",
                                           right_date="d", values=["rate"],
                                           rename={"d": "rate_date"}).collect()}
    want = {}
    for i, (c, d) in enumerate(t):
        day = base + dt.timedelta(days=d)
        cands = [(rd, v) for cc, rd, v in uniq.values() if cc == c and rd <= day]
        want[f"t{i}"] = max(cands)[1] if cands else None
    assert got == want

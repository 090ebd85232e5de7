import datetime as dt
import json

import pytest

from finlake.sources import rates_json

# Friday, no Saturday, Sunday without a dollar rate, Monday with one currency more
WEEKEND = {"base": "GBP", "rates": {
    "2025-06-13": {"USD": 1.3561, "EUR": 1.1742},
    "2025-06-15": {"USD": None, "EUR": 1.1739},
    "2025-06-16": {"USD": 1.3577, "EUR": 1.1733, "JPY": 195.62}}}


def _flat(spark, texts, *args, **kwargs):
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    return rates_json.flatten_rates(rates_json.parse_documents(frame), *args, **kwargs)


def _triples(df):
    return sorted((str(r.rate_date)[:10], r.target_currency, r.rate) for r in df.collect())


def test_gap_days_and_null_rates(spark):
    out = _flat(spark, [json.dumps(WEEKEND)], "GBP", ["USD", "EUR", "JPY"], "2025-06-13", "2025-06-16")
    got = {(day, code): rate for day, code, rate in _triples(out)}
    assert ("2025-06-14", "EUR") not in got
    assert got.get(("2025-06-15", "USD")) is None
    assert got[("2025-06-16", "JPY")] == 195.62
    assert len([rate for rate in got.values() if rate is not None]) == 6


def test_bounds_are_inclusive_and_symbols_select(spark):
    out = _flat(spark, [json.dumps(WEEKEND)], "GBP", ["EUR"], "2025-06-15", "2025-06-16")
    assert _triples(out) == [("2025-06-15", "EUR", 1.1739), ("2025-06-16", "EUR", 1.1733)]


def test_default_range_is_the_last_thirty_days(spark):
    today = dt.date.today()
    days = {str(today - dt.timedelta(days=n)): {"USD": 1.0 + n / 100, "EUR": 1.1, "JPY": 190.0} for n in (5, 90)}
    got = _triples(_flat(spark, [json.dumps({"base": "GBP", "rates": days})]))
    inside = str(today - dt.timedelta(days=5))
    assert got == [(inside, "EUR", 1.1), (inside, "USD", 1.05)]


def test_argument_names_the_base(spark):
    doc = json.dumps({"rates": {"2025-06-13": {"JPY": 166.6}}})
    rows = _flat(spark, [doc], "EUR", ["JPY"], "2025-06-13", "2025-06-13").collect()
    assert [r.base_currency for r in rows] == ["EUR"]


def test_document_without_days(spark):
    out = _flat(spark, ['{"base": "GBP", "rates": {}}'], start_date="2025-01-01", end_date="2025-12-31")
    assert out.isEmpty() and set(out.columns) == {"rate_date", "base_currency", "target_currency", "rate"}


def test_broken_text_stops_the_job(spark):
    with pytest.raises(Exception):
        _flat(spark, ['{"rates": {"2025-'], start_date="2025-01-01", end_date="2025-12-31").collect()


def test_files_with_line_breaks(spark, tmp_path):
    for part, day in (("a", "2025-06-13"), ("b", "2025-06-16")):
        (tmp_path / f"{part}.json").write_text(
            json.dumps({"base": "GBP", "rates": {day: WEEKEND["rates"][day]}}, indent=1))
    out = rates_json.flatten_rates(rates_json.read_documents(spark, str(tmp_path)), "GBP", ["USD"],
                                   "2025-06-01", "2025-06-30")
    assert _triples(out) == [("2025-06-13", "USD", 1.3561), ("2025-06-16", "USD", 1.3577)]

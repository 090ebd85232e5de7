"""Exchange-rate documents -> rows (SRC1) with range / currency selection (SRC2).

The reference fetches ``{"base": ..., "rates": {date: {currency: rate}}}``
over HTTP.  Here the documents are landed JSON (files or a string column);
parsing and flattening run on the executors, one document per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.vocab import (RATES_BASE_CURRENCY, RATES_DEFAULT_DAYS_BACK,
                                     RATES_TARGET_CURRENCIES)
from finlake.schemas import RATES_DOCUMENT


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed documents (one JSON object per file); malformed input raises."""
    return (spark.read.schema(RATES_DOCUMENT).option("multiLine", "true")
            .option("mode", "FAILFAST").json(path))


def parse_documents(docs: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse a string column of documents; a malformed document raises (FAILFAST)."""
    parsed = F.from_json(F.col(value_col), RATES_DOCUMENT, {"mode": "FAILFAST"})
    return docs.select(parsed.alias("doc")).select("doc.*")


def flatten_rates(docs: DataFrame, base_currency: str = RATES_BASE_CURRENCY,
                  target_currencies: Sequence[str] | None = None,
                  start_date: str | Column | None = None,
                  end_date: str | Column | None = None) -> DataFrame:
    """(rate_date timestamp, base_currency, target_currency, rate) rows.

    ``base_currency`` is the argument, not the document's ``base``.  Defaults
    select USD and EUR over the last 30 days up to today.  Empty ``rates``
    give no rows.
    """
    targets = list(target_currencies or RATES_TARGET_CURRENCIES)
    end = _as_date(end_date) if end_date is not None else F.current_date()
    start = (_as_date(start_date) if start_date is not None
             else F.date_sub(F.current_date(), RATES_DEFAULT_DAYS_BACK))
    by_day = docs.select(F.explode("rates").alias("day", "by_ccy"))
    rows = by_day.select(F.to_date("day").alias("d"),
                         F.explode("by_ccy").alias("target_currency", "rate"))
    return rows.filter(F.col("d").between(start, end) & F.col("target_currency").isin(targets)) \
        .select(F.col("d").cast("timestamp_ntz").alias("rate_date"),
                F.lit(base_currency).alias("base_currency"),
                "target_currency", "rate")


def _as_date(x: str | Column) -> Column:
    return F.lit(x).cast("date") if isinstance(x, str) else x

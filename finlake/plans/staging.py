"""Staging models MOD1 (transactions) and MOD2 (exchange rates).

Plain projections + filters; Catalyst pushes the filters into the scan
(``PushedFilters``) and prunes unused columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_transactions(raw: DataFrame) -> DataFrame:
    """Trim / fold case / cast; keep rows with an id and a positive amount.

    The currency is upper-cased but not trimmed (as in the reference).
    """
    return raw.filter(F.col("transaction_id").isNotNull() & (F.col("amount") > 0)).select(
        "transaction_id",
        "account_id",
        F.trim("account_name").alias("account_name"),
        F.lower("account_type").alias("account_type"),
        F.trim("bank_name").alias("bank_name"),
        F.upper("currency").alias("currency"),
        F.col("amount").cast("decimal(18,2)").alias("amount"),
        F.col("signed_amount").cast("decimal(18,2)").alias("signed_amount"),
        F.lower("transaction_type").alias("transaction_type"),
        F.trim("category").alias("category"),
        F.lower("category_type").alias("category_type"),
        F.trim("merchant").alias("merchant"),
        F.trim("description").alias("description"),
        F.col("transaction_date").cast("date").alias("transaction_date"),
        F.col("transaction_timestamp").cast("timestamp_ntz").alias("transaction_timestamp"),
        "transaction_year",
        "transaction_month",
        "transaction_day_of_week",
        "_ingested_at",
        "_source",
    )


def stg_exchange_rates(raw: DataFrame) -> DataFrame:
    """Date-cast, trimmed upper-case codes, decimal rates; drop null / non-positive rates."""
    return raw.filter(F.col("rate").isNotNull() & (F.col("rate") > 0)).select(
        F.col("rate_date").cast("date").alias("rate_date"),
        F.upper(F.trim("base_currency")).alias("base_currency"),
        F.upper(F.trim("target_currency")).alias("target_currency"),
        F.col("rate").cast("decimal(18,6)").alias("rate"),
        F.col("inverse_rate").cast("decimal(18,6)").alias("inverse_rate"),
        "_ingested_at",
        "_source",
    )

"""MOD7 fact_transactions: one row per transaction with surrogate foreign keys.

Dimension joins:
* dim_dates: fixed size (one row per day of the spine) -> always broadcast;
* dim_categories, dim_accounts: sizes depend on the data -> plain left joins,
  planned by size; adaptive execution turns them into broadcasts at run time
  when the measured dimension is small and splits skewed account keys
  otherwise.  ``account_rows`` / ``category_rows`` let a caller that knows
  the counts (``warehouse.materialise``, from the written dims) broadcast a
  dimension of at most ``DIM_BROADCAST_MAX_ROWS`` rows outright.

The transaction key is a dense 1..N over (transaction_timestamp, transaction_id)
from ``dense_key`` (no single-partition window); the reference orders by the
timestamp alone, the id (and for a category with several types its key) is the
added tie-break.  The ranges are fitted on ``stg_tx``, which has the fact's sort
keys before any join, so the joins below run once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.operators.ranges import ROWS_PER_RANGE, dense_key

DIM_BROADCAST_MAX_ROWS = 2_000_000


def _maybe_broadcast(dim: DataFrame, rows: int | None) -> DataFrame:
    return F.broadcast(dim) if rows is not None and rows <= DIM_BROADCAST_MAX_ROWS else dim


def attach_dimension_keys(int_tx: DataFrame, dim_accounts: DataFrame,
                          dim_categories: DataFrame, dim_dates: DataFrame,
                          account_rows: int | None = None,
                          category_rows: int | None = None) -> DataFrame:
    t = int_tx.alias("t")
    a = _maybe_broadcast(dim_accounts.select("account_id", "account_key"), account_rows).alias("a")
    c = _maybe_broadcast(dim_categories.select("category_id", "category_key"), category_rows).alias("c")
    d = F.broadcast(dim_dates.select("full_date", "date_key")).alias("d")
    return (t.join(a, F.col("t.account_id") == F.col("a.account_id"), "left")
             .join(c, F.col("t.category") == F.col("c.category_id"), "left")
             .join(d, F.col("t.transaction_date") == F.col("d.full_date"), "left"))


def _sort_keys(stg_tx: DataFrame, dim_categories: DataFrame) -> DataFrame:
    """The fact's sort keys: one row per staged transaction, with the number of fact rows it
    makes (a category that came with several types has several dimension rows)."""
    several = dim_categories.groupBy("category_id").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    t = stg_tx.select("transaction_timestamp", "transaction_id", "category")
    return t.join(several, F.col("category") == F.col("category_id"), "left") \
        .withColumn("_rows", F.coalesce("_rows", F.lit(1)))


def fact_transactions(int_tx: DataFrame, dim_accounts: DataFrame, dim_categories: DataFrame,
                      dim_dates: DataFrame, with_key: bool = True,
                      account_rows: int | None = None,
                      category_rows: int | None = None,
                      stg_tx: DataFrame | None = None,
                      rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``stg_tx``: the staging rows that ``int_tx`` was made from, one for one; without it the
    ranges are fitted on the joined rows' sort columns."""
    j = attach_dimension_keys(int_tx, dim_accounts, dim_categories, dim_dates,
                              account_rows, category_rows)
    cols = [
        F.col("t.transaction_id").alias("transaction_id"),
        F.col("d.date_key").alias("date_key"),
        F.col("a.account_key").alias("account_key"),
        F.col("c.category_key").alias("category_key"),
        *[F.col(f"t.{c}").alias(c) for c in (
            "merchant", "description", "transaction_type", "amount", "signed_amount",
            "currency", "amount_gbp", "signed_amount_gbp", "exchange_rate_used",
            "exchange_rate_date", "was_converted", "transaction_date",
            "transaction_timestamp", "_ingested_at")],
    ]
    fact = j.select(*cols)
    if with_key:
        keys, weight = (None, None) if stg_tx is None else (_sort_keys(stg_tx, dim_categories), "_rows")
        fact = dense_key(fact, ["transaction_timestamp", "transaction_id", "category_key"], "transaction_key",
                         keys, weight, rows_per_range)
        fact = fact.select("transaction_key", *[c for c in fact.columns if c != "transaction_key"])
    return fact.withColumn("_created_at", F.current_timestamp())

"""MOD3 int_transactions_with_gbp: every amount in GBP via the latest prior rate.

* GBP transactions keep their amount (no rate looked up);
* others use the newest GBP-based rate dated on or before the transaction date:
  ``round(amount / rate, 2)``, computed in DOUBLE as the reference engine does;
* no rate (or null currency) -> own amount, ``was_converted = false``; a rate that is
  stored as zero is no rate: none is shown as used.

GBP and null-currency rows (most of the fact) have no rate to find; where the as-of join
has to shuffle, they stay out of it.

Rates are first reduced to one per (currency, date): the latest ingestion wins,
then the highest rate (the reference leaves this tie arbitrary).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions import columns as C
from finlake.operators.asof import DEFAULT_MAX_BROADCAST_ROWS, asof_join
from finlake.operators.dedup import first_per_key

BASE = "GBP"


def gbp_rates(stg_rates: DataFrame) -> DataFrame:
    """One GBP-based rate per (target_currency, rate_date)."""
    r = stg_rates.filter((F.col("base_currency") == F.lit(BASE))
                         & (F.col("target_currency") != F.lit(BASE)))
    return first_per_key(r, ["target_currency", "rate_date"], ["_ingested_at", "rate"],
                         descending=True).select("target_currency", "rate_date", "rate")


def latest_rates(stg_tx: DataFrame, stg_rates: DataFrame,
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Transactions with ``rate`` and ``exchange_rate_date`` of the as-of match."""
    return asof_join(stg_tx, gbp_rates(stg_rates), left_key="currency",
                     right_key="target_currency", left_date="transaction_date",
                     right_date="rate_date", values=["rate"],
                     wanted=F.col("currency") != F.lit(BASE),
                     rename={"rate_date": "exchange_rate_date", "rate": "_rate"},
                     max_broadcast_rows=max_broadcast_rows)


def int_transactions_with_gbp(stg_tx: DataFrame, stg_rates: DataFrame,
                              max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    j = latest_rates(stg_tx, stg_rates, max_broadcast_rows)
    is_gbp = F.col("currency") == F.lit(BASE)
    rate = F.col("_rate").cast("double")
    # a rate below half a millionth is stored as 0.000000: the own amount stays
    has_rate = F.coalesce(F.col("_rate").isNotNull() & (rate != 0) & ~is_gbp, F.lit(False))

    def gbp(c: str):
        own = F.col(c).cast("double")
        return F.when(is_gbp, own).when(has_rate, C.round_half_away(F.try_divide(own, rate), 2)).otherwise(own)

    return j.select(
        *[c for c in stg_tx.columns],
        gbp("amount").alias("amount_gbp"),
        gbp("signed_amount").alias("signed_amount_gbp"),
        F.when(has_rate, F.col("_rate")).cast("decimal(18,6)").alias("exchange_rate_used"),
        F.when(has_rate, F.col("exchange_rate_date")).cast("date").alias("exchange_rate_date"),
        has_rate.alias("was_converted"),
    )

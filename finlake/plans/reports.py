"""Dashboard reports RPT1-RPT9 over the marts.

The reference pulls the whole joined fact into client memory and aggregates
there.  Here every report is its own distributed aggregation and only its
bounded result leaves the cluster:

* aggregates are computed on the fact first, by surrogate key (partial,
  map-side), and only the small aggregate is joined to its dimension;
* top-k reports use ``orderBy().limit()`` (TakeOrderedAndProject: a per-task
  top-k, never a full sort) and join dimensions to those k rows only.

Amounts have two places and are summed as decimals, so sums are exact and do not
depend on the order of the rows; group keys that are null are dropped, as a pandas ``groupby`` does.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from finlake.functions import columns as C
from finlake.functions.vocab import DAY_ORDER

DEBIT, CREDIT = "debit", "credit"
PAGE_ORDER = ("transaction_date", "transaction_id", "transaction_key")  # newest first, then ascending


def _debits(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("transaction_type") == F.lit(DEBIT))


def _exact(c: F.Column) -> F.Column:
    return c.cast("decimal(28,2)")


def _pounds(c: F.Column) -> F.Column:
    """Exact sum of amounts of two places, whatever the order of the rows."""
    return F.sum(_exact(c)).cast("double")


def wide_transactions(fact: DataFrame, dim_accounts: DataFrame, dim_categories: DataFrame,
                      dim_dates: DataFrame, ordered: bool = True) -> DataFrame:
    """RPT1: fact with account, category and date attributes, newest first."""
    f = fact.alias("f")
    a = dim_accounts.select("account_key", "account_name", "account_type").alias("a")
    c = dim_categories.select("category_key", "category_name", "parent_category",
                              "category_type").alias("c")
    d = F.broadcast(dim_dates.select("date_key", "day_name", "month_name", "year_number")).alias("d")
    w = (f.join(a, F.col("f.account_key") == F.col("a.account_key"), "left")
          .join(c, F.col("f.category_key") == F.col("c.category_key"), "left")
          .join(d, F.col("f.date_key") == F.col("d.date_key"), "left")
          .select(*[F.col(f"f.{x}") for x in (
                      "transaction_id", "transaction_date", "amount", "signed_amount",
                      "amount_gbp", "signed_amount_gbp", "transaction_type", "merchant",
                      "description")],
                  "a.account_name", "a.account_type", "c.category_name",
                  "c.parent_category", "c.category_type",
                  "d.day_name", "d.month_name", "d.year_number"))
    if ordered:
        w = w.orderBy(F.col("transaction_date").desc_nulls_last(),
                      F.col("transaction_id").asc_nulls_last())
    return w


def summary_stats(fact: DataFrame) -> DataFrame:
    """RPT2: count, income, expenses (GBP) and distinct merchants, in one pass."""
    t = F.col("transaction_type")
    return fact.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        _pounds(F.when(t == F.lit(CREDIT), F.col("amount_gbp")).otherwise(F.lit(0.0))).alias("total_income"),
        _pounds(F.when(t == F.lit(DEBIT), F.col("amount_gbp")).otherwise(F.lit(0.0))).alias("total_expenses"),
        F.countDistinct("merchant").alias("unique_merchants"),
    )


def net_position(fact: DataFrame) -> DataFrame:
    """RPT2 (net): income - expenses with a Surplus / Deficit label."""
    s = summary_stats(fact)
    net = _exact(F.col("total_income")) - _exact(F.col("total_expenses"))
    return s.select("total_income", "total_expenses", net.cast("double").alias("net_position"),
                    F.when(net > 0, F.lit("Surplus")).otherwise(F.lit("Deficit"))
                    .alias("position_label"))


def _debits_by(fact: DataFrame, key: str) -> DataFrame:
    return _debits(fact).groupBy(key).agg(F.sum(_exact(F.col("amount_gbp"))).alias("_spend"))


def spend_by_category(fact: DataFrame, dim_categories: DataFrame) -> DataFrame:
    """RPT3: debit spend per category name, ascending."""
    per_key = _debits_by(fact, "category_key")
    named = per_key.join(dim_categories.select("category_key", "category_name"),
                         "category_key", "left")
    return (named.filter(F.col("category_name").isNotNull())
            .groupBy("category_name").agg(_pounds(F.col("_spend")).alias("amount_gbp"))
            .orderBy("amount_gbp", "category_name"))


def daily_totals(fact: DataFrame) -> DataFrame:
    """RPT4: GBP amount per (date, transaction type), sorted by the keys."""
    return (fact.filter(F.col("transaction_date").isNotNull()
                        & F.col("transaction_type").isNotNull())
            .groupBy("transaction_date", "transaction_type")
            .agg(_pounds(F.col("amount_gbp")).alias("amount_gbp"))
            .orderBy("transaction_date", "transaction_type"))


def page(fact: DataFrame, size: int, after: Row | None = None) -> DataFrame:
    """SNK9: the next ``size`` fact rows after row ``after`` of the page before, newest first.

    The order (date, id, key) is unique, so pages that follow one another hold every
    row once, and a page is found by its first row, not by counting.  The cursor's
    date is a plain filter: files and row groups of later dates are skipped, and
    each task keeps ``size`` rows at most."""
    day, ident, key = (F.col(c) for c in PAGE_ORDER)
    if after is not None:
        d, i, k = (after[c] for c in PAGE_ORDER)
        later = (key > k) if i is None else (ident > i) | ident.isNull() | ((ident == i) & (key > k))
        same = later if i is not None else ident.isNull() & later
        fact = fact.filter(day.isNull() & same if d is None else
                           (day < d) | day.isNull() | ((day == d) & same))
        if d is not None:
            fact = fact.filter((day <= d) | day.isNull())  # alone it reaches the scan's statistics
    return fact.orderBy(day.desc_nulls_last(), ident.asc_nulls_last(), key.asc_nulls_last()).limit(size)


def pages(fact: DataFrame, size: int) -> Iterator[list[Row]]:
    """All rows of the fact, page by page; one page at a time is with the client."""
    rows = page(fact, size).collect()
    while rows:
        yield rows
        rows = page(fact, size, rows[-1]).collect() if len(rows) == size else []


def to_pandas_bounded(df: DataFrame, max_rows: int):
    """Hand a report of at most ``max_rows`` rows to the client (SNK9); more is an error,
    not cut.  Reports without a bound are read by ``pages``."""
    pdf = df.limit(max_rows + 1).toPandas()
    if len(pdf) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; aggregate or page it instead")
    return pdf


def has_rows(df: DataFrame) -> bool:
    """Empty-result guard of the dashboard panels (one ``limit 1`` probe)."""
    return not df.isEmpty()


def top_merchants(fact: DataFrame, k: int = 10, display: bool = False) -> DataFrame:
    """RPT5: the k merchants with the highest debit spend (ties by name).

    ``display=True`` gives the dashboard table: Merchant, Total Spend (text), Transactions.
    """
    per = (_debits(fact).filter(F.col("merchant").isNotNull()).groupBy("merchant")
           .agg(_pounds(F.col("amount_gbp")).alias("total_spend"),
                F.count("transaction_id").alias("transaction_count")))
    top = per.orderBy(F.col("total_spend").desc(), F.col("merchant").asc()).limit(k)
    out = top.select("merchant", "total_spend", C.money("total_spend").alias("total_spend_display"),
                     "transaction_count")
    if display:
        return out.orderBy(F.col("total_spend").desc(), F.col("merchant")).select(
            F.col("merchant").alias("Merchant"), F.col("total_spend_display").alias("Total Spend"),
            F.col("transaction_count").alias("Transactions"))
    return out


def parent_category_breakdown(fact: DataFrame, dim_categories: DataFrame) -> DataFrame:
    """RPT6: debit spend per parent category."""
    per_key = _debits_by(fact, "category_key")
    named = per_key.join(dim_categories.select("category_key", "parent_category"),
                         "category_key", "left")
    return (named.filter(F.col("parent_category").isNotNull())
            .groupBy("parent_category").agg(_pounds(F.col("_spend")).alias("amount_gbp"))
            .orderBy("parent_category"))


def recent_transactions(fact: DataFrame, dim_categories: DataFrame, k: int = 20,
                        display: bool = False) -> DataFrame:
    """RPT7: the k newest transactions with a signed money label.

    ``display=True`` gives the dashboard table: Date, Merchant, Category, Amount.
    """
    recent = fact.select("transaction_id", "transaction_date", "merchant", "category_key",
                         "amount_gbp", "transaction_type") \
        .orderBy(F.col("transaction_date").desc_nulls_last(),
                 F.col("transaction_id").asc_nulls_last()).limit(k)
    named = recent.join(dim_categories.select("category_key", "category_name"),
                        "category_key", "left")
    out = named.select("transaction_id", "transaction_date", "merchant", "category_name",
                       C.signed_money("amount_gbp", "transaction_type").alias("amount_display")) \
        .orderBy(F.col("transaction_date").desc_nulls_last(), F.col("transaction_id"))
    if display:
        return out.select(F.col("transaction_date").alias("Date"), F.col("merchant").alias("Merchant"),
                          F.col("category_name").alias("Category"), F.col("amount_display").alias("Amount"))
    return out


def day_of_week_spend(fact: DataFrame, dim_dates: DataFrame) -> DataFrame:
    """RPT8: debit spend per weekday name, Monday first (absent days not filled)."""
    per_key = _debits_by(fact, "date_key")
    named = per_key.join(F.broadcast(dim_dates.select("date_key", "day_name")), "date_key", "left")
    order = F.array_position(F.array(*[F.lit(d) for d in DAY_ORDER]), F.col("day_name"))
    return (named.filter(F.col("day_name").isNotNull())
            .groupBy("day_name").agg(_pounds(F.col("_spend")).alias("amount_gbp"))
            .withColumn("day_order", F.when(order > 0, order).otherwise(F.lit(len(DAY_ORDER) + 1))
                        .cast("bigint"))
            .orderBy("day_order", "day_name"))


def category_distribution(raw_tx: DataFrame) -> DataFrame:
    """RPT9: per raw category: count and average amount, most frequent first."""
    return (raw_tx.groupBy("category")
            .agg(F.count(F.lit(1)).alias("count"), C.round_half_away(F.avg("amount"), 2).alias("avg_amount"))
            .orderBy(F.col("count").desc(), F.col("category").asc_nulls_last()))

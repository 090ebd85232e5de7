"""Dimensions: MOD4 dim_dates, MOD5 dim_accounts, MOD6 dim_categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions import columns as C
from finlake.functions import vocab as V
from finlake.operators.dedup import first_per_key
from finlake.operators.ranges import dense_key


def date_spine(spark: SparkSession, start: str = V.DATE_SPINE_START,
               end: str = V.DATE_SPINE_END) -> DataFrame:
    """One row per day, both ends inclusive (SRC7)."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                             F.expr("INTERVAL 1 DAY"))).alias("date_day"))


def dim_dates(spark: SparkSession, start: str = V.DATE_SPINE_START,
              end: str = V.DATE_SPINE_END) -> DataFrame:
    """Calendar attributes; day_of_week is Sunday = 0, week_of_year is ISO."""
    d = F.col("date_day")
    dow = (F.dayofweek(d) - 1).cast("bigint")
    year = F.year(d).cast("bigint")
    month = F.month(d).cast("bigint")
    return date_spine(spark, start, end).select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("full_date"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        F.dayofyear(d).cast("bigint").alias("day_of_year"),
        F.weekofyear(d).cast("bigint").alias("week_of_year"),
        month.alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.quarter(d).cast("bigint").alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        year.alias("year_number"),
        F.when(month >= 4, year).otherwise(year - 1).alias("fiscal_year"),
        dow.isin(0, 6).alias("is_weekend"),
        F.date_format(d, "yyyy-MM-dd").alias("iso_date"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    ).orderBy("date_key")


def dim_accounts(stg_tx: DataFrame) -> DataFrame:
    """One row per account_id (smallest name, nulls last), keyed in account_id order."""
    acc = first_per_key(stg_tx, ["account_id"], ["account_name"],
                        payload=["account_type", "currency"])
    keyed = dense_key(acc, ["account_id"], "account_key", stg_tx.select("account_id").distinct())
    return keyed.select(
        "account_key", "account_id", "account_name", "account_type", "currency",
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
        F.lit(True).alias("is_active"),
    )


def dim_categories(stg_tx: DataFrame) -> DataFrame:
    """Distinct (category, category_type) with hierarchy, budget class and sort order."""
    pairs = stg_tx.filter(F.col("category").isNotNull()) \
        .select("category", "category_type").distinct()
    parent = C.lookup("category", V.PARENT_CATEGORY, V.PARENT_DEFAULT)
    enriched = pairs.select(
        "category", "category_type",
        parent.alias("parent_category"),
        C.lookup("category", V.BUDGET_CATEGORY, V.BUDGET_DEFAULT).alias("budget_category"))
    keyed = dense_key(enriched, ["-category_type", "category"], "category_key", pairs)
    return keyed.select(
        "category_key",
        F.col("category").alias("category_id"),
        F.col("category").alias("category_name"),
        "category_type", "parent_category", "budget_category",
        C.lookup("parent_category", V.PARENT_SORT_ORDER, V.SORT_ORDER_DEFAULT)
        .cast("int").alias("sort_order"),
    )

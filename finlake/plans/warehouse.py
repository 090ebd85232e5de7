"""The model graph as function composition (raw -> staging -> intermediate -> marts).

``build(raw_tx, raw_rates)`` returns a ``Warehouse`` whose models are built on
first access (staging and intermediate stay lazy views that inline into one
Catalyst plan per mart; the narrow passes that fit surrogate keys only run for
the models actually used).  ``materialise`` writes the
marts (full refresh, dims first, then the fact joined against the written dims
with broadcast decisions taken from the observed dimension row counts); the
writes count the marts' per-row quality checks in passing.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from finlake.operators.quality import run_checks
from finlake.plans import checks, conversion, dims, facts, staging
from finlake.sinks import check_log
from finlake.sinks.tables import write_mart
from finlake.sinks.versions import Versions, resolve

MODELS = ("raw_transactions", "raw_exchange_rates", "stg_transactions", "stg_exchange_rates",
          "int_transactions_with_gbp", "dim_dates", "dim_accounts", "dim_categories",
          "fact_transactions")
MARTS = ("dim_dates", "dim_accounts", "dim_categories", "fact_transactions")


class Warehouse:
    def __init__(self, raw_tx: DataFrame, raw_rates: DataFrame, with_fact_key: bool = True):
        self.raw_transactions = raw_tx
        self.raw_exchange_rates = raw_rates
        self.with_fact_key = with_fact_key

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.raw_transactions)

    @cached_property
    def stg_exchange_rates(self) -> DataFrame:
        return staging.stg_exchange_rates(self.raw_exchange_rates)

    @cached_property
    def int_transactions_with_gbp(self) -> DataFrame:
        return conversion.int_transactions_with_gbp(self.stg_transactions, self.stg_exchange_rates)

    @cached_property
    def dim_dates(self) -> DataFrame:
        return dims.dim_dates(self.raw_transactions.sparkSession)

    @cached_property
    def dim_accounts(self) -> DataFrame:
        return dims.dim_accounts(self.stg_transactions)

    @cached_property
    def dim_categories(self) -> DataFrame:
        return dims.dim_categories(self.stg_transactions)

    @cached_property
    def fact_transactions(self) -> DataFrame:
        return facts.fact_transactions(self.int_transactions_with_gbp, self.dim_accounts,
                                       self.dim_categories, self.dim_dates,
                                       with_key=self.with_fact_key, stg_tx=self.stg_transactions)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in MODELS}

    def register_views(self, names=MODELS, prefix: str = "") -> list[str]:
        """Expose models as temporary views (SNK7) so SQL runs against them by name,
        e.g. ``spark.sql("select count(*) from fact_transactions")``."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(prefix + name)
        return [prefix + n for n in names]


def build(raw_tx: DataFrame, raw_rates: DataFrame, with_fact_key: bool = True) -> Warehouse:
    return Warehouse(raw_tx, raw_rates, with_fact_key)


def materialise(wh: Warehouse, root: str,
                fact_partition_by: list[str] | None = None) -> dict[str, int]:
    """Write the marts as a new version of ``root``; return their row counts.

    All marts switch together when the last one is written: readers
    (``read_marts``) see the old build or the new one, whose keys belong together.

    ``fact_partition_by`` (e.g. ``["transaction_date"]`` on a large cluster)
    lays the fact out for partition pruning; without it each file still holds
    whole (timestamp, id) ranges in order, so row-group statistics prune date
    ranges.
    """
    spark = wh.raw_transactions.sparkSession
    versions = Versions(spark, root)
    root = versions.fresh()
    counts: dict[str, int] = {}
    for name in ("dim_dates", "dim_accounts", "dim_categories"):
        counts[name] = write_mart(getattr(wh, name), f"{root}/{name}", checks=checks.of(name))
    da = spark.read.parquet(f"{root}/dim_accounts")
    dc = spark.read.parquet(f"{root}/dim_categories")
    dd = spark.read.parquet(f"{root}/dim_dates")
    fact = facts.fact_transactions(wh.int_transactions_with_gbp, da, dc, dd,
                                   account_rows=counts["dim_accounts"],
                                   category_rows=counts["dim_categories"],
                                   stg_tx=wh.stg_transactions)
    counts["fact_transactions"] = write_mart(fact, f"{root}/fact_transactions", fact_partition_by,
                                             checks.of("fact_transactions"))
    versions.switch(root)
    return counts


def mart_folders(spark, root: str) -> dict[str, str]:
    """Where the marts of the current build lie."""
    now = resolve(spark, root)
    return {name: f"{now}/{name}" for name in MARTS}


def read_marts(spark, root: str) -> dict[str, DataFrame]:
    """The marts of the current build; later builds do not change what these frames read."""
    return {name: spark.read.parquet(folder) for name, folder in mart_folders(spark, root).items()}


def save_colocated(marts: dict[str, DataFrame], schema: str, folder: str, buckets: int) -> dict[str, DataFrame]:
    """Lay the fact and the account dimension out for each other (JOI3, JOI4): both bucketed and
    sorted by account_key into ``buckets``, as external tables of ``schema`` under ``folder``.

    For an account dimension that is too big to broadcast: the join then moves neither
    table, whatever reads them.  Returns the marts with the two tables in place."""
    spark = next(iter(marts.values())).sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    out = dict(marts)
    for name in ("fact_transactions", "dim_accounts"):
        (marts[name].repartition(buckets, "account_key").write.mode("overwrite").format("parquet")
         .option("path", f"{folder.rstrip('/')}/{name}").bucketBy(buckets, "account_key").sortBy("account_key")
         .saveAsTable(f"{schema}.{name}"))
        out[name] = spark.table(f"{schema}.{name}")
    return out


def refresh(raw_tx: DataFrame, raw_rates: DataFrame, root: str) -> dict:
    """Build the marts, then test every model (the reference's run-then-test step).

    Returns the mart row counts and the failing checks (at most one row per
    declared check is brought back).
    """
    wh = build(raw_tx, raw_rates)
    counts = materialise(wh, root)
    tables = {name: getattr(wh, name) for name in MODELS if name not in MARTS}
    tables.update(read_marts(raw_tx.sparkSession, root))
    folders = mart_folders(raw_tx.sparkSession, root)
    logged = {m: check_log.failures(raw_tx.sparkSession, folders[m]) for m in MARTS}
    results = run_checks(tables, checks.DECLARED, logged=logged)
    failing = [r.asDict() for r in results.filter("failures > 0").collect()]
    return {"counts": counts, "checks_run": checks.count_checks(), "failed_checks": failing}

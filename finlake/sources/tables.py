"""Table scans (SRC3), existence probe (SRC8) and row counts (SRC9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.sinks.files import holds_data
from finlake.sinks.versions import resolve


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """A catalog table name (``db.tbl``) or a Parquet path (of a versioned one the current version)."""
    if _is_path(target):
        return spark.read.parquet(resolve(spark, target))
    return spark.table(target)


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_exists(spark: SparkSession, target: str) -> bool:
    """Whether a catalog has the table, or a folder holds table files (a folder that is empty, or
    holds only what a writer has not committed yet, is no table)."""
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    return path_exists(spark, target)


def path_exists(spark: SparkSession, path: str) -> bool:
    """A folder with data files on any Hadoop-compatible file system (local, HDFS, object store)."""
    try:
        return holds_data(spark, resolve(spark, path))
    except AttributeError:  # no JVM gateway (Spark Connect): probe by reading
        from pyspark.errors import AnalysisException
        try:
            spark.read.parquet(path).schema
            return True
        except AnalysisException:
            return False


def row_count(spark: SparkSession, target: str) -> int:
    """Rows in ``target``; 0 when it does not exist."""
    if not table_exists(spark, target):
        return 0
    return read_table(spark, target).select(F.count(F.lit(1))).first()[0]


def footer_stats(spark: SparkSession, folder: str, columns: Sequence[str] = ()) -> DataFrame:
    """``rows`` and, per column, ``min_<column>`` and ``max_<column>`` from the Parquet footers alone
    (SRC9): the reader of format version 2 takes the aggregate itself, no row is read.

    For integer, floating-point, boolean and date columns, which footers keep exactly.  The
    settings that this needs are those of a session of its own."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    sides = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return own.read.parquet(resolve(spark, folder)).agg(F.count(F.lit(1)).alias("rows"), *sides)


def sample(spark: SparkSession, target: str, n: int = 5) -> DataFrame:
    """A few rows for inspection (SRC10)."""
    return read_table(spark, target).limit(n)


def _is_path(target: str) -> bool:
    return "/" in target or "://" in target

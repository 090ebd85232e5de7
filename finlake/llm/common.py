"""Helpers shared by the training-data operators.

All staged tables live under ``spark.checkpoint.dir`` (shared by driver and
executors), so a lost executor costs a re-read, never a result.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.session import app_id, scratch_dir

ARROW_ROWS = 2000  # rows per Arrow batch: texts can be long

_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers and keep Arrow batches small."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(rows, "10000")) > ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))
    app = app_id(spark)
    if app not in _SHIPPED:
        pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        out = os.path.join(tempfile.mkdtemp(prefix="finlake-py-"), "finlake_package.zip")
        with zipfile.ZipFile(out, "w") as z:
            for folder, _, names in os.walk(pkg):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
        spark.sparkContext.addPyFile(out)
        _SHIPPED.add(app)
    return spark


def stage(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once to a fresh table in the shared folder and read it back."""
    path = f"{scratch_dir(df.sparkSession, 'llm-' + name)}/table"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(run: Callable) -> Callable:
    """A task function that hands freed memory back to the system when it ends: Python workers are
    reused, and what one stage has grown they would keep beside the next one's."""
    def wrapped(batches):
        yield from run(batches)
        release()
    return wrapped


def release() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def id_text(df: DataFrame) -> DataFrame:
    """The two columns the operators work on; every other column, whatever its
    name, is left behind.  A null text stays null."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"),
                     F.col("text").cast("string").alias("text"))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (Spark compares names without case)."""
    taken, name = {c.lower() for c in df.columns}, f"_{stem}"
    while name in taken:
        name = f"_{name}"
    return name


def text_digest(text: Column) -> Column:
    """16 bytes that tell texts apart; null for a null text."""
    return F.unhex(F.md5(text.cast("string").cast("binary")))


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id folds like the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)

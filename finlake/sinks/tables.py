"""Loads: append (SNK1), replace (SNK2), idempotent append (SNK3), marts (SNK8).

Appends are by column name against the target's schema (the reference inserts
positionally; a by-name insert with a strict check is the safe equivalent).
Row counts come from an ``Observation`` on the write itself.  Appends with keys,
and every batch of the streaming consumer, are written exactly once through the
commit ledger (``finlake.sinks.ledger``) and compared with the target's key index
(``finlake.sinks.key_index``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.operators.dedup import first_per_key
from finlake.operators.quality import Check, observe_failures, observed_failures
from finlake.sinks import check_log
from finlake.sinks.key_index import KEY, KeyIndex, key_of
from finlake.sinks.ledger import Ledger
from finlake.sinks.versions import Versions, resolve
from finlake.sources.tables import _is_path, read_table, row_count, table_exists


class SchemaMismatch(ValueError):
    pass


def load(df: DataFrame, target: str, mode: str = "append",
         dedupe_keys: Sequence[str] | None = None, fmt: str = "parquet",
         check_empty: bool = True, dedupe_scope: Sequence[str] | None = None,
         partition_by: Sequence[str] | None = None, checks: Sequence[Check] = (),
         versioned: bool = False) -> int:
    """Write ``df`` to ``target`` (Parquet path or catalog table); return rows written.

    * ``mode="append"``: creates the target (and the schema of a catalog table) on
      first use, else appends by name.  Rows are counted by an ``Observation`` on
      the write itself.  Only a first load is probed (``check_empty``): empty input
      makes no table, and nothing is ever deleted, since another feed may be
      writing there.
    * ``mode="replace"``: overwrite.  The input is probed first
      (``check_empty``): an empty replace keeps the old table intact.
    * ``versioned`` (replace of a path): write a fresh version and switch to it, so
      that a reader (``read_table``) sees the old rows or the new ones, never none.
      A target that has versions stays versioned; later loads go to the current one
    * ``dedupe_keys``: idempotent append — duplicates inside the batch are
      dropped, and rows that the target holds already are found by its key
      index; rows and index entries are written together, exactly once.  A row
      with a null key is known by its whole content.  A table that has an index
      keeps it up to date on every append through this function
    * ``dedupe_scope``: compare with the target's own rows instead, restricted to
      the batch's values of the named columns (columns every duplicate shares
      with its original, e.g. transaction year / month): without an index, and
      with the target partitioned by them, this reads a few partitions
    * ``partition_by``: partition columns of a newly created target
    * ``checks``: not-null and accepted-value checks to count during the write;
      the counts are logged beside a path target (``finlake.sinks.check_log``)
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "replace" and check_empty and df.isEmpty():
        return 0
    spark = df.sparkSession
    exists = table_exists(spark, target)
    if not exists and not _is_path(target) and "." in target:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {target.rpartition('.')[0]}")
    if mode == "append" and (dedupe_keys and not dedupe_scope
                             or exists and KeyIndex.of(spark, table_folder(spark, target))):
        if not exists and not _is_path(target):
            if check_empty and df.isEmpty():
                return 0
            _make_table(df, target, fmt, partition_by)
        ledger = Ledger(spark, f"{table_folder(spark, target)}/_ledger")
        out = Output("rows", df, target, dedupe_keys, partition_by, checks)
        return append_once(ledger, f"load-{uuid.uuid4().hex}", 0, [out])["rows"]
    if not exists and mode == "append" and check_empty and df.isEmpty():
        return 0
    current = read_table(spark, target) if mode == "append" and exists else None
    if current is not None:
        df = align_to(df, current.schema.fieldNames(), current.schema)
    if dedupe_keys:
        df = _dedupe(df, list(dedupe_keys), current, list(dedupe_scope or []))
    parts = _partition_columns(spark, target) if current is not None else list(partition_by or [])
    df = _rebalanced(df, parts)
    if mode == "append":
        return _write(df, table_folder(spark, target) if _is_path(target) else target, "append", fmt, parts, checks)
    versions = Versions(spark, target) if _is_path(target) else None
    if versions and (versioned or versions.current()):
        fresh = versions.fresh()
        rows = _write(df, fresh, "overwrite", fmt, parts, checks)
        versions.switch(fresh)
        return rows
    return _write(df, target, "overwrite", fmt, parts, checks)


def _write(df: DataFrame, target: str, mode: str, fmt: str, parts: Sequence[str], checks: Sequence[Check]) -> int:
    """One write job; its rows and failing rows are observed, and logged beside a path target."""
    df, obs = observe_failures(df, checks, "write")
    writer = df.write.mode(mode).format(fmt)
    if parts:
        writer = writer.partitionBy(*parts)
    if _is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)
    rows, failures = observed_failures(obs, checks)
    if checks and _is_path(target):
        check_log.add(df.sparkSession, target, f"write-{uuid.uuid4().hex}", rows, failures)
    return rows


@dataclass
class Output:
    """One table that a ledger batch appends to."""
    name: str
    rows: DataFrame
    target: str
    dedupe_keys: Sequence[str] | None = None
    partition_by: Sequence[str] | None = None
    checks: Sequence[Check] = ()


def append_once(ledger: Ledger, query: str, epoch: int, outputs: Sequence[Output]) -> dict[str, int]:
    """Append a batch to all its tables, exactly once for (query, epoch); rows written per output.

    A batch that has counted before is only published, not computed again.  An
    output without rows makes no table."""
    ledger.recover()
    if ledger.state(query, epoch) is None:
        staged = [e for out in outputs for e in _stage(ledger, query, epoch, out)]
        ledger.prepare(query, epoch, staged)
        ledger.publish(query, epoch)
        for out in outputs:
            _show(ledger.spark, out.target)
            index = KeyIndex.of(ledger.spark, table_folder(ledger.spark, out.target))
            if index and ledger.idle():
                index.compact()
    return ledger.rows(query, epoch)


def _stage(ledger: Ledger, query: str, epoch: int, out: Output) -> list[dict]:
    """Write one output and its index entries to the batch's staging folders."""
    spark, rows = ledger.spark, out.rows
    exists = table_exists(spark, out.target)
    current = read_table(spark, out.target) if exists else None
    if current is not None:
        rows = align_to(rows, current.schema.fieldNames(), current.schema)
    folder = table_folder(spark, out.target)
    if out.dedupe_keys:
        index = KeyIndex(spark, folder, out.dedupe_keys)
        if current is not None and not index.known:
            index.create(row_count(spark, out.target), current)
        rows = index.new_rows(rows).select(*rows.columns)
    else:
        index = KeyIndex.of(spark, folder)
    parts = _partition_columns(spark, out.target) if exists else list(out.partition_by or [])
    path = ledger.staging(query, epoch, out.name)
    seen, obs = observe_failures(_rebalanced(rows, parts), out.checks, "staged")
    writer = seen.write.format("parquet")
    (writer.partitionBy(*parts) if parts else writer).save(path)
    n, failures = observed_failures(obs, out.checks)
    if n == 0:
        return [{"name": out.name, "staged": ledger.staging(query, epoch, out.name), "target": folder, "rows": 0}]
    entries = [{"name": out.name, "staged": path, "target": folder, "rows": n,
                "failures": failures if out.checks and _is_path(out.target) else None}]
    if index:
        index.create(n)
        keys = spark.read.schema(rows.schema).parquet(path).select(key_of(rows.columns, index.keys).alias(KEY))
        path = ledger.staging(query, epoch, f"{out.name}-keys")
        index.write(keys, path)
        entries.append({"name": f"{out.name}-keys", "staged": path, "target": index.location, "rows": n})
    return entries


def _rebalanced(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of one partition folder side by side, in tasks of about the advisory size: small
    partitions get one file each, a hot one is split, whatever the number of input tasks."""
    return df.hint("rebalance", *[F.col(c) for c in parts]) if parts else df


def table_folder(spark: SparkSession, target: str) -> str:
    """The folder of a table: the path (its current version), or the location a catalog keeps for it."""
    if _is_path(target):
        return resolve(spark, target)
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def _make_table(df: DataFrame, target: str, fmt: str, partition_by: Sequence[str] | None) -> None:
    writer = df.filter("false").write.format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(target)


def _show(spark: SparkSession, target: str) -> None:
    """Let a catalog know about files that were moved into its table."""
    if not _is_path(target):
        if _partition_columns(spark, target):
            spark.sql(f"MSCK REPAIR TABLE {target}")
        spark.catalog.refreshTable(target)


def _dedupe(df: DataFrame, keys: list[str], current: DataFrame | None,
            scope: list[str]) -> DataFrame:
    """Drop in-batch duplicates and keys already in ``current``.

    Rows with a null key cannot be matched and pass through unchanged.
    Of several rows with one key the smallest payload stays, so a replay keeps
    the same row; the aggregation combines on the map side, so a hot key is
    collapsed before the shuffle; the anti join reads only the key (and
    scope) columns of the target, restricted to the batch's scope values.
    """
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    keyed = first_per_key(df.filter(has_key), keys, [], [c for c in df.columns if c not in keys]) \
        .select(*df.columns)
    if current is not None:
        seen = current.select(*keys, *scope).filter(has_key)
        if scope:
            # a narrow scan of the input; de-duplication keeps the set of values
            seen = _restrict_to_scope(seen, df.filter(has_key), scope)
        same = [F.col(f"new.{c}") == F.col(f"old.{c}") for c in keys]
        same += [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in scope]
        keyed = keyed.alias("new").join(seen.select(*keys, *scope).alias("old"),
                                        reduce(and_, same), "left_anti")
    return keyed.unionByName(df.filter(~has_key))


def _restrict_to_scope(seen: DataFrame, batch: DataFrame, scope: list[str]) -> DataFrame:
    """Target rows whose scope values occur in the batch (null equals null).  The
    planner picks the strategy; a small batch side prunes the target's partitions."""
    values = batch.select(*scope).distinct().alias("scope")
    same = [F.col(f"seen.{c}").eqNullSafe(F.col(f"scope.{c}")) for c in scope]
    return seen.alias("seen").join(values, reduce(and_, same), "left_semi")


def _partition_columns(spark, target: str) -> list[str]:
    """Partition columns of an existing target: from the catalog, or for a path from
    the first partition folder of each level (no file listing)."""
    if not _is_path(target):
        return [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(resolve(spark, target))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names: list[str] = []
    while folder is not None:
        entries, folder = fs.listStatusIterator(folder), None
        while folder is None and entries.hasNext():
            entry = entries.next()
            if entry.isDirectory() and "=" in entry.getPath().getName():
                folder = entry.getPath()
                names.append(folder.getName().split("=", 1)[0])
    return names


def align_to(df: DataFrame, names: Sequence[str], schema) -> DataFrame:
    """Select ``names`` in order; raise if a column is missing, extra or of another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    missing = [n for n in names if n not in have]
    extra = [n for n in have if n not in want]
    wrong = [n for n in names if n in have and have[n] != want[n]]
    if missing or extra or wrong:
        raise SchemaMismatch(f"missing={missing} extra={extra} type_mismatch={wrong}")
    return df.select(*names)


def write_mart(df: DataFrame, target: str, partition_by: Sequence[str] | None = None,
               checks: Sequence[Check] = ()) -> int:
    """Full-refresh materialisation of a mart (SNK8); returns rows written."""
    return _write(df, target, "overwrite", "parquet", list(partition_by or []), checks)

"""Declarative data-quality checks (DQ1-DQ4): each yields failing-row counts.

* not_null, accepted_values and unique checks of one table take one scan: rows
  are counted per value of the unique columns (grouping sets, combined on the
  map side), and the per-row failures are summed along;
* relationships: the child's non-null keys, all columns in one scan, are counted
  per key, then a left anti join against the parents' keys finds orphans;
* not_null and accepted_values are sums over rows, so a write can count them in
  passing (``observe_failures``).  The counts are logged beside the table
  (``finlake.sinks.check_log``); where the log accounts for every row of the
  table, ``run_checks`` takes them from there and scans for the rest only.

Every check returns rows ``(table_name, column_name, test_name, failures)``;
a check passes when ``failures == 0``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

RESULT_COLUMNS = ["table_name", "column_name", "test_name", "failures"]
RESULT = "table_name string, column_name string, test_name string, failures bigint"
PER_ROW = ("not_null", "accepted_values")


@dataclass(frozen=True)
class Check:
    column: str
    test: str  # unique | not_null | accepted_values | relationships
    values: tuple = ()
    to: str | None = None  # parent table name (relationships)
    field: str | None = None  # parent column (relationships)

    @property
    def label(self) -> str:
        """What the check log knows a per-row check by."""
        return "|".join([self.column, self.test, *map(str, self.values)])


@dataclass
class TableChecks:
    table: str
    checks: list[Check] = field(default_factory=list)


def _row(table: str, ck: Check, failures: Column) -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(ck.column).alias("column_name"),
                    F.lit(ck.test).alias("test_name"), failures.cast("bigint").alias("failures"))


def _rows(df: DataFrame, rows: Sequence[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def failing(ck: Check) -> Column:
    """Whether a row fails a not_null or accepted_values check (a null passes the latter)."""
    c = F.col(ck.column)
    return c.isNull() if ck.test == "not_null" else c.isNotNull() & ~c.isin(list(ck.values))


def observe_failures(df: DataFrame, checks: Sequence[Check], name: str) -> tuple[DataFrame, Observation]:
    """``df`` with its row count (``rows``) and the failures of its per-row checks (``f0``, ``f1``, ...
    in their order) observed by whatever action evaluates it first."""
    obs = Observation(name)
    sums = [F.coalesce(F.sum(failing(ck).cast("long")), F.lit(0)).alias(f"f{i}")
            for i, ck in enumerate(per_row(checks))]
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *sums), obs


def per_row(checks: Sequence[Check]) -> list[Check]:
    return [ck for ck in checks if ck.test in PER_ROW]


def observed_failures(obs: Observation, checks: Sequence[Check]) -> tuple[int, dict[str, int]]:
    """Rows and failures per check label of a finished ``observe_failures``."""
    got = obs.get
    return int(got.get("rows") or 0), {ck.label: int(got.get(f"f{i}") or 0) for i, ck in enumerate(per_row(checks))}


def scan_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame | None:
    """Unique, not_null and accepted_values checks of one table in one scan."""
    uniques = [ck for ck in checks if ck.test == "unique"]
    singles = per_row(checks)
    if not uniques and not singles:
        return None
    flags = [failing(ck).cast("long").alias(f"_f{i}") for i, ck in enumerate(singles)]
    narrow = df.select(*[F.col(ck.column).alias(f"_u{i}") for i, ck in enumerate(uniques)], *flags)
    sums = [F.sum(f"_f{i}").alias(f"_f{i}") for i in range(len(singles))]
    keys = [f"_u{i}" for i in range(len(uniques))]
    if not keys:
        counted = narrow.agg(*sums)
        return _rows(counted, [_row(table, ck, F.coalesce(f"_f{i}", F.lit(0))) for i, ck in enumerate(singles)])
    many = F.count(F.lit(1)).alias("_n")
    if len(keys) == 1:
        grouped = narrow.groupBy(*keys).agg(many, *sums, F.lit(0).alias("_set"))
        sets = [0]
    else:  # one grouping set per unique column; the bits of grouping_id name the absent columns
        grouped = narrow.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(
            many, *sums, F.grouping_id().alias("_set"))
        sets = [(1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i)) for i in range(len(keys))]
    total = [F.sum(F.when((F.col("_set") == s) & F.col(k).isNotNull() & (F.col("_n") > 1), 1)).alias(f"_t{i}")
             for i, (k, s) in enumerate(zip(keys, sets))]
    total += [F.sum(F.when(F.col("_set") == sets[0], F.col(f"_f{i}"))).alias(f"_f{i}") for i in range(len(singles))]
    return _rows(grouped.agg(*total), [
        *[_row(table, ck, F.coalesce(f"_t{i}", F.lit(0))) for i, ck in enumerate(uniques)],
        *[_row(table, ck, F.coalesce(f"_f{i}", F.lit(0))) for i, ck in enumerate(singles)]])


def relationship_checks(child: DataFrame, table: str, checks: Sequence[Check],
                        parents: Mapping[str, DataFrame]) -> DataFrame | None:
    """Child rows whose non-null key has no parent, for all relationships of a table.  Keys are
    integers or texts; they are counted first, so a hot key meets the parents as one row."""
    checks = [ck for ck in checks if ck.test == "relationships"]
    if not checks:
        return None
    keys = [f"_k{i}" for i in range(len(checks))]
    narrow = child.select(*[F.col(ck.column).alias(k) for ck, k in zip(checks, keys)])
    if len(keys) == 1:
        counted = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.lit(0).alias("_set"))
    else:
        counted = narrow.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(
            F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set"))
    # in a key's own set all other keys are null
    one = F.coalesce(*[F.when(F.col(k).isNotNull(), F.struct(F.lit(i).alias("_check"), F.col(k).cast("string").alias("_key")))
                       for i, k in enumerate(keys)])
    found = counted.select("_n", one.alias("_at")).filter("_at IS NOT NULL").select("_n", "_at.*")
    known = reduce(DataFrame.unionByName, [
        parents[ck.to].select(F.lit(i).alias("_check"), F.col(ck.field).cast("string").alias("_key"))
        for i, ck in enumerate(checks)])
    orphans = found.join(known, ["_check", "_key"], "left_anti")
    total = orphans.agg(*[F.sum(F.when(F.col("_check") == i, F.col("_n"))).alias(k) for i, k in enumerate(keys)])
    return _rows(total, [_row(table, ck, F.coalesce(k, F.lit(0))) for ck, k in zip(checks, keys)])


def run_checks(tables: Mapping[str, DataFrame], declared: Sequence[TableChecks],
               tests: Sequence[str] = ("unique", "not_null", "accepted_values", "relationships"),
               logged: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """All declared checks of the requested kinds as one DataFrame.

    ``logged``: per table the failures by check label that its writes have counted
    (``finlake.sinks.check_log.failures``); checks that are not in it are scanned for."""
    parts: list[DataFrame] = []
    taken: list[tuple] = []
    for tc in declared:
        df, log = tables[tc.table], (logged or {}).get(tc.table) or {}
        wanted = [ck for ck in tc.checks if ck.test in tests]
        known = [ck for ck in per_row(wanted) if ck.label in log]
        taken += [(tc.table, ck.column, ck.test, log[ck.label]) for ck in known]
        wanted = [ck for ck in wanted if ck not in known]
        parts += [p for p in (scan_checks(df, tc.table, wanted),
                              relationship_checks(df, tc.table, wanted, tables)) if p is not None]
    if taken:
        parts.append(next(iter(tables.values())).sparkSession.createDataFrame(taken, RESULT))
    return reduce(DataFrame.unionByName, parts).select(*RESULT_COLUMNS)

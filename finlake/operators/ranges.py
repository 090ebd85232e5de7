"""Dense keys 1..N in a global order from split points fixed before the shuffle (KEY1).

``row_number() over (order by x)`` sends every row through one task.  Here the
order is cut into ranges by a rule that every task evaluates alike:

1. a sample of the sort keys (``SAMPLE`` per range) gives split points, a quantile
   sketch over the whole composite key, so that a value that a third of all rows
   share is cut by the later columns;
2. a row's range is found by binary search among the points, as plain column
   arithmetic over array literals: deterministic, no second sampling;
3. rows per range are counted, and their running sum gives each range's offset;
4. key = offset + row_number within the range.

Steps 1 to 3 read the sort columns only, of ``keys`` where the caller knows a
cheaper frame with the same sort keys (the fact's keys are those of its staging
table, before any join).  Only step 4 evaluates the whole rows, once: nothing is
staged, and the caller's write is the only one.  Recomputed tasks get the same
numbers, since points and offsets are literals of the plan.

The driver holds ``SAMPLE`` keys and one count per range, ``MAX_RANGES`` ranges at
most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_RANGE = 50_000
MAX_RANGES = 16_384
SAMPLE = 16  # sampled keys per range
_RANGE = "_key_range"


def _split(name: str) -> tuple[str, bool]:
    return (name[1:], True) if name.startswith("-") else (name, False)


def ordering(order: Sequence[str]) -> list[Column]:
    """Sort columns, nulls last; a name with a leading ``-`` is descending."""
    return [F.col(n).desc_nulls_last() if down else F.col(n).asc_nulls_last() for n, down in map(_split, order)]


def split_points(keys: DataFrame, order: Sequence[str], ranges: int, rows: int) -> list[tuple]:
    """At most ``ranges`` - 1 sort keys (as texts) that cut ``keys`` into ranges of like size."""
    names = [_split(o)[0] for o in order]
    some = keys.select(*names).sample(min(1.0, SAMPLE * ranges / max(rows, 1)), seed=11)
    got = some.repartition(1).sortWithinPartitions(*ordering(order)).select(  # a bounded sample
        *[F.col(n).cast("string").alias(f"_{i}") for i, n in enumerate(names)]).collect()
    points = [tuple(got[len(got) * i // ranges]) for i in range(1, ranges)] if got else []
    return list(dict.fromkeys(points))


def range_of(df: DataFrame, order: Sequence[str], points: list[tuple], name: str = _RANGE) -> DataFrame:
    """Add the number of points that are not after the row: binary search, one step per column added."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    splits = [F.array(*[F.lit(p[i]) for p in points]).cast(T.ArrayType(kinds[_split(o)[0]]))
              for i, o in enumerate(order)] if points else []

    def before(place: Column) -> Column:
        """Whether the row sorts before the point at ``place``."""
        out = F.lit(False)
        for o, values in reversed(list(zip(order, splits))):
            (n, down), p = _split(o), F.get(values, place)
            less = F.coalesce(F.col(n) > p if down else F.col(n) < p, F.col(n).isNotNull() & p.isNull())
            out = less | (F.col(n).eqNullSafe(p) & out)
        return out

    out = df.withColumn(name, F.lit(0))
    for bit in reversed(range(len(points).bit_length())):
        step = 1 << bit
        ahead = (F.col(name) + step <= len(points)) & ~before(F.col(name) + (step - 1))
        out = out.withColumn(name, F.when(ahead, F.col(name) + step).otherwise(F.col(name)))
    return out


def dense_key(df: DataFrame, order: Sequence[str], key: str = "key", keys: DataFrame | None = None,
              weight: str | None = None, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``key`` (bigint, 1..N) following ``order`` (names; ``-name`` descends; nulls last).

    ``keys``: a frame with the leading sort columns of ``df``'s rows, and in column
    ``weight`` how many rows of ``df`` each of them stands for (default: one).
    The last sort columns of ``df`` may be missing there; they only order rows within
    a range.  With a unique order the numbering is deterministic."""
    keys = df if keys is None else keys
    lead = [o for o in order if _split(o)[0] in keys.columns]
    keys = keys.select(*[_split(o)[0] for o in lead], (F.col(weight) if weight else F.lit(1)).alias("_weight"))
    rows = keys.agg(F.coalesce(F.sum("_weight"), F.lit(0))).first()[0]
    ranges = min(MAX_RANGES, -(-rows // rows_per_range))
    points = split_points(keys, lead, ranges, rows) if ranges > 1 else []
    offsets, total = [], 0
    if points:
        count = {r[_RANGE]: r["n"] for r in range_of(keys, lead, points).groupBy(_RANGE).agg(
            F.sum("_weight").alias("n")).collect()}
        for i in range(len(points) + 1):
            offsets.append(total)
            total += count.get(i, 0)
    ranged = range_of(df, lead, points)
    place = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*ordering(order))).cast("bigint")
    if offsets:
        place = F.get(F.array(*[F.lit(n) for n in offsets]).cast("array<bigint>"), F.col(_RANGE)) + place
    return ranged.withColumn(key, place).select(*df.columns, key)

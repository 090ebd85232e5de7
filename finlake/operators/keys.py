"""Dense surrogate keys 1..N in a global order without a one-partition sort (KEY1).

``row_number() over (order by x)`` plans an ``Exchange SinglePartition``: every
row passes through one task.  This operator gives the same numbering with
distributed work:

1. ``repartitionByRange(n, order)`` samples split points over the full sort key
   (a hot value is split by the later sort columns, so no task has to hold one
   big group) and ``sortWithinPartitions`` orders each range;
2. ``monotonically_increasing_id`` then encodes (range index, position) and the
   rows are written once to a staging table in the shared checkpoint folder —
   this fixes the ranges: counting and numbering read the same files, and a
   lost executor cannot make them disagree (a re-run write task re-reads the
   same shuffle partition in the same sorted order);
3. per-range counts are read from the single ``_key_mid`` column (column
   pruning), turned into offsets by a running sum over that tiny table (one row
   per range, broadcast);
4. key = offset(range) + position + 1.

Without ``num_partitions`` the range count is left to adaptive execution: it
starts from ``spark.sql.shuffle.partitions`` and merges small *adjacent*
ranges, so partition indices stay in range order (a 30-row dimension does not
write 200 files).  With a unique order (add a tie-break column) the numbering
is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.session import scratch_dir

_MID, _PID, _CNT, _OFF = "_key_mid", "_key_pid", "_key_cnt", "_key_off"
_POS_BITS = 33


def sequence_key(df: DataFrame, order: Sequence[Column], key: str = "key",
                 num_partitions: int | None = None, staging: str | None = None) -> DataFrame:
    """Add ``key`` (bigint, 1..N) following ``order`` (give explicit null ordering).

    Eager: the ranged rows are written to ``staging`` (default: a fresh folder
    under ``spark.checkpoint.dir``); the returned DataFrame reads them back.
    """
    spark = df.sparkSession
    path = staging or f"{scratch_dir(spark, 'keys')}/ranged"
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    (ranged.sortWithinPartitions(*order)
       .withColumn(_MID, F.monotonically_increasing_id())
       .write.mode("overwrite").parquet(path))
    ranged = spark.read.parquet(path)
    pid = F.shiftright(F.col(_MID), _POS_BITS)
    counts = ranged.groupBy(pid.alias(_PID)).agg(F.count(F.lit(1)).alias(_CNT))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF))
    pos = F.col(_MID).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    out = ranged.withColumn(_PID, pid).join(F.broadcast(offsets), _PID, "inner")
    keyed = out.withColumn(key, (F.col(_OFF) + pos + 1).cast("bigint"))
    return keyed.select(*df.columns, key)

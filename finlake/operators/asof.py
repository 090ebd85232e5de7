"""As-of join (JOI1): for each left row, the latest right row at or before its date.

The reference writes a range join (``rate_date <= transaction_date``) and keeps
rank 1 per transaction, which pairs every transaction with every earlier rate.
Here the right side is turned into a *validity calendar* instead:

1. ``lead(time)`` per key gives each right row the interval it is valid for;
2. each interval is expanded to one row per day (``sequence`` + ``explode``), up
   to ``G``, the newest right date or the newest left date, whichever is earlier;
3. the left side joins on ``(key, least(left_date, G))`` — a pure equi-join,
   exactly one candidate per left row, no fan-out and no post-join ranking.

The calendar has (days spanned) x (keys) rows: it grows with the calendar, not
with the left side.  Its row count is checked; at most ``max_broadcast_rows`` it
is broadcast (no shuffle of the big side), above it the join is a shuffle
equi-join on (key, day) where adaptive execution splits skewed keys and day ``G``,
on which all later left rows meet, is dealt out to ``HORIZON_PARTS`` parts.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000  # ~100 MB of (currency, day, date, rate)
HORIZON_PARTS = 64


def validity_calendar(right: DataFrame, key: str, time: str, values: list[str],
                      horizon=None) -> DataFrame:
    """One row per (key, day) naming the right row valid that day.

    ``right`` must hold at most one row per (key, time).  Columns: ``key``,
    ``_asof_day`` (date), ``time`` (the right row's own date), ``values``.
    No interval runs beyond ``horizon`` (default: the newest date of ``right``,
    as a scalar subquery); right rows after it are left out.
    """
    if horizon is None:
        horizon = right.select(F.max(F.col(time).cast("date"))).scalar()
    w = Window.partitionBy(key).orderBy(time)
    r = right.select(key, F.col(time).cast("date").alias(time), *values)
    r = r.withColumn("_asof_next", F.lead(time).over(w))
    last_day = F.least(F.date_sub("_asof_next", 1), horizon)
    return r.filter(F.col(time) <= horizon).select(key, F.explode(F.sequence(F.col(time), last_day)).alias("_asof_day"),
                    time, *values)


def asof_join(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str,
              left_date: str, right_date: str, values: list[str],
              rename: dict[str, str] | None = None,
              max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
              wanted: Column | None = None) -> DataFrame:
    """Left outer as-of join on dates; adds ``values`` + ``right_date`` (renamed by ``rename``).

    Unmatched left rows (null key, null date, or dated before the key's first right row)
    get nulls.  ``wanted``: only rows for which this holds need a match.  Where the join
    shuffles, the others (and rows with a null key or date) do not enter it; a broadcast
    join moves no left row, so there they go along (the right side has nothing for them).
    """
    rename = rename or {}
    horizon, n_cal = _calendar_size(left, right, left_date, right_key, right_date)
    day = F.lit(horizon).cast("date")
    cal = validity_calendar(right, right_key, right_date, values, day)
    side = cal.select(
        F.col(right_key).alias("_asof_key"), "_asof_day",
        *[F.col(c).alias(rename.get(c, c)) for c in [right_date, *values]])
    probe = left.withColumn("_asof_probe", F.when(
        F.col(left_date).isNotNull(), F.least(F.col(left_date).cast("date"), day)))
    on = [("_asof_probe", "_asof_day")]
    if n_cal <= max_broadcast_rows:
        side = F.broadcast(side)
        rest = None
    else:  # all rows later than the horizon meet on one day: deal that day out
        plain = [f.name for f in left.schema.fields if isinstance(f.dataType, AtomicType)]
        probe = probe.withColumn("_asof_part", F.when(
            F.col("_asof_probe") == day, F.pmod(F.xxhash64(*plain), F.lit(HORIZON_PARTS))).otherwise(F.lit(0)))
        side = side.withColumn("_asof_copy", F.explode(F.when(
            F.col("_asof_day") == day, F.sequence(F.lit(0), F.lit(HORIZON_PARTS - 1))).otherwise(F.array(F.lit(0)))))
        on.append(("_asof_part", "_asof_copy"))
        find = F.col(left_key).isNotNull() & F.col("_asof_probe").isNotNull()
        find = find if wanted is None else F.coalesce(find & wanted, F.lit(False))
        probe, rest = probe.filter(find), probe.filter(~find)
    cond = probe[left_key] == side["_asof_key"]
    for a, b in on:
        cond = cond & (probe[a] == side[b])
    out = probe.join(side, cond, "left").drop("_asof_key", *[c for pair in on for c in pair])
    if rest is None:
        return out
    added = out.schema.fields[len(left.columns):]  # by position: a right name may repeat a left one
    return out.union(rest.select(*left.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in added]))


def _calendar_size(left: DataFrame, right: DataFrame, left_date: str, right_key: str, right_date: str):
    """Horizon and row count of the calendar, from one pass over the left dates and one
    over the right rows.  No day after the newest left date is needed, so a stray
    right date far in the future makes no rows."""
    newest = left.agg(F.max(F.col(left_date).cast("date"))).first()[0]
    own = F.col(right_date).cast("date")
    keys = right.filter(F.col(right_key).isNotNull()).groupBy(right_key).agg(
        F.min(own).alias("_low"), F.max(own).alias("_high"))
    size = keys.filter(F.col("_low") <= F.lit(newest).cast("date")).agg(
        F.max("_high").alias("high"), F.count("_low").alias("n"), F.sum(F.unix_date("_low").cast("long")).alias("low")).first()
    if not size["n"]:
        return None, 0
    horizon = min(size["high"], newest)
    return horizon, size["n"] * ((horizon - date(1970, 1, 1)).days + 1) - size["low"]

"""Keep one row per key (rank-1 de-duplication) as an aggregation.

``row_number() over (partition by k order by o) = 1`` sorts every key group.
``min``/``max`` of ``struct(o..., payload...)`` per key selects the same row with
partial (map-side) aggregation: a hot key costs one combined row per map task
instead of one huge sorted group.  Every ordering column is paired with a null
flag so nulls come last in both directions, as in the reference engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  payload: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (all ascending or all descending).

    Ties on ``order`` are broken by the ``payload`` columns in the same
    direction, so the result is deterministic.
    """
    rest = [p for p in payload if p not in order]
    fields = []
    for i, c in enumerate([*order, *rest]):
        flag = F.col(c).isNotNull() if descending else F.col(c).isNull()
        fields += [flag.alias(f"_n{i}"), F.col(c).alias(f"_v{i}")]
    carry = F.struct(*[F.col(c) for c in [*order, *rest]]).alias("_row")
    pick = F.max if descending else F.min
    best = pick(F.struct(*fields, carry)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best._row.*")

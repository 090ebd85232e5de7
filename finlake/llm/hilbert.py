"""Operator 9: sharding by Hilbert-curve order (DataFrame functions only).

Each metadata dimension is quantised into 2**bits cells of about equal depth
(split points by ``approx_percentile`` over all rows; a string counts as its rank
among the distinct values of its column).  The cells are turned
into the index on the Hilbert curve by a table of (state, cell bits) -> (index
digit, next state), built here from the curve's Gray-code rule.  Rows are put in
curve order (ties: id, then text checksum) by the library's distributed
numbering and cut into runs of equal row counts, so every file covers a compact
box of all dimensions and min/max statistics prune files on any of them.

Law ``rows``: the counts of any two shards differ by at most one.

Defined results: null values fall into cell 0; a null text has size 1; equal
rows stay in any order; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import stage
from finlake.operators.keys import sequence_key
from finlake.operators.ranges import dense_key


def _gray(i: int) -> int:
    return i ^ (i >> 1)


def _rotate(x: int, by: int, n: int) -> int:
    by %= n
    return ((x << by) | (x >> (n - by))) & ((1 << n) - 1)


def _ungray(g: int) -> int:
    out = 0
    while g:
        out ^= g
        g >>= 1
    return out


def _ones(i: int) -> int:
    """Trailing one bits."""
    n = 0
    while i & 1:
        n, i = n + 1, i >> 1
    return n


def curve_table(n: int) -> list[int]:
    """For state (entry corner, direction) and the n cell bits of one level, in
    that order: digit + 2**n * next state."""
    def corner(w: int) -> int:  # where the sub-curve of child w starts
        return 0 if w == 0 else _gray(2 * ((w - 1) // 2))

    def axis(w: int) -> int:  # the axis along which it runs
        if w == 0:
            return 0
        return _ones(w - 1 if w % 2 == 0 else w) % n

    out = []
    for entry in range(1 << n):
        for d in range(n):
            for bits in range(1 << n):
                w = _ungray(_rotate(bits ^ entry, -(d + 1), n))
                e2 = entry ^ _rotate(corner(w), d + 1, n)
                d2 = (d + axis(w) + 1) % n
                out.append(w + (1 << n) * (e2 * n + d2))
    return out


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Index of a point on the curve; each cell holds 0 .. 2**bits - 1."""
    n = len(cells)
    table = F.array(*[F.lit(x) for x in curve_table(n)])
    width = 1 << n

    def step(acc: Column, level: Column) -> Column:
        at = F.lit(0)
        for c in cells:
            at = at * 2 + (F.call_function("getbit", c.cast("int"), level)).cast("int")
        got = F.get(table, acc["state"] * width + at)
        return F.struct((acc["index"] * width + (got % width)).cast("long").alias("index"),
                        F.floor(got / width).cast("int").alias("state"))

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).cast("int").alias("state"))
    levels = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))
    return F.aggregate(levels, start, step, lambda acc: acc["index"])


VALUES_BOUND = 1_000_000  # bytes of distinct values that may be broadcast


def with_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the rank of a string among the distinct values of its column (null for null).
    The values are numbered in a distributed way; many of them are joined by a shuffle,
    in which adaptive execution splits a hot value."""
    values = df.select(F.col(column).alias("_value")).filter("_value IS NOT NULL").distinct()
    ranks = stage(dense_key(values, ["_value"], name), "hilbert-ranks")
    size = ranks.agg(F.coalesce(F.sum(F.octet_length("_value") + 16), F.lit(0))).first()[0]
    ranks = F.broadcast(ranks) if size <= VALUES_BOUND else ranks
    return df.join(ranks, df[column] == F.col("_value"), "left").drop("_value")


def _cell(value: Column, splits: list[float]) -> Column:
    """How many split points lie below the value; 0 for null."""
    points = F.array(*[F.lit(float(x)) for x in splits]).cast("array<double>")
    return F.when(value.isNull(), F.lit(0)).otherwise(F.size(F.filter(points, lambda s: s < value)))


def hilbert_order(df: DataFrame, dimensions: list[str], bits: int = 6) -> DataFrame:
    """Add ``curve`` (long): the row's place on the curve over ``dimensions``."""
    kinds, names = dict(df.dtypes), df.columns
    numbers = {}
    for i, c in enumerate(dimensions):
        if kinds[c] == "string":
            df = with_rank(df, c, f"_rank{i}")
        numbers[f"_d{i}"] = F.col(f"_rank{i}" if kinds[c] == "string" else c).cast("double")
    share = [i / (1 << bits) for i in range(1, 1 << bits)]
    splits = df.select(*[v.alias(k) for k, v in numbers.items()]).agg(
        *[F.percentile_approx(k, share, 10_000).alias(k) for k in numbers]).first()
    cells = [_cell(v, splits[k] or []) for k, v in numbers.items()]
    named = df.select(*names, F.array(*cells).alias("_cells"))
    return named.withColumn("curve", hilbert_index(
        [F.col("_cells")[i] for i in range(len(cells))], bits)).drop("_cells")


def shard_by_curve(df: DataFrame, dimensions: list[str], ties: list[str], shards: int = 8,
                   bits: int = 6) -> DataFrame:
    """Add curve, shard (0 .. shards - 1) and slot (gapless from 0 in its shard)."""
    curved = stage(hilbert_order(stage(df, "hilbert"), dimensions, bits), "hilbert-curve")  # read more than once
    ordered = sequence_key(curved, [F.col("curve"), *[F.col(c).asc_nulls_first() for c in ties]], "_rank")
    n = ordered.count()
    # shard s holds the ranks from ceil(s*n/shards) up to ceil((s+1)*n/shards) - 1
    out = ordered.withColumn("shard", F.expr(
        f"cast(((_rank - 1) * {shards}) div {max(n, 1)} as int)"))
    first = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    return out.withColumn("slot", F.col("_rank") - 1 - first).drop("_rank")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Documents without their texts: doc_id, size, text_crc32, the dimensions,
    curve, shard, slot.  Dimensions: lang, source, size."""
    text = F.encode(F.col("text").cast("string"), "utf-8")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    return shard_by_curve(narrow, ["lang", "source", "size"], ["doc_id", "text_crc32"], shards)


def write_shards(docs: DataFrame, path: str, dimensions: list[str], ties: list[str],
                 shards: int = 8, bits: int = 6) -> None:
    """Write whole rows, one folder per shard, in curve order."""
    out = shard_by_curve(docs, dimensions, ties, shards, bits)
    (out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path))


def digest(sharded: DataFrame) -> DataFrame:
    return sharded.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                          "slot", F.lit(None).cast("int").alias("grown_shard"))

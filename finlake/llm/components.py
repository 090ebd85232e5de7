"""Connected components of an edge table, without collecting links.

Alternating large-star / small-star steps: every node points its larger
neighbours (then its smaller ones and itself) at the smallest node it knows,
until each component is a star around its smallest id.  Every step is a grouped
minimum and an equi-join, written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import stage


def _point(sym: DataFrame, large: bool) -> DataFrame:
    """sym: (u, v) both ways, v the neighbour.  Edges (a, b) with b the smaller id."""
    low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = sym.join(low, "u")
    if large:
        got = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        got = joined.filter("v < u").select(F.col("v").alias("a"), F.col("m").alias("b")) \
            .unionByName(low.filter("m < u").select(F.col("u").alias("a"), F.col("m").alias("b")))
    return got.filter("a <> b").distinct()


def _both(e: DataFrame) -> DataFrame:
    return e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _stars(e: DataFrame) -> bool:
    """No centre hangs on another node, and no node on two centres."""
    chained = e.join(e.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty()
    return chained and e.groupBy("a").count().filter("count > 1").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label) for every node of ``edges``; label is the smallest id of its component."""
    e = stage(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
              .filter("a <> b").distinct(), "edges")
    while not _stars(e):
        e = stage(_point(_both(_point(_both(e), True)), False), "edges")
    return e.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct())

"""Operator 5: exact length histogram.

Documents are counted by encoded length (map-side combined, so a hot length
costs one row per task), and suffix sums over the histogram answer, for every
context limit, how many documents reach it, how many tokens all documents hold
and how many are left when every document is cut there.  The histogram has one
row per distinct length.  Suffix sums run in two levels (blocks of lengths, then
within a block), so no task sorts all of it.

Defined results: null and empty texts have length ``extra`` (1: the end id);
repeated rows count each time; an empty table gives an empty histogram.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.common import id_text, stage
from finlake.llm.tokens import default_vocabulary, tokenizer

BLOCK_BITS = 10


def _lengths(vocabulary: str, extra: int):
    def run(batches):
        tok = tokenizer(vocabulary)
        for b in batches:
            n = [len(x) // 4 + extra for x in tok.encode(b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64())],
                                             names=["doc_id", "n_tokens"])
    return run


def token_lengths(docs: DataFrame, vocabulary: str | None = None, extra: int = 1) -> DataFrame:
    """doc_id, n_tokens: the encoded length of every whole text."""
    return id_text(docs).mapInArrow(_lengths(vocabulary or default_vocabulary(), extra),
                                    "doc_id long, n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """length, n_docs; staged, so texts are tokenized once."""
    return stage(lengths.groupBy(F.col("n_tokens").alias("length")).agg(
        F.count(F.lit(1)).alias("n_docs")), "lengths")


def limits_report(hist: DataFrame) -> DataFrame:
    """One row per distinct length L taken as context limit: documents of that
    length, documents at least / at most that long, share of documents at most
    that long (the quantile that L answers), all tokens, tokens kept and lost
    when every document is cut at L."""
    h = hist.withColumn("_block", F.shiftright("length", BLOCK_BITS)) \
            .withColumn("_tokens", F.col("length") * F.col("n_docs"))
    later = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = h.groupBy("_block").agg(F.sum("n_docs").alias("_bd"), F.sum("_tokens").alias("_bt"))
    blocks = blocks.select(
        "_block", F.coalesce(F.sum("_bd").over(later), F.lit(0)).alias("_docs_later"),
        F.coalesce(F.sum("_bt").over(later), F.lit(0)).alias("_tokens_later"),
        F.sum("_bd").over(Window.partitionBy(F.lit(1))).alias("_all_docs"),
        F.sum("_bt").over(Window.partitionBy(F.lit(1))).alias("_all_tokens"))
    here = Window.partitionBy("_block").orderBy(F.col("length").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = h.join(blocks, "_block") \
        .withColumn("docs_at_least", F.col("_docs_later") + F.sum("n_docs").over(here)) \
        .withColumn("_tokens_at_least", F.col("_tokens_later") + F.sum("_tokens").over(here))
    kept = (F.col("_all_tokens") - F.col("_tokens_at_least")
            + F.col("docs_at_least") * F.col("length"))
    at_most = F.col("_all_docs") - F.col("docs_at_least") + F.col("n_docs")
    return s.select(
        "length", "n_docs", "docs_at_least", at_most.alias("docs_at_most"),
        (at_most / F.col("_all_docs")).alias("quantile"), F.col("_all_tokens").alias("total_tokens"),
        kept.alias("tokens_kept"), (F.col("_all_tokens") - kept).alias("tokens_lost"))


def totals_at(hist: DataFrame, limits: list[int]) -> DataFrame:
    """Tokens kept when every document is cut at each of the given limits."""
    sums = hist.agg(*[F.sum(F.least("length", F.lit(int(x))) * F.col("n_docs")).alias(f"k{i}")
                      for i, x in enumerate(limits)])
    pairs = F.array(*[F.struct(F.lit(int(x)).cast("long").alias("context_limit"),
                               F.coalesce(f"k{i}", F.lit(0)).alias("tokens_kept"))
                      for i, x in enumerate(limits)])
    return sums.select(F.inline(pairs))


def quantile_length(report: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least a share ``q`` of the documents does not exceed."""
    return report.filter(F.col("quantile") >= F.lit(q)).agg(F.min("length").alias("length"))

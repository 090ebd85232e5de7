"""A training corpus from ``documents``: five stages, each one of the operators.

Every stage reads all that the one before kept; each result is written as
Parquet to the shared folder and read again.  All but the last return the
columns of ``documents``, whatever further columns there are and however they are
named; the last returns packed sequences.

Defined results, by stage:

* null text: has no language and goes in the first stage;
* empty text and text without a letter: likewise, since it has no language.  Where
  nothing is labelled there is no model, and every text with a letter stays;
* null ids: each row is a document of its own, but for line de-duplication, where
  rows without an id count as one document, larger than any other;
* repeated rows: those with an id are equal in every stage and stay or go together;
  of equal texts without an id one stays;
* ties (equal texts under different ids, equal classes): the smallest id stays;
* very long texts are read whole; the last stage cuts them into several pieces;
* an empty table, and one whose rows all go, gives no rows, with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import decontaminate, language, line_dedup, ngram_join, packing
from finlake.llm.common import documents, fold, free_name, prepare, stage, text_digest

ORACLE_SQL = None  # language identification and tokenizing are not SQL; the tests compare every stage with plain Python


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters, null texts and texts of no clear language (without labels
    there is no model, and only texts without letters go)."""
    prepare(spark)
    learn = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(
        fold(F.col("doc_id"), 3) != 1)
    return language.keep_identified(docs, language.train(learn))


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that a document with a smaller id has; n_chars follows the text."""
    prepare(spark)
    names = docs.columns
    out = line_dedup.dedup_lines(docs, keep=names)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*names)


def deduplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest row of every class of near copies (and all texts without shingles).

    Rows go by id and text; of equal texts without an id one stays."""
    prepare(spark)
    names = docs.columns
    gone_id, gone_text, one, row = (free_name(docs, n) for n in ("gone", "gone_text", "one", "row"))
    texts = stage(ngram_join.surplus(docs.select("doc_id", "text")), "copies")
    gone = texts.filter("NOT top").select(F.col("doc_id").alias(gone_id), F.col("digest").alias(gone_text))
    digest = text_digest(F.col("text"))
    kept = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(gone_id)) & (digest == F.col(gone_text)), "left_anti")
    ones = texts.filter("top AND doc_id IS NULL").select(F.col("digest").alias(one))
    if ones.isEmpty():
        return kept
    none = kept.filter("doc_id IS NULL").withColumn(one, digest)
    single = none.join(ones, one, "left_semi").groupBy(one).agg(F.min(F.struct(*names)).alias(row))
    return kept.filter("doc_id IS NOT NULL").unionByName(none.join(ones, one, "left_anti").select(*names)) \
        .unionByName(single.select(f"{row}.*"))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    prepare(spark)
    return decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens, with their ids.

    A small cache of pre-tokens: the executors still hold memory of the stages before."""
    prepare(spark)
    return packing.pack(docs, cache=50_000)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", deduplicate_lines),
    ("ngram_join", deduplicate_documents),
    ("decontamination", remove_benchmark),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from finlake.llm import (cascade, decontaminate, fingerprints, hilbert, language, lattice, lexical, line_dedup,
                         ngram_join, packing, resampling, token_counts, toxicity)
from finlake.llm.common import documents, prepare


def op1_packing(spark, sf):
    return packing.digest(packing.pack(documents(spark, sf)))


def op2_ngram_join(spark, sf):
    return ngram_join.digest(ngram_join.join_components(documents(spark, sf)))


def op3_toxicity(spark, sf):
    docs = documents(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return toxicity.score(docs, toxicity.train(docs, toxicity.held_in(labels)))


def op4_lm_scoring(spark, sf):
    return lattice.score_documents(documents(spark, sf))


def op5_token_counts(spark, sf):
    return token_counts.limits_report(token_counts.histogram(token_counts.token_lengths(documents(spark, sf))))


def op6_decontamination(spark, sf):
    return decontaminate.find_leaks(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


def op7_fingerprints(spark, sf):
    return fingerprints.compare_with_next(documents(spark, sf))


def op8_line_dedup(spark, sf):
    return line_dedup.digest(line_dedup.dedup_lines(documents(spark, sf)))


def op9_sharding(spark, sf):
    return hilbert.digest(hilbert.shard_documents(documents(spark, sf)))


def op10_language_id(spark, sf):
    return language.identify(documents(spark, sf))


def op11_lexical_search(spark, sf):
    return lexical.search(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


def op12_quality_rules(spark, sf):
    return cascade.digest(cascade.judge(documents(spark, sf)))


def op13_resampling(spark, sf):
    return resampling.digest(resampling.resample(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")))


def pipeline(spark, sf):
    import corpus_pipeline
    return corpus_pipeline.run(prepare(spark), sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_ngram_join": op2_ngram_join,
    "op3_toxicity": op3_toxicity,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_token_counts": op5_token_counts,
    "op6_decontamination": op6_decontamination,
    "op7_fingerprints": op7_fingerprints,
    "op8_line_dedup": op8_line_dedup,
    "op9_sharding": op9_sharding,
    "op10_language_id": op10_language_id,
    "op11_lexical_search": op11_lexical_search,
    "op12_quality_rules": op12_quality_rules,
    "op13_resampling": op13_resampling,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op2_ngram_join": ngram_join.ORACLE,
    "op8_line_dedup": line_dedup.ORACLE,
    "op11_lexical_search": lexical.ORACLE,
    "op12_quality_rules": cascade.ORACLE,
}

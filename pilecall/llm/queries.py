"""Registered queries of the training-data operators and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversation_trie, decontam, html_extract, jaccard_join, langid, mixing, packing, quality_rules, secret_scan, suffix_dedup, token_counts, toxicity, whitening
from .common import table


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scanned(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_of(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op11_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_benchmark_decontamination,
        op2_secret_scan,
        op3_html_extraction,
        op4_language_id,
        op5_toxicity,
        op6_best_fit_packing,
        op7_suffix_array_dedup,
        op8_quality_rules,
        op9_token_counts,
        op10_ngram_jaccard_join,
        op11_mixing_sources,
        op12_conversation_trie,
        op13_embedding_whitening,
        pipeline,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op12_conversation_trie": conversation_trie.ORACLE}

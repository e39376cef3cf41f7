"""A training-data pipeline over ``documents``: five stages, each written and read again.

1. language ID: documents whose language isn't found go;
2. n-gram Jaccard join: of each group of near duplicates the smallest identifier stays;
3. benchmark decontamination: documents that hold a benchmark item go;
4. secret scan: the values of all secrets are replaced in the text;
5. best-fit packing: one row per token piece with its place in a training sequence.

Null or empty texts have no language and go in stage 1; repeated rows are near
duplicates of each other; all stages keep the columns of their input but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pilecall.llm import decontam, jaccard_join, langid, packing, secret_scan
from pilecall.llm.common import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_unleaked(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scan", redact_secrets),
    ("best-fit packing", pack_sequences),
]

# Learned language models, zstandard sizes and tokenizers are beyond SQL: the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs

"""Small inputs that every operator must survive, and registered-query helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


def docs_of(spark: SparkSession, texts: dict | list, lang: str | None = "en") -> DataFrame:
    """Documents from ``{doc_id: text}`` or ``[(doc_id, text)]``."""
    rows = list(texts.items()) if isinstance(texts, dict) else texts
    return spark.createDataFrame([(d, t, lang, "src0", len(t or "")) for d, t in rows], DOCS)


def odd_docs(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty and blank texts, repeated rows, one very long text, clashing extra columns."""
    long = " ".join(f"w{i % 977} token{i}" for i in range(20000))
    rows = [
        (1, None, "en", "src0", 0, 1.0, "x"),
        (2, "", "en", None, 0, 1.0, None),
        (3, "  \n\t ", None, "src0", None, None, "x"),
        (None, "some plain words of a text that stays here for all to read", "en", "src0", 1, 0.0, "x"),
        (5, "the same row twice over and over again in the table", "en", "src0", 1, 0.0, "x"),
        (5, "the same row twice over and over again in the table", "en", "src0", 1, 0.0, "x"),
        (6, long, "en", "src0", 1, 0.0, "x"),
        (7, "1234 5678 !!! ---", "de", "src0", 1, 0.0, "x"),
    ]
    return spark.createDataFrame(rows, DOCS + ", score double, kind string")


def empty_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)

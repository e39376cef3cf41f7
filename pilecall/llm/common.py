"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session (tests) without that setting gets a temporary folder.
    """
    conf = spark.sparkContext.getConf()
    d = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches, rows: int = 512):
    """Arrow batches cut into parts of ``rows`` rows, so that a Python worker holds few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def crc_mod(col: str, n: int) -> Column:
    """``crc32(col as text) mod n``; null for null."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def tokenizer_path(name: str) -> str:
    """Default place of a public tokenizer file on this machine."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def default_tokenizer() -> tuple[str, str]:
    """The public byte-level BPE vocabulary: its files of ranks and JSON."""
    return tokenizer_path("byte_bpe_50k.tiktoken"), tokenizer_path("byte_bpe_50k.json")


def drop_written(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that no later step reads, and free the shuffle files of finished jobs."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of jobs whose DataFrames are gone."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()

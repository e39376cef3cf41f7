"""Call filters besides G1 (which lives with call assembly): G2 noise, G3, G4."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pilecall.params import CallParams


def noise_flag(calls: DataFrame, p: CallParams) -> DataFrame:
    """Low-quality, low-depth alleles are noise (their counts are zeroed by the caller)."""
    q, cov = F.col("qual"), F.col("cnt")
    noise = (((q < 4.5) | ((q < 12) & ~F.col("qstd"))) & (cov <= 3)) | (
        (q < p.goodq) & (F.col("freq_raw") < 2 * p.lofreq) & (cov <= 1))
    return calls.withColumn("noise", noise)

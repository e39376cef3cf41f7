"""pilecall: small-variant calling from aligned reads as Spark DataFrame jobs.

Reads, reference sequence and target regions are DataFrames; every step is a
``DataFrame -> DataFrame`` function (see ``pilecall.operators``).
"""

from pilecall.params import CallParams

__all__ = ["CallParams"]

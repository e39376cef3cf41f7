"""Scalar column expressions shared by the operators (§2.11, F3, F12, G3, G4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns out of a generator: filters on them don't pass it, so no filter holds a second copy of the work."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def round_half_up(c, dp: int) -> Column:
    """Math.round(v * 10^dp) / 10^dp, i.e. floor(v * 10^dp + 0.5) / 10^dp."""
    s = float(10 ** dp)
    return F.floor(col(c) * F.lit(s) + F.lit(0.5)).cast("double") / F.lit(s)


def fixed_decimal(c, dp: int) -> Column:
    """A number as text with ``dp`` decimals, halves rounded up, whatever the locale."""
    return F.format_string(f"%.{dp}f", round_half_up(c, dp))


def strand_bias(fwd, rev, bias: float = 0.05, minb: int = 2) -> Column:
    """0: too few reads and one strand only, 1: biased, 2: both strands."""
    f, r = col(fwd), col(rev)
    tot = f + r
    return (
        F.when(tot <= 12, F.when(f * r > 0, F.lit(2)).otherwise(F.lit(0)))
        .when(
            (f / tot >= bias) & (r / tot >= bias) & (f >= minb) & (r >= minb), F.lit(2)
        )
        .otherwise(F.lit(1))
    )


def variant_type(ref, alt) -> Column:
    """SNV / Insertion / Deletion / Complex from the two alleles."""
    r, a = col(ref), col(alt)
    return (
        F.when((F.length(r) == 1) & (F.length(a) == 1), F.lit("SNV"))
        .when((F.length(r) == 0) | (F.length(a) == 0), F.lit("Complex"))
        .when(F.substring(r, 1, 1) != F.substring(a, 1, 1), F.lit("Complex"))
        .when((F.length(r) == 1) & (F.length(a) > 1) & a.startswith(r), F.lit("Insertion"))
        .when((F.length(r) > 1) & (F.length(a) == 1) & r.startswith(a), F.lit("Deletion"))
        .otherwise(F.lit("Complex"))
    )


def low_complexity(seq, frac: float = 0.75) -> Column:
    """True when one base makes up more than ``frac`` of the sequence."""
    s = col(seq)
    n = F.length(s)
    counts = [n - F.length(F.regexp_replace(s, b, "")) for b in "ACGT"]
    return F.when(n == 0, F.lit(True)).otherwise(F.greatest(*counts) / n > frac)


def homopolymer_start(seq) -> Column:
    """Second base onwards starts with 7 A or 7 T (G4: clips aligned to poly-A/T)."""
    return col(seq).rlike("^.(AAAAAAA|TTTTTTT)")


def strip_chr(c) -> Column:
    """Drop a leading 'chr' (-C)."""
    return F.regexp_replace(col(c), "^chr", "")

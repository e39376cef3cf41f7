"""Read-level filters (D1-D11). Each is a ``where`` (or one window for D6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pilecall.functions import cigar as cg
from pilecall.params import CallParams

SECONDARY = 0x100
REVERSE = 0x10
MATE_UNMAPPED = 0x8
SUPPLEMENTARY = 0x800


def with_read_columns(reads: DataFrame) -> DataFrame:
    """D14 lengths plus the mismatch count ``tnm = nm - (I + D)``."""
    out = cg.with_cigar_columns(reads)
    return out.withColumn("tnm", F.col("nm") - F.col("indel_len"))


def filter_flags(reads: DataFrame, p: CallParams) -> DataFrame:
    """Mapping quality, secondary / mask, missing sequence."""
    cond = F.col("seq") != "*"
    if p.min_mapq is not None:
        cond = cond & (F.col("mapq") >= p.min_mapq)
    if p.samfilter is not None:
        mask = p.samfilter if p.apply_full_mask else SECONDARY
        cond = cond & ((F.col("flag").bitwiseAND(F.lit(mask))) == 0)
    return reads.where(cond)


def filter_mismatch(reads: DataFrame, p: CallParams) -> DataFrame:
    """Drop reads without NM or with NM - indel length > mismatch."""
    if "tnm" not in reads.columns:
        reads = with_read_columns(reads)
    return reads.where(F.col("nm").isNotNull() & (F.col("tnm") <= p.mismatch))


def filter_supplementary(reads: DataFrame) -> DataFrame:
    """Drop supplementary alignments that carry an SA tag, mate mapped to the same contig."""
    if "sa_tag" not in reads.columns:
        raise ValueError("filter_supplementary needs the column sa_tag (null where the read has no SA tag)")
    drop = (
        (F.col("flag").bitwiseAND(F.lit(MATE_UNMAPPED)) == 0)
        & F.col("mate_chr").eqNullSafe(F.col("chr"))
        & F.col("sa_tag").isNotNull()
        & (F.col("flag").bitwiseAND(F.lit(SUPPLEMENTARY)) != 0)
    )
    return reads.where(~drop)


def filter_minmatch(reads: DataFrame, p: CallParams) -> DataFrame:
    """Minimum M+I length."""
    if not p.minmatch:
        return reads
    return reads.where(F.col("rlen1") >= p.minmatch)


def downsample(reads: DataFrame, fraction: float | None) -> DataFrame:
    """D1, deterministic: drop a read when its name hash falls below ``fraction``.

    The hash is md5-based so the SQL oracle can compute the same value.
    """
    if not fraction:
        return reads
    h = F.conv(F.substring(F.md5(F.concat_ws("|", "read_name", "sample", F.col("start_pos").cast("string"))), 1, 8), 16, 10).cast("long")
    return reads.where(h % 1000000 >= int(round(fraction * 1000000)))


def dedup(reads: DataFrame) -> DataFrame:
    """Keep the first read per sample and duplicate key.

    Key (start, mate contig, mate start) when mate start < 10, or
    (start, cigar) when the mate is unmapped; other reads always pass. The
    reference keeps whichever arrives first; here the order is ``read_name``.
    The first read is a map-side combined minimum, so a key with very many reads
    is no hot partition.
    """
    mate_ref = F.when(F.col("mate_chr").isNull(), F.lit("*")).when(
        F.col("mate_chr") == F.col("chr"), F.lit("=")
    ).otherwise(F.col("mate_chr"))
    key = (
        F.when(F.col("mate_start") < 10, F.concat_ws("-", F.col("start_pos").cast("string"), mate_ref, F.col("mate_start").cast("string")))
        .when(F.col("flag").bitwiseAND(F.lit(MATE_UNMAPPED)) != 0, F.concat_ws("-", F.col("start_pos").cast("string"), F.col("cigar")))
    )
    keyed = reads.withColumn("_dupkey", key)
    order = F.struct("read_name", "flag", "cigar", "seq")
    first = keyed.where(F.col("_dupkey").isNotNull()).groupBy("sample", "chr", "_dupkey").agg(
        F.min_by(F.struct(*reads.columns), order).alias("_first"))
    return first.select("_first.*").unionByName(keyed.where(F.col("_dupkey").isNull()).drop("_dupkey"))


def amplicon_filter(region_reads: DataFrame, p: CallParams) -> DataFrame:
    """Keep reads that belong to the amplicon (distance and overlap rules).

    Clipped reads are judged by overlap fraction only; unclipped paired reads use
    the whole insert.
    """
    segstart = F.col("start_pos")
    segend = F.col("start_pos") + F.col("md_len") - 1
    first_s = F.col("cigar").rlike(r"^\d+S")
    last_s = F.col("cigar").rlike(r"\d+S$")
    same = F.col("mate_chr") == F.col("chr")
    ins = F.col("insert_size")
    pe_start = F.when(same & (ins < 0), F.col("mate_start")).otherwise(segstart)
    pe_end = F.when(same & (ins > 0), segstart + ins - 1).when(same & (ins < 0), F.col("mate_start") - ins - 1).otherwise(segend)
    rs, re_ = F.col("region_start"), F.col("region_end")

    def ovl(s, e):
        ts1 = F.greatest(s, rs)
        te1 = F.least(e, re_)
        return ts1, te1

    ts1, te1 = ovl(segstart, segend)
    # try_divide: a one-base alignment has zero span (the original divides by zero too)
    clip_ok = F.try_divide(F.abs(ts1 - te1), (segend - segstart).cast("double")) > p.amplicon_overlap
    pts1, pte1 = ovl(pe_start, pe_end)
    pe_ok = ~(
        (F.abs(pe_start - rs) > p.amplicon_dist)
        | (F.abs(pe_end - re_) > p.amplicon_dist)
        | (F.abs(F.try_divide(pts1 - pte1, (pe_end - pe_start).cast("double"))) <= p.amplicon_overlap)
    )
    keep = F.when(first_s | last_s, F.coalesce(clip_ok, F.lit(False))).otherwise(F.coalesce(pe_ok, F.lit(False)))
    return region_reads.where(keep)


def apply_read_filters(reads: DataFrame, p: CallParams) -> DataFrame:
    """The live filter chain in reference order."""
    r = downsample(reads, p.downsample)
    r = filter_flags(r, p)  # cheap bit tests first: they reach the scan
    if p.remove_dups:
        r = dedup(r)  # before D7: a read with too many mismatches still marks its key
    r = with_read_columns(r)
    r = filter_mismatch(r, p)
    r = filter_supplementary(r)
    r = filter_minmatch(r, p)
    return r

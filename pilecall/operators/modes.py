"""Calling modes (I1 single sample, F15 pileup, I3 paired, I5 splice counts); I2 is in ``amplicon``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pilecall.operators import calls as C
from pilecall.operators.clips import clip_evidence
from pilecall.operators.joins import region_read_overlap
from pilecall.operators.mnp import mnp_adjust
from pilecall.operators.pileup import pileup, pileup_tables, splice_counts  # noqa: F401
from pilecall.functions.cigar import LENGTHS, with_cigar_columns
from pilecall.operators.normalize import normalize_cigar
from pilecall.operators.read_filters import apply_read_filters, filter_minmatch
from pilecall.params import CallParams


def regions_with_contigs(regions: DataFrame, contigs: DataFrame) -> DataFrame:
    """Attach the contig length (automatic broadcast: one row per contig)."""
    return regions.join(contigs.select("chr", F.col("length").alias("contig_len")), "chr", "left")


def region_reads(reads: DataFrame, regions: DataFrame, contigs: DataFrame, p: CallParams, ref_blocks: DataFrame | None = None) -> DataFrame:
    """Filtered reads joined to the regions they overlap (D-chain + C2).

    With ``p.normalize`` (needs ``ref_blocks``) CIGARs are normalised once per read (D15),
    after the mismatch filter and before the minimum match (D10); which regions a read
    belongs to is decided by its alignment as it came.
    """
    if p.realign:
        raise NotImplementedError("local realignment is not available; pass CallParams(realign=False)")
    regions = regions_with_contigs(regions, contigs)
    if not p.normalize:
        return region_read_overlap(regions, apply_read_filters(reads, p))
    if ref_blocks is None:
        raise ValueError("normalize needs ref_blocks")
    r = apply_read_filters(reads, p.with_(minmatch=0)).withColumns({"_from": F.col("start_pos"), "_to": F.col("end_pos")})
    r = normalize_cigar(r, ref_blocks, p.lowqual)
    r = with_cigar_columns(r.drop("ops", "end_pos", *LENGTHS))
    r = filter_minmatch(r, p).withColumnsRenamed({"start_pos": "_start", "end_pos": "_end", "_from": "start_pos", "_to": "end_pos"})
    joined = region_read_overlap(regions, r).drop("start_pos", "end_pos")
    return joined.withColumnsRenamed({"_start": "start_pos", "_end": "end_pos"})


def region_genes(regions: DataFrame, rr: DataFrame) -> DataFrame:
    """An empty gene name becomes the smallest read name of the region.

    Only regions without a gene look at reads (a semi-join on the small side);
    when every region has a gene, AQE sees the empty side and drops the read scan.
    """
    unnamed = regions.where(F.coalesce(F.col("gene"), F.lit("")) == "").select("region_id")
    first = rr.join(unnamed, "region_id", "left_semi").groupBy("region_id").agg(
        F.min("read_name").alias("_first_read"))
    g = regions.select("region_id", "gene").join(first, "region_id", "left")
    gene = F.when(F.coalesce(F.col("gene"), F.lit("")) == "", F.coalesce(F.col("_first_read"), F.lit(""))).otherwise(F.col("gene"))
    return g.select("region_id", gene.alias("gene"))


def called_alleles(rr: DataFrame, ref_blocks: DataFrame, p: CallParams) -> tuple[DataFrame, DataFrame]:
    """(alleles, splices) as the callers take them: the pileup, with E17 unless ``p.adjust_mnp`` is off."""
    alleles, splices = pileup_tables(rr, ref_blocks, p)
    if p.adjust_mnp:
        alleles = mnp_adjust(alleles, clip_evidence(rr, ref_blocks, p), ref_blocks)
    return alleles, splices


def candidate_calls(rr: DataFrame, ref_blocks: DataFrame, p: CallParams,
                    alleles: DataFrame | None = None) -> DataFrame:
    """Pileup -> allele statistics -> ranked, annotated non-reference alleles."""
    if alleles is None:
        alleles, _ = called_alleles(rr, ref_blocks, p)
    stats = C.allele_stats(alleles, ref_blocks, p)
    var = C.rank_alleles(stats, p)
    var = C.with_bias_pair(var)
    return C.call_alleles(var, ref_blocks, p)


def call_single(
    reads: DataFrame,
    regions: DataFrame,
    contigs: DataFrame,
    ref_blocks: DataFrame,
    p: CallParams,
    sample: str,
) -> DataFrame:
    """The flagship chain — filters, region join, pileup, statistics, filter, output."""
    rr = region_reads(reads, regions, contigs, p, ref_blocks)
    alleles, splices = called_alleles(rr, ref_blocks, p)
    var = candidate_calls(rr, ref_blocks, p, alleles)
    var = C.good_variant_flag(var, splices, p)
    var = var.where(~F.col("ref_allele").contains("N"))
    if not p.pileup:
        var = var.where(F.col("good"))
    var = C.complex_trim(var)
    genes = region_genes(regions, rr)
    var = var.join(genes, "region_id", "left")
    return C.finalize_calls(var, sample)


def _ref_rows(stats: DataFrame, sample: str) -> DataFrame:
    """positions where only the reference allele was seen (pileup mode)."""
    w = Window.partitionBy("region_id", "pos")
    s = stats.withColumn("_nvar", F.count(F.when(~F.col("is_ref"), 1)).over(w))
    r = s.where(F.col("is_ref") & (F.col("_nvar") == 0))
    region = F.concat(F.col("chr"), F.lit(":"), F.col("region_start").cast("string"), F.lit("-"), F.col("region_end").cast("string"))
    return r.select(
        "region_id", "pos", F.lit(sample).alias("sample"), "chr",
        F.col("pos").alias("start"), F.col("pos").alias("end"),
        F.col("ref_base").alias("ref_allele"), F.col("ref_base").alias("alt_allele"),
        F.col("tcov").cast("long").alias("tcov"), F.lit(0).cast("long").alias("cov"),
        F.col("fwd").cast("long").alias("rfc"), F.col("rev").cast("long").alias("rrc"),
        F.lit(0).cast("long").alias("fwd"), F.lit(0).cast("long").alias("rev"),
        F.concat(F.col("ref_base"), F.lit("/"), F.col("ref_base")).alias("genotype"),
        F.lit(0.0).alias("freq"), F.concat(F.col("bias_flag").cast("string"), F.lit(";0")).alias("bias"),
        "pmean", F.col("pstd").cast("int").alias("pstd"), "qual", F.col("qstd").cast("int").alias("qstd"),
        C.round_half_up(F.col("mapq_raw"), 1).alias("mapq"), C.round_half_up(F.col("qratio_raw"), 3).alias("qratio"),
        C.round_half_up(F.col("hifreq_raw"), 4).alias("hifreq"), F.lit(0.0).alias("extrafreq"),
        F.lit(0).alias("shift3"), F.lit(0.0).alias("msi"), F.lit(0).alias("msint"),
        C.round_half_up(F.col("nm_raw"), 1).alias("nm"), F.col("hicnt").cast("long").alias("hicnt"),
        F.col("hicov").cast("long").alias("hicov"), F.lit("0").alias("leftseq"), F.lit("0").alias("rightseq"),
        region.alias("region"), F.lit("").alias("vartype"),
    )


def _empty_rows(regions: DataFrame, covered: DataFrame, sample: str) -> DataFrame:
    """a zero row for every region position without any allele (bounded by target size)."""
    pos = regions.select("region_id", "chr", "region_start", "region_end",
                         F.explode(F.sequence("region_start", "region_end")).alias("pos"))
    pos = pos.join(covered.select("region_id", "pos").distinct(), ["region_id", "pos"], "left_anti")
    region = F.concat(F.col("chr"), F.lit(":"), F.col("region_start").cast("string"), F.lit("-"), F.col("region_end").cast("string"))
    z, zl, zd = F.lit(0), F.lit(0).cast("long"), F.lit(0.0)
    return pos.select(
        "region_id", "pos", F.lit(sample).alias("sample"), "chr", F.col("pos").alias("start"), F.col("pos").alias("end"),
        F.lit("").alias("ref_allele"), F.lit("").alias("alt_allele"), zl.alias("tcov"), zl.alias("cov"), zl.alias("rfc"),
        zl.alias("rrc"), zl.alias("fwd"), zl.alias("rev"), F.lit("").alias("genotype"), zd.alias("freq"),
        F.lit("0;0").alias("bias"), zd.alias("pmean"), z.alias("pstd"), zd.alias("qual"), z.alias("qstd"), zd.alias("mapq"),
        zd.alias("qratio"), zd.alias("hifreq"), zd.alias("extrafreq"), z.alias("shift3"), zd.alias("msi"), z.alias("msint"),
        zd.alias("nm"), zl.alias("hicnt"), zl.alias("hicov"), F.lit("0").alias("leftseq"), F.lit("0").alias("rightseq"),
        region.alias("region"), F.lit("").alias("vartype"),
    )


def call_pileup(
    reads: DataFrame,
    regions: DataFrame,
    contigs: DataFrame,
    ref_blocks: DataFrame,
    p: CallParams,
    sample: str,
) -> DataFrame:
    """F15 (-p): every region position — all alleles unfiltered, the reference row, or a zero row."""
    p = p.with_(pileup=True, freq=-1.0, minr=0)
    rr = region_reads(reads, regions, contigs, p, ref_blocks)
    alleles, splices = called_alleles(rr, ref_blocks, p)
    stats = C.allele_stats(alleles, ref_blocks, p)
    var = C.rank_alleles(stats, p)
    var = C.with_bias_pair(var)
    var = C.call_alleles(var, ref_blocks, p)
    var = var.where(~F.col("ref_allele").contains("N"))
    var = C.complex_trim(var)
    var_rows = C.finalize_calls(var.withColumn("gene", F.lit(None).cast("string")), sample).drop("gene")
    ref_rows = _ref_rows(stats, sample)
    empty = _empty_rows(regions, stats, sample)
    out = var_rows.unionByName(ref_rows).unionByName(empty)
    genes = region_genes(regions, rr)
    return out.join(genes, "region_id", "left")


def _sample_calls(reads, regions, contigs, ref_blocks, p):
    rr = region_reads(reads, regions, contigs, p, ref_blocks)
    alleles, splices = called_alleles(rr, ref_blocks, p)
    stats = C.allele_stats(alleles, ref_blocks, p)
    var = C.with_bias_pair(C.rank_alleles(stats, p, keep_quiet=True))
    var = C.call_alleles(var, ref_blocks, p)
    positions = stats.select("region_id", "pos").distinct()
    return var, splices, positions


def call_paired(
    tumor: DataFrame,
    normal: DataFrame,
    regions: DataFrame,
    contigs: DataFrame,
    ref_blocks: DataFrame,
    p: CallParams,
) -> DataFrame:
    """Somatic classification of tumor vs normal alleles per position.

    Positions of both samples meet in a full outer join (C10). Tumor alleles
    are taken in rank order while they pass G1; each is matched to the same
    allele in the normal: good there -> LikelyLOH/Germline, present but not good
    -> LikelySomatic/AFDiff (StrongSomatic when the normal allele is noise and an
    SNV), absent -> StrongSomatic. Positions covered in one sample only give
    Deletion / SampleSpecific; a normal-only good top allele gives
    LikelyLOH/Germline/StrongLOH. The combined re-analysis (I4) is not built.
    """
    from pilecall.operators.filters import noise_flag

    v1, sp1, pos1 = _sample_calls(tumor, regions, contigs, ref_blocks, p)
    v2, sp2, pos2 = _sample_calls(normal, regions, contigs, ref_blocks, p)
    splices = sp1.unionByName(sp2)
    v1 = C.complex_trim(C.good_variant_flag(v1, splices, p))
    v2 = noise_flag(C.complex_trim(C.good_variant_flag(v2, splices, p)), p)
    key = ["region_id", "pos"]
    v1 = v1.withColumn("first_bad", F.min(F.when(~F.col("good"), F.col("rank"))).over(Window.partitionBy(*key)))
    cols = ["allele", "rank", "good", "vartype", "sp", "ep", "ref_allele", "alt_allele", "cnt", "tcov", "freq_raw"]
    t = v1.select(*key, *[F.col(c).alias("t_" + c) for c in cols + ["first_bad"]])
    n = v2.select(*key, *[F.col(c).alias("n_" + c) for c in cols + ["noise"]])
    cov = pos1.withColumn("c1", F.lit(True)).join(pos2.withColumn("c2", F.lit(True)), key, "full")
    nvar = t.groupBy(*key).agg(F.count(F.lit(1)).alias("nv1"), F.max(F.when(F.col("t_rank") == 1, F.col("t_good"))).alias("g1"))
    cov = cov.join(nvar, key, "left").withColumn("nv1", F.coalesce("nv1", F.lit(0)))

    def out(df, src, status):
        def num(c, zero):
            return F.coalesce(F.col(c), F.lit(zero)) if c in df.columns else F.lit(zero)

        tc = [num(f"t_{c}", 0).cast("long") for c in ("cnt", "tcov")]
        nc = [num(f"n_{c}", 0).cast("long") for c in ("cnt", "tcov")]
        return df.select(
            *key, F.col(f"{src}_allele").alias("allele"), status.alias("status"), F.col(f"{src}_vartype").alias("vartype"),
            F.col(f"{src}_sp").cast("long").alias("start"), F.col(f"{src}_ep").cast("long").alias("end"),
            F.col(f"{src}_ref_allele").alias("ref_allele"), F.col(f"{src}_alt_allele").alias("alt_allele"),
            tc[0].alias("tumor_cov"), tc[1].alias("tumor_tcov"),
            C.round_half_up(num("t_freq_raw", 0.0), 4).alias("tumor_freq"),
            nc[0].alias("normal_cov"), nc[1].alias("normal_tcov"),
            C.round_half_up(num("n_freq_raw", 0.0), 4).alias("normal_freq"))

    n_top = n.where((F.col("n_rank") == 1) & F.col("n_good"))
    t_top = t.where((F.col("t_rank") == 1) & F.col("t_good"))
    # a. normal only: Deletion; b. tumor only: SampleSpecific (top allele, when good)
    r_a = out(cov.where(F.col("c1").isNull()).join(n_top, key), "n", F.lit("Deletion"))
    r_b = out(cov.where(F.col("c2").isNull()).join(t_top, key), "t", F.lit("SampleSpecific"))
    both = cov.where(F.col("c1") & F.col("c2"))
    # c1. tumor alleles in rank order until the first bad one, matched in the normal
    good1 = t.where(F.col("t_first_bad").isNull() | (F.col("t_rank") < F.col("t_first_bad")))
    g = both.select(*key).join(good1, key)
    nk = n.withColumnsRenamed({"region_id": "_kr", "pos": "_kp"})
    m = g.join(nk, (F.col("region_id") == F.col("_kr")) & (F.col("pos") == F.col("_kp"))
               & (F.col("t_allele") == F.col("n_allele")), "left").drop("_kr", "_kp")
    f1, f2 = F.col("t_freq_raw"), F.col("n_freq_raw")
    status = (
        F.when(F.col("n_allele").isNull(), F.lit("StrongSomatic"))
        .when(F.col("n_noise") & (F.col("t_vartype") == "SNV"), F.lit("StrongSomatic"))
        .when(F.col("n_good") & (f1 > 1 - p.lofreq) & (f2 < 0.8) & (f2 > 0.2), F.lit("LikelyLOH"))
        .when(F.col("n_good"), F.lit("Germline"))
        .when((f2 < p.lofreq) | (F.col("n_cnt") <= 1), F.lit("LikelySomatic"))
        .otherwise(F.lit("AFDiff"))
    )
    r_c1 = out(m, "t", status)
    # c2/c3. first tumor allele bad, or tumor reference-only: the normal's good top allele decides
    lead = both.where((F.col("nv1") == 0) | ~F.coalesce(F.col("g1"), F.lit(True))).select(*key, "nv1").join(n_top, key)
    tk = t.withColumnsRenamed({"region_id": "_kr", "pos": "_kp"})
    lb = lead.join(tk, (F.col("region_id") == F.col("_kr")) & (F.col("pos") == F.col("_kp"))
                   & (F.col("n_allele") == F.col("t_allele")), "left").drop("_kr", "_kp")
    hit = F.col("t_allele").isNotNull() & (F.col("nv1") > 0)
    r_c2 = out(lb.where(hit), "t", F.when(F.col("t_freq_raw") < p.lofreq, F.lit("LikelyLOH")).otherwise(F.lit("Germline")))
    r_c3 = out(lb.where(~hit), "n", F.lit("StrongLOH"))
    return r_a.unionByName(r_b).unionByName(r_c1).unionByName(r_c2).unionByName(r_c3)

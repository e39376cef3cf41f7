"""Query catalogue: one DataFrame-returning function per operator.

Every query reads the driver tables through the derived fixtures, so its work
grows with them. Column names match the SQL oracles in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pilecall.fixtures import fixtures
from pilecall.functions.exprs import low_complexity, strip_chr
from pilecall.operators import calls as C
from pilecall.operators import joins as J
from pilecall.operators import modes as M
from pilecall.operators import pileup as PU
from pilecall.operators import read_filters as RF
from pilecall.operators import regions as RG
from pilecall.params import CallParams

# The oracle-checked configuration: reference defaults with local realignment
# off (-k 0); realignment has its own queries.
CHECK = CallParams(realign=False, adjust_mnp=False)


def _fx(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return fixtures(spark, sf)


def _rr(spark, sf, p: CallParams = CHECK, sample: str | None = None) -> DataFrame:
    fx = _fx(spark, sf)
    reads = fx["reads"] if sample is None else fx["reads"].where(F.col("sample") == sample)
    return M.region_reads(reads, fx["regions"], fx["contigs"], p)


def _alleles(spark, sf, p: CallParams = CHECK) -> DataFrame:
    return PU.pileup(_rr(spark, sf, p), _fx(spark, sf)["ref_blocks"], p)


def _candidates(spark, sf, p: CallParams = CHECK) -> DataFrame:
    fx = _fx(spark, sf)
    return M.candidate_calls(_rr(spark, sf, p), fx["ref_blocks"], p)


# -- B: regions --------------------------------------------------------------

def q_region_parse(spark, sf):
    fx = _fx(spark, sf)
    text = fx["regions"].select(F.concat_ws("", F.col("chr"), F.lit(":"), F.format_number(F.col("region_start"), 0),
                                            F.lit("-"), F.col("region_end").cast("string"), F.lit(":"), F.col("gene")).alias("text"))
    return RG.region_parse(text, "text", extend=5, zero_based=False)


def q_segment_explode(spark, sf):
    return RG.segment_explode(_fx(spark, sf)["segments"], extend=0, zero_based=False)


def q_region_lines(spark, sf):
    fx = _fx(spark, sf)
    tab = "\t"
    bed = fx["regions"].select(F.concat_ws(tab, "chr", F.col("region_start").cast("string"), F.col("region_end").cast("string"), "gene").alias("line"))
    gap = [F.lit("x")]
    table = fx["segments"].select(F.concat_ws(tab, F.lit("1"), F.lit("n"), "chr", *gap, *gap, *gap, F.col("cds_start").cast("string"), F.col("cds_end").cast("string"),
                                              *gap, "seg_starts", "seg_ends", *gap, "gene").alias("line"))
    return RG.region_lines(bed.unionByName(table), "line")


def q_amplicon_groups(spark, sf):
    return RG.amplicon_groups(_fx(spark, sf)["amplicons"])


def q_chr_normalize(spark, sf):
    fx = _fx(spark, sf)
    return RG.chr_normalize(fx["segments"].select("segment_id", "chr"), fx["contigs"])


def q_strip_chr(spark, sf):
    return _fx(spark, sf)["regions"].select("region_id", strip_chr("chr").alias("chr"))


def q_region_flank(spark, sf):
    fx = _fx(spark, sf)
    return J.region_flank(fx["regions"], fx["contigs"], 700).select("region_id", "flank_start", "flank_end")


# -- C: joins ----------------------------------------------------------------

def q_region_read_overlap(spark, sf):
    fx = _fx(spark, sf)
    reads = RF.with_read_columns(fx["reads"])
    rr = J.region_read_overlap(fx["regions"], reads)
    return rr.select("region_id", "read_name", "sample", "start_pos", "end_pos", "cigar")


def q_region_ref_window(spark, sf):
    fx = _fx(spark, sf)
    return J.region_ref_window(fx["regions"], fx["ref_blocks"], 700)


def q_region_nonempty(spark, sf):
    fx = _fx(spark, sf)
    reads = RF.with_read_columns(fx["reads"])
    return RG.region_nonempty(fx["regions"], fx["ref_blocks"], reads, flank=700)


def q_splice_antijoin(spark, sf):
    fx = _fx(spark, sf)
    cand = _candidates(spark, sf).select("region_id", "pos", "allele", "sp", "ep", "ref_allele", "alt_allele")
    cand = cand.withColumn("vartype", F.lit("Deletion"))
    kept = J.splice_antijoin(cand, PU.splice_counts(_rr(spark, sf)))
    return kept.select("region_id", "pos", "allele")


# -- D: read filters ---------------------------------------------------------

def q_read_filter_flags(spark, sf):
    p = CHECK.with_(min_mapq=20, apply_full_mask=True)
    r = RF.filter_flags(_fx(spark, sf)["reads"], p)
    return r.select("read_name", "sample", "start_pos", "flag", "mapq")


def q_read_filter_mismatch(spark, sf):
    r = RF.filter_mismatch(RF.with_read_columns(_fx(spark, sf)["reads"]), CHECK.with_(mismatch=1))
    return r.select("read_name", "sample", "start_pos", "cigar", "nm", "tnm")


def q_read_dedup(spark, sf):
    r = RF.dedup(_fx(spark, sf)["reads"].withColumn("mate_start", F.col("mate_start") % 12))
    return r.select("read_name", "sample", "start_pos", "cigar", "mate_start")


def q_read_downsample_hash(spark, sf):
    r = RF.downsample(_fx(spark, sf)["reads"], 0.3)
    return r.select("read_name", "sample", "start_pos")


def q_amplicon_read_filter(spark, sf):
    fx = _fx(spark, sf)
    amp = fx["amplicons"].select(F.col("amplicon_id").alias("region_id"), "chr",
                                 F.col("amp_start").alias("region_start"), F.col("amp_end").alias("region_end"))
    reads = RF.with_read_columns(fx["reads"])
    rr = J.region_read_overlap(amp, reads)
    return RF.amplicon_filter(rr, CHECK).select("region_id", "read_name", "sample", "start_pos")


def q_cigar_lengths(spark, sf):
    r = RF.with_read_columns(_fx(spark, sf)["reads"])
    return r.select("read_name", "sample", "start_pos", "cigar", "ref_span", "end_pos", "rlen1", "rlen2", "indel_len")


def q_read_length_max(spark, sf):
    rr = _rr(spark, sf, sample=None)
    return rr.groupBy("region_id").agg(F.max("rlen2").alias("max_rlen"))


def q_cigar_normalize(spark, sf):
    from pilecall.operators.normalize import normalize_cigar

    fx = _fx(spark, sf)
    r = normalize_cigar(RF.with_read_columns(fx["edge_reads"]), fx["ref_blocks"], CHECK.lowqual)
    return r.select("read_name", "sample", "seq", "start_pos", "cigar")


# -- E: pileup ---------------------------------------------------------------

_ACC = ["region_id", "pos", "allele", "cnt", "fwd", "rev", "tp_sum", "q_sum", "mq_sum", "nm_sum", "hicnt", "locnt", "pstd", "qstd"]


def q_base_pileup(spark, sf):
    a = _alleles(spark, sf)
    return a.where((F.col("allele") != "") & ~F.col("is_ins") & ~F.col("allele").startswith("-")).select(*_ACC)


def q_insertion_pileup(spark, sf):
    return _alleles(spark, sf).where(F.col("is_ins")).select(*_ACC)


def q_deletion_pileup(spark, sf):
    return _alleles(spark, sf).where(F.col("allele").startswith("-")).select(*_ACC)


def q_complex_indels(spark, sf):
    from pilecall.operators.compound import complex_indels

    fx = _fx(spark, sf)
    rr = M.region_reads(fx["edge_reads"], fx["regions"], fx["contigs"], CHECK)
    out = complex_indels(rr, fx["ref_blocks"], CHECK).select(*_ACC, "is_ins", "cov_add")
    return out.fillna(False, ["pstd", "qstd"])  # null where a row only carries coverage


def q_coverage(spark, sf):
    cov = PU.coverage(_rr(spark, sf), _fx(spark, sf)["ref_blocks"], CHECK)
    return cov.where((F.col("pos") >= F.col("region_start")) & (F.col("pos") <= F.col("region_end"))).select("region_id", "pos", "cov")


def q_splice_counts(spark, sf):
    return PU.splice_counts(_rr(spark, sf, sample=None))


def _clip_table(spark, sf):
    from pilecall.operators.clips import clip_bases, softclip_table

    return softclip_table(clip_bases(_rr(spark, sf), _fx(spark, sf)["ref_blocks"], CHECK))


def q_softclip_collect(spark, sf):
    return _clip_table(spark, sf)


def q_softclip_consensus(spark, sf):
    from pilecall.operators.clips import softclip_consensus

    return softclip_consensus(_clip_table(spark, sf))


def q_spanning_reads(spark, sf):
    from pilecall.operators.realign import spanning_reads

    fx = _fx(spark, sf)
    plain_del = F.col("allele").rlike(r"^-\d+$")  # plain deletion alleles (filter on a base column)
    dels = _candidates(spark, sf).where(plain_del).select(
        F.concat_ws(":", F.col("region_id").cast("string"), F.col("pos").cast("string"), "allele").alias("interval_id"),
        "chr", F.col("sp").alias("s"), F.col("ep").alias("e"))
    reads = RF.with_read_columns(fx["reads"])
    return spanning_reads(dels, reads)


def q_breakpoint_search(spark, sf):
    from pilecall.operators.clips import softclip_consensus
    from pilecall.operators.realign import breakpoint_search

    fx = _fx(spark, sf)
    return breakpoint_search(softclip_consensus(_clip_table(spark, sf)), fx["ref_blocks"], fx["regions"], fx["contigs"])


def q_clip_pair_join(spark, sf):
    from pilecall.operators.clips import softclip_consensus
    from pilecall.operators.realign import clip_pair_join

    rlen = _rr(spark, sf).groupBy("region_id").agg(F.max("rlen2").alias("max_rlen"))
    return clip_pair_join(softclip_consensus(_clip_table(spark, sf)), rlen)


def q_position_amplicons(spark, sf):
    fx = _fx(spark, sf)
    pos = _candidates(spark, sf).select("chr", "pos").distinct()
    return J.position_amplicons(pos, fx["amplicons"]).select("chr", "pos", "amplicon_id")


# -- the same operators over reads that reach their rules (see fixtures.EDGE_SHAPES) --

EDGE = CHECK.with_(trim=25)


def _edge_rr(spark, sf, p: CallParams = CHECK) -> DataFrame:
    fx = _fx(spark, sf)
    return M.region_reads(fx["edge_reads"], fx["regions"], fx["contigs"], p)


def _edge_consensus(spark, sf):
    from pilecall.operators.clips import clip_bases, softclip_consensus, softclip_table

    return softclip_consensus(softclip_table(clip_bases(_edge_rr(spark, sf), _fx(spark, sf)["ref_blocks"], CHECK)))


def q_edge_read_filters(spark, sf):
    """D2-D7, D9, D10 as one chain: no sequence, no or high NM, unmapped mates, duplicates under both keys, short matches."""
    p = CHECK.with_(remove_dups=True, min_mapq=20, apply_full_mask=True, minmatch=31)
    return RF.apply_read_filters(_fx(spark, sf)["edge_reads"], p).select("read_name", "sample", "seq", "start_pos", "cigar", "flag", "tnm", "rlen1")


def q_edge_pileup(spark, sf):
    """N bases, trimmed bases, clips on both sides, quality that varies inside a read."""
    a = PU.pileup(_edge_rr(spark, sf, EDGE), _fx(spark, sf)["ref_blocks"], EDGE)
    return a.where(F.col("allele") != "").select(*_ACC, "is_ins").fillna(False, ["pstd", "qstd"])


def q_edge_coverage(spark, sf):
    cov = PU.coverage(_edge_rr(spark, sf, EDGE), _fx(spark, sf)["ref_blocks"], EDGE)
    return cov.where((F.col("pos") >= F.col("region_start")) & (F.col("pos") <= F.col("region_end"))).select("region_id", "pos", "cov")


def q_edge_clip_consensus(spark, sf):
    """E11, E13 for clips at the start of a read as well."""
    return _edge_consensus(spark, sf)


def q_edge_clip_pairs(spark, sf):
    """C12 with pairs."""
    from pilecall.operators.realign import clip_pair_join

    rlen = _edge_rr(spark, sf).groupBy("region_id").agg(F.max("rlen2").alias("max_rlen"))
    return clip_pair_join(_edge_consensus(spark, sf), rlen)


def q_region_genes(spark, sf):
    """Every seventh region has no gene name."""
    fx = _fx(spark, sf)
    regions = fx["regions"].withColumn("gene", F.when(F.col("region_id") % 7 == 0, F.lit("")).otherwise(F.col("gene")))
    return M.region_genes(regions, M.region_reads(fx["reads"], regions, fx["contigs"], CHECK))


# -- F / J: allele statistics and call assembly --------------------------------

def q_allele_stats(spark, sf):
    fx = _fx(spark, sf)
    s = C.allele_stats(_alleles(spark, sf), fx["ref_blocks"], CHECK)
    return s.select(
        "region_id", "pos", "allele", "is_ref", "tcov", "hicov",
        F.col("bias_flag").alias("bias"), "qual", "pmean",
        C.round_half_up(F.col("freq_raw"), 4).alias("freq"),
        C.round_half_up(F.col("mapq_raw"), 1).alias("mapq"),
        C.round_half_up(F.col("qratio_raw"), 3).alias("qratio"),
        C.round_half_up(F.col("hifreq_raw"), 4).alias("hifreq"),
        C.round_half_up(F.col("nm_raw"), 1).alias("nm"),
    )


def q_allele_debug(spark, sf):
    return C.allele_debug(C.allele_stats(_alleles(spark, sf), _fx(spark, sf)["ref_blocks"], CHECK))


def q_strand_bias(spark, sf):
    a = _alleles(spark, sf).where(F.col("allele") != "")
    from pilecall.functions.exprs import strand_bias

    return a.select("region_id", "pos", "allele", strand_bias("fwd", "rev", 0.05, 2).alias("bias"))


def q_allele_rank(spark, sf):
    return _candidates(spark, sf).select("region_id", "pos", "allele", "rank")


def q_genotype(spark, sf):
    return _candidates(spark, sf).select("region_id", "pos", "allele", "genotype")


def q_variant_type(spark, sf):
    return _candidates(spark, sf).select("region_id", "pos", "allele", "ref_allele", "alt_allele", "vartype")


def q_msi_score(spark, sf):
    return _candidates(spark, sf).select("region_id", "pos", "allele", C.round_half_up(F.col("msi"), 3).alias("msi"),
                                         "shift3", "msint")


def q_flank_seq(spark, sf):
    return _candidates(spark, sf).select("region_id", "pos", "allele", "sp", "ep", "leftseq", "rightseq")


def q_complex_trim(spark, sf):
    c = C.complex_trim(_candidates(spark, sf))
    return c.select("region_id", "pos", "allele", "sp", "ep", "ref_allele", "alt_allele", "leftseq", "rightseq")


def q_good_variants(spark, sf):
    c = C.good_variant_flag(_candidates(spark, sf), PU.splice_counts(_rr(spark, sf)), CHECK)
    return c.select("region_id", "pos", "allele", "good", F.coalesce("reason", F.lit("")).alias("reason"))


def q_low_complexity(spark, sf):
    c = _candidates(spark, sf)
    return c.select("region_id", "pos", "allele", low_complexity("rightseq").alias("low_complexity"))


def q_noise_flag(spark, sf):
    from pilecall.operators.filters import noise_flag

    c = _candidates(spark, sf)
    return noise_flag(c, CHECK).select("region_id", "pos", "allele", "noise")


# -- I: calling modes ----------------------------------------------------------

def q_call_single(spark, sf):
    fx = _fx(spark, sf)
    reads = fx["reads"].where(F.col("sample") == "tumor")
    calls = M.call_single(reads, fx["regions"], fx["contigs"], fx["ref_blocks"], CHECK, "tumor")
    return calls.drop("pos")


# -- A: sources and sinks (written to the shared checkpoint folder, read back) --

def _scratch(spark, name):
    from pilecall.session import shared_scratch

    return shared_scratch(spark, name)


def _bed_lines(fx):
    head = fx["regions"].sparkSession.createDataFrame([("#comment",), ("browser position chr1",), ("track name=x",)], ["value"])
    body = fx["regions"].select(F.concat_ws("\t", "chr", F.col("region_start").cast("string"),
                                            F.col("region_end").cast("string"), "gene").alias("value"))
    return head.unionByName(body)


def q_scan_regions(spark, sf):
    from pilecall.sources.text import scan_regions

    fx = _fx(spark, sf)
    path = _scratch(spark, "regions")
    fx["regions"].select(F.concat_ws("\t", "chr", F.col("region_start").cast("string"),
                                     F.col("region_end").cast("string"), "gene").alias("value")).write.text(path)
    return scan_regions(spark, path)


def q_scan_bed(spark, sf):
    from pilecall.sources.text import scan_bed

    path = _scratch(spark, "bed")
    _bed_lines(_fx(spark, sf)).write.text(path)
    return scan_bed(spark, path).select("chr", "region_start", "region_end", "gene", "amplicon_mode")


def q_scan_bed_amplicon(spark, sf):
    from pilecall.sources.text import scan_bed

    fx = _fx(spark, sf)
    path = _scratch(spark, "ampbed")
    a = fx["amplicons"]
    a.select(F.concat_ws("\t", "chr", F.col("amp_start").cast("string"), F.col("amp_end").cast("string"), "gene",
                         F.lit("0"), F.lit("+"), F.col("istart").cast("string"), F.col("iend").cast("string")).alias("value")
             ).write.text(path)
    return scan_bed(spark, path).select("chr", "region_start", "region_end", "gene", "istart", "iend", "amplicon_mode")


def _write_sam(spark, fx, where: str = "true"):
    path = _scratch(spark, "sam")
    r = fx["reads"].where(where)
    body = r.select(F.concat_ws("\t", "read_name", F.col("flag").cast("string"), "chr", F.col("start_pos").cast("string"),
                                F.col("mapq").cast("string"), "cigar", F.lit("="), F.col("mate_start").cast("string"),
                                F.col("insert_size").cast("string"), "seq", "qual",
                                F.concat(F.lit("NM:i:"), F.col("nm").cast("string"))).alias("value"))
    head = fx["contigs"].select(F.concat(F.lit("@SQ\tSN:"), F.col("chr"), F.lit("\tLN:"), F.col("length").cast("string")).alias("value"))
    head.unionByName(body).write.text(path)
    return path


def q_scan_sam(spark, sf):
    from pilecall.sources.text import scan_sam

    path = _write_sam(spark, _fx(spark, sf))
    return scan_sam(spark, path).drop("path", "sa_tag")


def q_scan_alignments(spark, sf):
    from pilecall.sources.text import scan_alignments

    fx = _fx(spark, sf)
    parts = ["sample = 'tumor' AND start_pos % 2 = 0", "sample = 'tumor' AND start_pos % 2 = 1", "sample = 'normal'"]
    a, b, c = (_write_sam(spark, fx, x) for x in parts)
    return scan_alignments(spark, f"{a}:{b}|{c}").select("read_name", "sample", "flag", "chr", "start_pos", "cigar", "seq", "nm")


def q_contig_lengths(spark, sf):
    from pilecall.sources.text import contig_lengths

    path = _write_sam(spark, _fx(spark, sf))
    return contig_lengths(spark, path)


def q_sample_name(spark, sf):
    from pilecall.sources.text import sample_name

    r = _fx(spark, sf)["reads"]
    paths = r.select(F.when(F.col("sample") == "tumor", F.concat(F.lit("/data/run1/"), F.col("chr"), F.lit("_"), F.col("sample"), F.lit(".sorted.dedup.bam")))
                     .otherwise(F.concat(F.lit("/data/run1/"), F.col("sample"), F.lit("_"), F.col("chr"), F.lit(".bam"))).alias("path")).distinct()
    return sample_name(paths, "path")


def q_write_calls_roundtrip(spark, sf):
    from pilecall.sources.text import read_calls, write_calls

    path = _scratch(spark, "calls")
    write_calls(q_call_single(spark, sf), path)
    return read_calls(spark, path)


def q_call_pileup(spark, sf):
    fx = _fx(spark, sf)
    reads = fx["reads"].where(F.col("sample") == "tumor")
    return M.call_pileup(reads, fx["regions"], fx["contigs"], fx["ref_blocks"], CHECK, "tumor")


def q_call_paired(spark, sf):
    fx = _fx(spark, sf)
    r = fx["reads"]
    return M.call_paired(r.where(F.col("sample") == "tumor"), r.where(F.col("sample") == "normal"),
                         fx["regions"], fx["contigs"], fx["ref_blocks"], CHECK)


def q_scan_fasta(spark, sf):
    """A3: the reference written as FASTA (unknown blocks as N), read back."""
    from pilecall.sources.text import scan_fasta

    fx = _fx(spark, sf)
    every = fx["contigs"].select("chr", F.explode(F.sequence(F.lit(0), (F.col("length") / 32).cast("long") - 1)).alias("block"))
    lines = every.join(fx["ref_blocks"], ["chr", "block"], "left").select("chr", "block", F.coalesce("seq", F.repeat(F.lit("N"), 32)).alias("value"))
    heads = fx["contigs"].select("chr", F.lit(-1).cast("long").alias("block"), F.concat(F.lit(">"), "chr", F.lit(" contig")).alias("value"))
    path = _scratch(spark, "fasta")
    lines.union(heads).repartition(3, "chr").sortWithinPartitions("chr", "block").select("value").write.text(path)
    return scan_fasta(spark, path)


def q_mnp_merge(spark, sf):
    """Adjacent mismatches of a read counted as one allele."""
    al = _alleles(spark, sf).where(F.col("allele").contains("&"))
    return al.select("region_id", "pos", "allele", "cnt", "fwd", "rev", "tp_sum", "q_sum", "mq_sum", "nm_sum", "hicnt", "locnt", "pstd", "qstd")


ADJUSTED = CHECK.with_(adjust_mnp=True)


def q_mnp_adjust(spark, sf):
    """Fragments and clips handed to the multi-base changes that they belong to."""
    fx = _fx(spark, sf)
    rr = M.region_reads(fx["mnp_reads"], fx["regions"], fx["contigs"], ADJUSTED)
    a, _ = M.called_alleles(rr, fx["ref_blocks"], ADJUSTED)
    return a.where(F.col("allele") != "").select(*_ACC, "is_ins", "extracnt", "cov_add").fillna(False, ["pstd", "qstd"])


def _overlap_inputs(spark, sf):
    """(region x read pairs, clips, found changes) over the reads that are clipped at long changes."""
    from pilecall.operators.clip_overlap import overlap_insertions
    from pilecall.operators.clips import clip_evidence

    fx = _fx(spark, sf)
    rr = M.region_reads(fx["gap_reads"], fx["regions"], fx["contigs"], CHECK)
    clips = clip_evidence(rr, fx["ref_blocks"], CHECK).checkpoint()
    spans = rr.groupBy("region_id", "chr", "region_start", "region_end", "contig_len").agg(F.max("rlen2").alias("max_rlen"))
    return rr, clips, overlap_insertions(clips, spans, fx["ref_blocks"])


def q_clip_overlap(spark, sf):
    """Changes spelled by a left and a right clip together, each clip used once."""
    found = _overlap_inputs(spark, sf)[2]
    return found.select("region_id", "p5", "p3", "bp5", "bp3", "score", "pos", "allele", "is_ins", "cnt5", "cnt3")


def q_clip_overlap_counts(spark, sf):
    """H7 on the pileup: the clips' counts moved to the changes and away from the reference allele."""
    from pilecall.operators.clip_overlap import clip_overlap_adjust

    rr, clips, found = _overlap_inputs(spark, sf)
    a = clip_overlap_adjust(M.called_alleles(rr, _fx(spark, sf)["ref_blocks"], CHECK)[0], found, clips)
    return a.where(F.col("allele") != "").select(*_ACC, "is_ins", "extracnt", "cov_add").fillna(False, ["pstd", "qstd"])


def q_call_adjusted(spark, sf):
    """I1 with E17, and F2 where it makes a count exceed the depth."""
    fx = _fx(spark, sf)
    return M.call_single(fx["mnp_reads"], fx["regions"], fx["contigs"], fx["ref_blocks"], ADJUSTED, "tumor").drop("pos")


def q_call_amplicon(spark, sf):
    """A panel's calls, with what the other amplicons over each position say."""
    from pilecall.operators.amplicon import call_amplicon

    fx = _fx(spark, sf)
    return call_amplicon(fx["panel_reads"], fx["panel"], fx["contigs"], fx["ref_blocks"], CHECK, "panel")


def queries() -> dict:
    return {
        "call_amplicon": q_call_amplicon,
        "mnp_adjust": q_mnp_adjust,
        "clip_overlap": q_clip_overlap,
        "clip_overlap_counts": q_clip_overlap_counts,
        "call_adjusted": q_call_adjusted,
        "region_parse": q_region_parse,
        "segment_explode": q_segment_explode,
        "amplicon_groups": q_amplicon_groups,
        "chr_normalize": q_chr_normalize,
        "strip_chr": q_strip_chr,
        "region_flank": q_region_flank,
        "region_read_overlap": q_region_read_overlap,
        "region_ref_window": q_region_ref_window,
        "region_nonempty": q_region_nonempty,
        "read_filter_flags": q_read_filter_flags,
        "read_filter_mismatch": q_read_filter_mismatch,
        "read_dedup": q_read_dedup,
        "read_downsample_hash": q_read_downsample_hash,
        "amplicon_read_filter": q_amplicon_read_filter,
        "cigar_lengths": q_cigar_lengths,
        "cigar_normalize": q_cigar_normalize,
        "read_length_max": q_read_length_max,
        "base_pileup": q_base_pileup,
        "mnp_merge": q_mnp_merge,
        "scan_fasta": q_scan_fasta,
        "insertion_pileup": q_insertion_pileup,
        "deletion_pileup": q_deletion_pileup,
        "complex_indels": q_complex_indels,
        "edge_read_filters": q_edge_read_filters,
        "edge_pileup": q_edge_pileup,
        "edge_coverage": q_edge_coverage,
        "edge_clip_consensus": q_edge_clip_consensus,
        "edge_clip_pairs": q_edge_clip_pairs,
        "region_genes": q_region_genes,
        "coverage": q_coverage,
        "splice_counts": q_splice_counts,
        "softclip_collect": q_softclip_collect,
        "softclip_consensus": q_softclip_consensus,
        "spanning_reads": q_spanning_reads,
        "breakpoint_search": q_breakpoint_search,
        "clip_pair_join": q_clip_pair_join,
        "position_amplicons": q_position_amplicons,
        "allele_stats": q_allele_stats,
        "strand_bias": q_strand_bias,
        "allele_rank": q_allele_rank,
        "genotype": q_genotype,
        "variant_type": q_variant_type,
        "msi_score": q_msi_score,
        "flank_seq": q_flank_seq,
        "complex_trim": q_complex_trim,
        "good_variants": q_good_variants,
        "low_complexity": q_low_complexity,
        "noise_flag": q_noise_flag,
        "splice_antijoin": q_splice_antijoin,
        "call_single": q_call_single,
        "call_pileup": q_call_pileup,
        "call_paired": q_call_paired,
        "scan_regions": q_scan_regions,
        "scan_bed": q_scan_bed,
        "scan_bed_amplicon": q_scan_bed_amplicon,
        "scan_sam": q_scan_sam,
        "scan_alignments": q_scan_alignments,
        "region_lines": q_region_lines,
        "allele_debug": q_allele_debug,
        "contig_lengths": q_contig_lengths,
        "sample_name": q_sample_name,
        "write_calls_roundtrip": q_write_calls_roundtrip,
    }

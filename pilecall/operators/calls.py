"""From allele accumulators to scored call rows.

Everything per position is a window over ``(region_id, pos)``; all windows
share that partitioning, so one exchange of the (already aggregated) allele
rows serves the whole stage. Reference text for alleles, flanks and
microsatellite scoring comes from one bounded ``ref_context`` lookup per
candidate position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pilecall.fixtures import BLOCK
from pilecall.functions.exprs import computed_once, fixed_decimal, round_half_up, strand_bias, variant_type
from pilecall.operators.joins import ref_context, ref_range
from pilecall.params import CallParams

POS = ["region_id", "pos"]

CALL_COLS = [
    "sample", "gene", "chr", "start", "end", "ref_allele", "alt_allele", "tcov", "cov", "rfc", "rrc",
    "fwd", "rev", "genotype", "freq", "bias", "pmean", "pstd", "qual", "qstd", "mapq", "qratio",
    "hifreq", "extrafreq", "shift3", "msi", "msint", "nm", "hicnt", "hicov", "leftseq", "rightseq",
    "region", "vartype",
]


def with_ref_base(alleles: DataFrame, ref_blocks: DataFrame) -> DataFrame:
    """Reference base at each allele position (C4 on aggregated rows)."""
    blk = ref_blocks.select("chr", "block", F.col("block_start").alias("_bs"), F.col("seq").alias("_bseq"))
    keyed = alleles.withColumn("block", F.floor((F.col("pos") - 1) / BLOCK))
    out = keyed.join(blk, ["chr", "block"], "left")
    base = F.substring("_bseq", (F.col("pos") - F.col("_bs") + 1).cast("int"), 1)
    return out.withColumn("ref_base", F.coalesce(base, F.lit(""))).drop("block", "_bs", "_bseq")


def allele_stats(alleles: DataFrame, ref_blocks: DataFrame, p: CallParams) -> DataFrame:
    """F1, F2, F3, E14 per allele at positions inside the region with coverage.

    Keeps the position-level flags needed later: ``only_ref`` (F4) and the
    reference row's statistics.
    """
    w = Window.partitionBy(*POS)
    # pileup rows are inside their region by construction; no filter on the
    # aggregation keys here, so the allele shuffle can be shared with other consumers
    a = alleles.withColumns({
        "tcov": F.sum("cov_add").over(w),
        "hicov": F.sum("hicnt").over(w),
        "_nkeys": F.count(F.when((F.col("allele") != "") & ~F.col("is_ins"), 1)).over(w)
        + F.max(F.when(F.col("is_ins"), 1).otherwise(0)).over(w),
        "_has_base": F.max(F.when((F.col("allele") != "") & ~F.col("is_ins"), 1).otherwise(0)).over(w),
    })
    a = a.where((F.col("allele") != "") & (F.col("tcov") > 0) & (F.col("_has_base") == 1))
    a = with_ref_base(a, ref_blocks)
    a = a.withColumn("is_ref", ~F.col("is_ins") & (F.col("allele") == F.col("ref_base")))
    a = a.withColumn("only_ref", (F.col("_nkeys") == 1) & F.col("is_ref"))
    a = a.where(F.col("is_ins") | (F.col("cnt") != 0))
    cnt = F.col("cnt")
    # reads that joined an allele later (extracnt) may take its count beyond the depth
    extra = F.col("extracnt") if "extracnt" in alleles.columns else F.lit(0).cast("long")
    ttcov = F.when((cnt > F.col("tcov")) & (cnt - F.col("tcov") < extra), cnt).otherwise(F.col("tcov"))
    stats = {
        "bias_flag": strand_bias("fwd", "rev", p.bias, p.minb),
        "qual": round_half_up(F.col("q_sum") / cnt, 1),
        "mapq_raw": F.col("mq_sum") / cnt,
        "freq_raw": cnt / ttcov,
        "extrafreq_raw": extra / ttcov,
        "pmean": round_half_up(F.col("tp_sum") / cnt, 1),
        "qratio_raw": F.col("hicnt") / F.when(F.col("locnt") != 0, F.col("locnt").cast("double")).otherwise(F.lit(0.5)),
        "hifreq_raw": F.when(F.col("hicov") > 0, F.col("hicnt") / F.col("hicov")).otherwise(F.lit(0.0)),
        "nm_raw": F.col("nm_sum") / cnt,
        "pstd": F.coalesce("pstd", F.lit(False)),
        "qstd": F.coalesce("qstd", F.lit(False)),
    }
    return a.withColumns(stats).drop("_nkeys", "_has_base")


def rank_alleles(stats: DataFrame, p: CallParams, keep_quiet: bool = False) -> DataFrame:
    """J1 + F4 + F5: rank non-reference alleles, attach the reference row, drop quiet positions.

    ``keep_quiet`` keeps reference-only and low-frequency positions (pileup and
    paired modes, as in the original).
    """
    w = Window.partitionBy(*POS)
    s = stats.withColumns({
        "_maxfreq": F.max(F.when(~F.col("is_ref"), F.col("freq_raw"))).over(w),
        "_ref": F.max(F.when(F.col("is_ref"), F.struct(
            F.col("freq_raw").alias("freq"), F.col("fwd").alias("fwd"), F.col("rev").alias("rev"),
            F.col("bias_flag").alias("bias"), F.col("hicnt").alias("hicnt"), F.col("mapq_raw").alias("mapq"),
            F.col("allele").alias("allele")))).over(w),
    })
    if not (p.pileup or keep_quiet):
        s = s.where(~F.col("only_ref"))
        s = s.where(F.coalesce(F.col("_maxfreq"), F.lit(0.0)) > p.freq)
    var = s.where(~F.col("is_ref"))
    order = Window.partitionBy(*POS).orderBy(
        (F.col("qual") * F.col("cnt")).desc(), F.col("is_ins").asc(), F.col("allele").asc())
    var = var.withColumn("rank", F.row_number().over(order))
    var = var.withColumn("_top", F.first(F.when(F.col("rank") == 1, F.col("allele")), ignorenulls=True).over(
        Window.partitionBy(*POS)))
    return var


def _plus_len(allele: Column) -> Column:
    return F.when(allele.startswith("+"), F.concat(F.lit("+"), (F.length(allele) - 1).cast("string"))).otherwise(allele)


def _find_msi(t1: str, t2: str, left: str | None) -> str:
    """SQL text of the microsatellite search (F8) -> struct(msi, shift3, unit).

    For unit lengths 1..8 (not longer than t1) the unit is the tail of t1; copies
    are trailing repeats of (left + t1) plus leading repeats of t2; the first
    maximum wins. shift3 is the common prefix of (t1 + t2) and t2.
    """
    s1 = f"concat(coalesce({left}, ''), {t1})" if left else t1
    # copies end at the first that differs, so a second or first one that differs settles the count without the others
    copies = (
        "transform(sequence(1, least(8, length({t1}))), k -> named_struct('k', k, 'c', cast("
        "CASE WHEN length({s1}) < 2 * k OR right({s1}, 2 * k) <> repeat(right({t1}, k), 2) THEN 1 ELSE "
        "size(filter(sequence(1, cast(floor(length({s1}) / k) AS int)), c -> right({s1}, c * k) = repeat(right({t1}, k), c))) END "
        "+ CASE WHEN length({t2}) >= k AND left({t2}, k) = right({t1}, k) THEN "
        "size(filter(sequence(1, cast(floor(length({t2}) / k) AS int)), c -> left({t2}, c * k) = repeat(right({t1}, k), c))) ELSE 0 END AS double)))"
    ).format(t1=t1, s1=s1, t2=t2)
    best = (
        f"CASE WHEN length({t1}) > 0 THEN aggregate({copies}, "
        "named_struct('m', 0D, 'k', 0), (acc, x) -> CASE WHEN x.c > acc.m "
        "THEN named_struct('m', x.c, 'k', x.k) ELSE acc END) ELSE named_struct('m', 0D, 'k', 0) END"
    )
    shift = (
        f"CASE WHEN length({t2}) = 0 OR left(concat({t1}, {t2}), 1) <> left({t2}, 1) THEN 0 ELSE coalesce(nullif(array_position(transform(sequence(1, length({t2})), "
        f"i -> substr(concat({t1}, {t2}), i, 1) = substr({t2}, i, 1)), false), 0) - 1, length({t2})) END"
    )
    return f"transform(array({best}), b -> named_struct('msi', b.m, 'unit', b.k, 'shift3', {shift}))[0]"


def msi_score(df: DataFrame, t1: str, t2: str, left: str | None = None, out: str = "msi") -> DataFrame:
    """F8 as a DataFrame function: adds struct ``out`` (msi, unit, shift3)."""
    return df.withColumn(out, F.expr(_find_msi(t1, t2, left)))


def call_alleles(var: DataFrame, ref_blocks: DataFrame, p: CallParams) -> DataFrame:
    """Genotype, alleles, coordinates, MSI, flanks and type per ranked allele."""
    dellen = F.regexp_extract("allele", r"^-(\d+)", 1)
    v = var.withColumn("dellen", F.when(F.col("allele").startswith("-"), dellen.cast("int")).otherwise(F.lit(0)))
    w = Window.partitionBy(*POS)
    v = v.withColumn("_widest", F.max(F.greatest("dellen", F.length("allele"))).over(w))
    lo = F.greatest(F.lit(1), F.col("region_start") - p.flank, F.col("pos") - 80)
    hi = F.least(F.col("region_end") + p.flank, F.col("pos") + F.col("_widest") + 100)
    keys = v.select(*POS, "chr", lo.alias("_lo"), hi.alias("_hi")).distinct()
    ctx = ref_context(keys, ref_blocks, "_lo", "_hi", POS)
    v = v.join(ctx, POS, "left")
    # joinRef over the loaded flank (region +- flank), clamped to the contig
    rlo = F.greatest(F.lit(1), F.col("region_start") - p.flank)
    rhi = F.least(F.col("region_end") + p.flank, F.col("contig_len"))

    def ref(a, b):
        return ref_range(F.col("ctx"), F.col("ctx_start"), F.greatest(a, rlo), F.least(b, rhi))

    pos = F.col("pos")
    clen = F.col("contig_len")
    vn = F.col("allele")
    is_ins = vn.startswith("+")
    is_del = vn.startswith("-")
    plain_ins = is_ins & ~vn.contains("&") & ~vn.contains("#")
    v = v.withColumns({
        "_ref_p": ref(pos, pos),
        "_ins_seq": F.expr("substr(allele, 2)"),
        "_ins_left": ref(F.greatest(pos - 50, F.lit(1)), pos),
        "_ins_right": ref(pos + 1, F.least(pos + 70, clen)),
        "_del_left": ref(F.greatest(pos - 70, F.lit(1)), pos - 1),
        "_del_tseq": ref(pos, F.least(pos + F.col("dellen") + 70, clen)),
        "_snv_t1": ref(F.greatest(pos - 30, F.lit(1)), pos + 1),
        "_snv_t2": ref(pos + 2, F.least(pos + 70, clen)),
    })
    v = v.withColumns({
        "_del_t1": F.expr("substr(_del_tseq, 1, dellen)"),
        "_del_t2": F.expr("substr(_del_tseq, dellen + 1)"),
    })
    # each search only for the alleles that take its result
    v = computed_once(
        v,
        _m_ins1=F.when(plain_ins, F.expr(_find_msi("_ins_seq", "_ins_right", "_ins_left"))),
        _m_ins2=F.when(plain_ins, F.expr(_find_msi("_ins_left", "_ins_right", None))),
        _m_del1=F.when(is_del, F.expr(_find_msi("_del_t1", "_del_t2", "_del_left"))),
        _m_del2=F.when(is_del, F.expr(_find_msi("_del_left", "_del_t2", "_del_left"))),
        _m_snv=F.when(~is_ins & ~is_del, F.expr(_find_msi("_snv_t1", "_snv_t2", None))),
    )

    def pick(a, b, length):
        best = F.when(F.col(a + ".msi") < F.col(b + ".msi"), F.col(b)).otherwise(F.col(a))
        floor_v = F.col("_best.shift3") / length
        return best, floor_v

    ins_best = F.when(F.col("_m_ins1.msi") < F.col("_m_ins2.msi"), F.col("_m_ins2")).otherwise(F.col("_m_ins1"))
    del_best = F.when(F.col("_m_del1.msi") < F.col("_m_del2.msi"), F.col("_m_del2")).otherwise(F.col("_m_del1"))
    v = v.withColumn("_best", F.when(plain_ins, ins_best).when(is_del, del_best).when(is_ins, F.lit(None)).otherwise(F.col("_m_snv")))
    ins_len = F.length("_ins_seq").cast("double")
    msi_v = F.coalesce(F.col("_best.msi"), F.lit(0.0))
    shift3 = F.coalesce(F.col("_best.shift3"), F.lit(0))
    msi_v = (
        F.when(plain_ins & (msi_v <= shift3 / ins_len), shift3 / ins_len)
        .when(is_del & (msi_v <= shift3 / F.col("dellen")), shift3 / F.col("dellen"))
        .otherwise(msi_v)
    )
    unit = F.when(F.col("_best").isNull(), F.lit(0)).otherwise(F.coalesce(F.col("_best.unit"), F.lit(0)))
    simple_del = is_del & ~vn.contains("&") & ~vn.contains("#") & ~vn.contains("^")
    mv3 = 1 if p.move_indels_3 else 0
    sp = (
        F.when(is_ins, pos + shift3 * mv3)
        .when(simple_del, pos + shift3 * mv3 - 1)
        .otherwise(pos)
    )
    ep0 = F.when(is_ins, pos + shift3 * mv3).when(is_del, pos + F.col("dellen") - 1).otherwise(pos)
    ref_allele = (
        F.when(is_ins, F.col("_ref_p"))
        .when(simple_del, F.concat(ref(pos - 1, pos - 1), ref(pos, pos + F.col("dellen") - 1)))
        .when(is_del, ref(pos, pos + F.col("dellen") - 1))
        .otherwise(F.col("_ref_p"))
    )
    alt_allele = (
        F.when(is_ins, F.concat(F.col("_ref_p"), F.col("_ins_seq")))
        .when(simple_del, ref(pos - 1, pos - 1))
        .when(is_del, F.regexp_replace(vn, r"^-\d+", ""))
        .otherwise(vn)
    )
    v = v.withColumns({"msi": msi_v, "shift3": shift3, "msint": unit, "sp": sp, "ep0": ep0,
                       "ref_allele": ref_allele, "alt_allele": alt_allele})
    # '&' extension: the bases after '&' extend both alleles with reference bases (MNPs)
    extra = F.regexp_extract(vn, r"&([ATGC]+)", 1)
    has_amp = extra != ""
    tch = ref(F.col("ep0") + 1, F.col("ep0") + F.length(extra))
    v = v.withColumns({
        "alt_allele": F.when(has_amp, F.regexp_replace(F.col("alt_allele"), "&", "")).otherwise(F.col("alt_allele")),
        "ref_allele": F.when(has_amp, F.concat(F.col("ref_allele"), tch)).otherwise(F.col("ref_allele")),
        "_g1_ext": F.when(has_amp, tch).otherwise(F.lit("")),
        "ep0": F.when(has_amp, F.col("ep0") + F.length(extra)).otherwise(F.col("ep0")),
    })
    v = v.withColumns({
        "ref_allele": F.when(has_amp & is_ins, F.expr("substr(ref_allele, 2)")).otherwise(F.col("ref_allele")),
        "alt_allele": F.when(has_amp & is_ins, F.expr("substr(alt_allele, 2)")).otherwise(F.col("alt_allele")),
        "sp": F.when(has_amp & is_ins, F.col("sp") + 1).otherwise(F.col("sp")),
    })
    # genotype (F6): reference allele when its frequency >= f, else the top allele
    g1 = F.when(F.col("_ref").isNotNull() & (F.col("_ref.freq") >= p.freq), F.col("_ref.allele")).otherwise(F.col("_top"))
    g1 = F.concat(_plus_len(g1), F.col("_g1_ext"))
    genotype = F.concat(g1, F.lit("/"), _plus_len(vn))
    genotype = F.regexp_replace(F.regexp_replace(genotype, "[&#]", ""), r"\^", "i")
    v = v.withColumn("genotype", genotype)
    plus_n = F.regexp_extract("genotype", r"\+(\d+)", 1)
    v = v.withColumn("ep", F.when(plus_n != "", F.col("sp") + plus_n.cast("long")).otherwise(F.col("ep0")))
    v = v.withColumns({
        "leftseq": ref(F.greatest(F.col("sp") - 20, F.lit(1)), F.col("sp") - 1),
        "rightseq": ref(F.col("ep") + 1, F.least(F.col("ep") + 20, clen)),
    })
    v = v.withColumn("vartype", variant_type("ref_allele", "alt_allele"))
    return v


def complex_trim(df: DataFrame) -> DataFrame:
    """drop the common prefix / suffix of a Complex variant, moving start/end and flanks."""
    r, a = F.col("ref_allele"), F.col("alt_allele")
    pre = F.expr(
        "coalesce(nullif(array_position(transform(sequence(0, greatest(least(length(ref_allele), length(alt_allele)) - 2, 0)), "
        "n -> length(ref_allele) - n > 1 AND length(alt_allele) - n > 1 AND substr(ref_allele, n + 1, 1) = substr(alt_allele, n + 1, 1)), false), 0) - 1, "
        "greatest(least(length(ref_allele), length(alt_allele)) - 1, 0))"
    )
    is_c = F.col("vartype") == "Complex"
    d = df.withColumn("_n", F.when(is_c, pre).otherwise(F.lit(0)))
    n = F.col("_n")
    d = d.withColumns({
        "sp": F.col("sp") + n,
        "leftseq": F.when(n > 0, F.expr("substr(concat(leftseq, substr(ref_allele, 1, _n)), _n + 1)")).otherwise(F.col("leftseq")),
        "ref_allele": F.when(n > 0, F.expr("substr(ref_allele, _n + 1)")).otherwise(r),
        "alt_allele": F.when(n > 0, F.expr("substr(alt_allele, _n + 1)")).otherwise(a),
    })
    suf = F.expr(
        "coalesce(nullif(array_position(transform(sequence(1, greatest(least(length(ref_allele), length(alt_allele)) - 1, 1)), "
        "k -> length(ref_allele) - k > 0 AND length(alt_allele) - k > 0 AND substr(ref_allele, -k, 1) = substr(alt_allele, -k, 1)), false), 0), "
        "greatest(least(length(ref_allele), length(alt_allele)), 1))"
    )
    d = d.withColumn("_m", F.when(is_c, suf).otherwise(F.lit(1)))
    m1 = F.col("_m") - 1
    d = d.withColumns({
        "ep": F.col("ep") - m1,
        "rightseq": F.when(m1 > 0, F.expr("concat(substr(ref_allele, length(ref_allele) - _m + 2), substr(rightseq, 1, greatest(length(rightseq) - _m + 1, 0)))")).otherwise(F.col("rightseq")),
        "ref_allele": F.when(m1 > 0, F.expr("substr(ref_allele, 1, length(ref_allele) - _m + 1)")).otherwise(F.col("ref_allele")),
        "alt_allele": F.when(m1 > 0, F.expr("substr(alt_allele, 1, length(alt_allele) - _m + 1)")).otherwise(F.col("alt_allele")),
    })
    return d.drop("_n", "_m")


def good_variant_flag(v: DataFrame, splices: DataFrame | None, p: CallParams) -> DataFrame:
    """G1 as an ordered rule chain; adds ``good`` and the first failing ``reason``."""
    freq, hicnt = F.col("freq_raw"), F.col("hicnt")
    d = F.col("mapq_raw") + F.length("ref_allele") + F.length("alt_allele")
    ref_mq = F.col("_ref.mapq")
    mq_contest = F.col("_ref").isNotNull() & (F.col("_ref.hicnt") > p.minr) & (freq < 0.25) & (
        ((d - 2 < 5) & (ref_mq > 20)) | ((1 + d) / (ref_mq + 1) < 0.25))
    if splices is not None:
        sp = splices.select("region_id", F.col("junction").alias("_junc")).distinct().withColumn("_is_splice", F.lit(True))
        v = v.withColumn("_junc", F.concat_ws("-", F.col("sp").cast("string"), F.col("ep").cast("string")))
        v = v.join(sp, ["region_id", "_junc"], "left").drop("_junc")
    else:
        v = v.withColumn("_is_splice", F.lit(None).cast("boolean"))
    splice_hit = (F.col("vartype") == "Deletion") & F.coalesce(F.col("_is_splice"), F.lit(False))
    bias = F.col("bias")
    short = (F.col("vartype") == "SNV") | ((F.length("ref_allele") <= 3) & (F.length("alt_allele") <= 3))
    reason = (
        F.when(F.length("ref_allele") == 0, F.lit("no_ref"))
        .when((freq < p.freq) | (hicnt < p.minr) | (F.col("pmean") < p.read_pos_filter) | (F.col("qual") < p.goodq), F.lit("low_support"))
        .when(mq_contest, F.lit("mapq_contest"))
        .when(splice_hit, F.lit("splice"))
        .when(F.col("qratio_raw") < p.qratio, F.lit("qratio"))
        .when(freq > 0.35, F.lit(None))
        .when(F.col("mapq_raw") < p.mapq, F.lit("mapq"))
        .when((F.col("msi") >= 13) & (freq <= 0.275) & (F.col("msint") == 1), F.lit("msi"))
        .when((F.col("msi") >= 8) & (freq <= 0.2) & (F.col("msint") > 1), F.lit("msi"))
        .when((bias == "2;1") & (freq < 0.25) & short, F.lit("strand_bias"))
    )
    return v.withColumn("reason", reason).withColumn("good", F.col("reason").isNull()).drop("_is_splice")


def finalize_calls(v: DataFrame, sample: str) -> DataFrame:
    """The output row with typed, rounded numbers (34 fields + keys)."""
    refb = F.coalesce(F.col("_ref.bias").cast("string"), F.lit("0"))
    region = F.concat(F.col("chr"), F.lit(":"), F.col("region_start").cast("string"), F.lit("-"), F.col("region_end").cast("string"))
    return v.select(
        "region_id", "pos",
        F.lit(sample).alias("sample"),
        F.col("gene"),
        F.col("chr"),
        F.col("sp").cast("long").alias("start"),
        F.col("ep").cast("long").alias("end"),
        "ref_allele", "alt_allele",
        F.col("tcov").cast("long").alias("tcov"),
        F.col("cnt").cast("long").alias("cov"),
        F.coalesce(F.col("_ref.fwd"), F.lit(0)).cast("long").alias("rfc"),
        F.coalesce(F.col("_ref.rev"), F.lit(0)).cast("long").alias("rrc"),
        F.col("fwd").cast("long").alias("fwd"),
        F.col("rev").cast("long").alias("rev"),
        "genotype",
        round_half_up(F.col("freq_raw"), 4).alias("freq"),
        F.col("bias"),
        F.col("pmean"),
        F.col("pstd").cast("int").alias("pstd"),
        F.col("qual"),
        F.col("qstd").cast("int").alias("qstd"),
        round_half_up(F.col("mapq_raw"), 1).alias("mapq"),
        round_half_up(F.col("qratio_raw"), 3).alias("qratio"),
        round_half_up(F.col("hifreq_raw"), 4).alias("hifreq"),
        round_half_up(F.col("extrafreq_raw"), 4).alias("extrafreq"),
        F.col("shift3").cast("int").alias("shift3"),
        round_half_up(F.col("msi"), 3).alias("msi"),
        F.col("msint").cast("int").alias("msint"),
        round_half_up(F.col("nm_raw"), 1).alias("nm"),
        F.col("hicnt").cast("long").alias("hicnt"),
        F.col("hicov").cast("long").alias("hicov"),
        F.when(F.col("leftseq") == "", F.lit("0")).otherwise(F.col("leftseq")).alias("leftseq"),
        F.when(F.col("rightseq") == "", F.lit("0")).otherwise(F.col("rightseq")).alias("rightseq"),
        region.alias("region"),
        F.col("vartype"),
    )


def allele_debug(stats: DataFrame) -> DataFrame:
    """(region_id, pos, debug), a description of every allele of a position, ' & ' between them.

    Alleles stand in order, insertions last and marked 'I'. A position's alleles are few
    (aggregated rows), so the list of one is short.
    """
    text = F.concat_ws(
        ":", F.concat(F.when(F.col("is_ins"), F.lit("I")).otherwise(F.lit("")), F.col("allele")), (F.col("fwd") + F.col("rev")).cast("string"),
        F.concat(F.lit("F-"), F.col("fwd").cast("string")), F.concat(F.lit("R-"), F.col("rev").cast("string")), fixed_decimal("freq_raw", 3),
        F.col("bias_flag").cast("string"), F.col("pmean").cast("string"), F.col("pstd").cast("string"), F.col("qual").cast("string"), F.col("qstd").cast("string"),
        fixed_decimal("hifreq_raw", 3), round_half_up(F.col("mapq_raw"), 1).cast("string"), round_half_up(F.col("qratio_raw"), 3).cast("string"))
    each = F.array_sort(F.collect_list(F.struct(F.col("is_ins"), F.col("allele"), text.alias("text"))))
    return stats.groupBy(*POS).agg(F.array_join(F.transform(each, lambda x: x["text"]), " & ").alias("debug"))


def with_bias_pair(v: DataFrame) -> DataFrame:
    """``refbias;varbias`` (0 when the position has no reference row)."""
    refb = F.coalesce(F.col("_ref.bias").cast("string"), F.lit("0"))
    return v.withColumn("bias", F.concat(refb, F.lit(";"), F.col("bias_flag").cast("string")))

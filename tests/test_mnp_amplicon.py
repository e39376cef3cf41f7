"""Hand-computed cases of E16, E17, F2 and I2."""

from pyspark.sql import functions as F

from pilecall.operators.amplicon import combine_amplicons
from pilecall.operators.calls import allele_stats
from pilecall.operators.mnp import COUNTS, mnp_adjust, transfer_counts
from pilecall.params import CallParams

ALLELES = ("region_id long, chr string, region_start long, region_end long, contig_len long, pos long, allele string, is_ins boolean, "
           "cnt long, fwd long, rev long, tp_sum long, q_sum double, mq_sum long, nm_sum long, hicnt long, locnt long, "
           "pstd boolean, qstd boolean, cov_add long")
CLIPS = ("region_id long, side int, pos long, consensus string, cnt long, fwd long, rev long, tp_sum long, q_sum double, mq_sum long, "
         "nm_sum long, hicnt long, locnt long")
# positions 1.. of chr1
REF = "AAAACAGATTACAGGCTTAACCGGTATCGATC"


def _allele(pos, allele, cnt, tp=None, is_ins=False):
    tp = 10 * cnt if tp is None else tp
    return (1, "chr1", 1, 32, 32, pos, allele, is_ins, cnt, cnt, 0, tp, 30.0 * cnt, 60 * cnt, cnt, cnt, 0, False, False, cnt)


def _clip(side, pos, consensus, cnt):
    return (1, side, pos, consensus, cnt, cnt, 0, 8 * cnt, 30.0 * cnt, 60 * cnt, 0, cnt, 0)


def _run(spark, rows, clips=()):
    blocks = spark.createDataFrame([("chr1", 0, 1, REF)], "chr string, block long, block_start long, seq string")
    out = mnp_adjust(spark.createDataFrame(rows, ALLELES), spark.createDataFrame(list(clips), CLIPS), blocks).collect()
    assert sum(r.cov_add for r in out) >= sum(r[-1] for r in rows)  # no depth is lost
    return {(r.pos, r.allele): r for r in out}


def test_fragments_join_their_change(spark):
    got = _run(spark, [_allele(9, "C&G", 10), _allele(9, "C", 3, 3), _allele(10, "G", 4, 4), _allele(10, "A", 2, 2), _allele(9, "CG", 1, 1, True)])
    whole = got[9, "C&G"]
    assert (whole.cnt, whole.extracnt, whole.cov_add, whole.tp_sum) == (17, 7, 14, 107)  # depth grows by the part behind its start only
    assert whole.pstd and whole.qstd
    assert (9, "C") not in got and (10, "G") not in got
    assert got[9, ""].cov_add == 3 and got[9, ""].cnt == 0 and got[10, ""].cov_add == 4
    assert got[10, "A"].cnt == 2 and got[9, "CG"].cnt == 1


def test_fragments_that_stay(spark):
    # seen in the middle of reads (mean position 2 and more), or more frequent than the change
    got = _run(spark, [_allele(9, "C&G", 5), _allele(9, "C", 2, 4), _allele(10, "G", 5, 5)])
    assert got[9, "C&G"].cnt == 5 and got[9, "C"].cnt == 2 and got[10, "G"].cnt == 5
    # the mean is cut to a whole number: 3 over 2 reads is 1
    assert _run(spark, [_allele(9, "C&G", 5), _allele(9, "C", 2, 3)])[9, "C&G"].cnt == 7


def test_order_of_claims(spark):
    # both want 'G' at 10; the change at 8 comes first, and only what it took makes it outnumber 'G'
    got = _run(spark, [_allele(8, "A&CG", 4), _allele(8, "A", 3, 3), _allele(10, "G", 6, 6), _allele(9, "C&G", 20)])
    assert got[8, "A&CG"].cnt == 13 and got[9, "C&G"].cnt == 20
    # without that help the later one gets it
    got = _run(spark, [_allele(8, "A&CG", 4), _allele(10, "G", 6, 6), _allele(9, "C&G", 20)])
    assert got[8, "A&CG"].cnt == 4 and got[9, "C&G"].cnt == 26


def test_clips_join_their_change(spark):
    # right clip: change, then the reference from 11 on; left clip (read outwards): change, then the reference before 9
    right, left = "CG" + REF[10:20], "GC" + REF[:8][::-1]
    got = _run(spark, [_allele(9, "C&G", 2)], [_clip(3, 9, right, 5), _clip(5, 11, left, 7)])
    assert (got[9, "C&G"].cnt, got[9, "C&G"].cov_add, got[9, "C&G"].extracnt) == (14, 14, 12)
    wrong = "CG" + "".join("ACGT"["CGTA".index(c)] for c in REF[10:20])
    assert _run(spark, [_allele(9, "C&G", 2)], [_clip(3, 9, wrong, 5), _clip(5, 10, left, 7), _clip(3, 9 + 1, right, 1)])[9, "C&G"].cnt == 2
    # the change alone fits; no consensus never does
    assert _run(spark, [_allele(9, "C&G", 2)], [_clip(3, 9, "CG", 5), _clip(5, 11, "", 7)])[9, "C&G"].cnt == 7


def test_a_clip_is_used_once(spark):
    got = _run(spark, [_allele(9, "C&G", 2), _allele(9, "C&GT", 2)], [_clip(3, 9, "CGT" + REF[11:22], 4)])
    assert sorted(r.cnt for r in got.values()) == [2, 6] and got[9, "C&G"].cnt == 6


def test_empty_tables(spark):
    assert _run(spark, []) == {}
    assert _run(spark, [_allele(9, "C", 2, 2)])[9, "C"].extracnt == 0


def test_transfers_have_a_floor(spark):
    alleles = spark.createDataFrame([_allele(9, "A", 3)], ALLELES)
    take = alleles.select("region_id", "pos", "allele", *[(-2 * F.col(c)).alias(c) for c in COUNTS], F.lit(0).cast("long").alias("extracnt"),
                          F.lit(0).cast("long").alias("cov_add"), F.lit(-1).alias("sign"))
    row = transfer_counts(alleles, take).first()
    assert (row.cnt, row.tp_sum, row.q_sum, row.hicnt, row.cov_add) == (0, 0, 0.0, 0, 3)
    assert row.nm_sum == -3  # mismatches have no floor in the original


def test_depth_follows_added_reads(spark):
    # 12 reads of which 5 joined later, at a depth of 9: the depth becomes 12; 2 of 12 can't explain 9
    blocks = spark.createDataFrame([("chr1", 0, 1, REF)], "chr string, block long, block_start long, seq string")
    rows = [(_allele(9, "C&G", 12)[:-1] + (9,)), (_allele(10, "C&G", 12)[:-1] + (9,))]
    a = spark.createDataFrame(rows, ALLELES).withColumn("extracnt", F.when(F.col("pos") == 9, 5).otherwise(2).cast("long"))
    got = {r.pos: r for r in allele_stats(a, blocks, CallParams(realign=False)).collect()}
    assert got[9].freq_raw == 1.0 and got[9].tcov == 9 and abs(got[9].extrafreq_raw - 5 / 12) < 1e-12
    assert abs(got[10].freq_raw - 12 / 9) < 1e-12


VAR = ("region_id long, chr string, pos long, allele string, rank int, good boolean, freq_raw double, tcov long, sp long, ep long, "
       "ref_allele string, alt_allele string, vartype string")
AMP = "amplicon_id long, chr string, amp_group string, istart long, iend long, span string"


def _combine(spark, var, refs, amps):
    rows = combine_amplicons(spark.createDataFrame(var, VAR), spark.createDataFrame(refs, "region_id long, pos long, ref_tcov long"),
                             spark.createDataFrame([(i, "chr1", "chr1:1", s, e, f"span{i}") for i, s, e in amps], AMP)).collect()
    return [(r.pos, r.region_id, r.allele, r.vartype, r.good_span, r.good_amplicons, r.judged_amplicons, r.no_coverage, r.disagree) for r in rows]


def _snv(amp, allele, rank=1, good=True, freq=0.5, depth=100, pos=50):
    return (amp, "chr1", pos, allele, rank, good, freq, depth, pos, pos, "A", allele, "SNV")


def test_amplicons_agree(spark):
    got = _combine(spark, [_snv(1, "C"), _snv(2, "C", freq=0.6)], [], [(1, 10, 60), (2, 40, 90), (3, 60, 90)])
    assert got == [(50, 2, "C", "SNV", "span2", 2, 2, 0, 0)]
    # equal frequencies: the amplicon that starts first
    assert _combine(spark, [_snv(2, "C"), _snv(1, "C")], [], [(1, 40, 90), (2, 10, 60)])[0][1] == 2


def test_amplicons_without_the_variant(spark):
    got = _combine(spark, [_snv(1, "C"), _snv(3, "G", good=False)], [(2, 50, 80)], [(1, 10, 60), (2, 20, 70), (3, 30, 80), (4, 40, 90)])
    # 2 shows the reference, 3 a bad variant, 4 nothing and has no depth
    assert got == [(50, 1, "C", "SNV", "span1", 1, 4, 1, 0)]


def test_amplicons_disagree(spark):
    amps = [(1, 10, 60), (2, 20, 70)]
    assert _combine(spark, [_snv(1, "C", freq=0.6), _snv(2, "G")], [], amps) == [(50, 1, "C", "SNV", "span1", 1, 2, 0, 1)]
    # the second amplicon has 'C' too, behind its top allele: as many as before, settled
    got = _combine(spark, [_snv(1, "C", freq=0.6), _snv(2, "G"), _snv(2, "C", rank=2, freq=0.3)], [], amps)
    assert got == [(50, 1, "C", "SNV", "span1", 2, 2, 0, 0)]


def test_amplicon_edge_inside_the_variant(spark):
    def gap(amp, alt, freq):
        return (amp, "chr1", 50, alt, 1, True, freq, 100, 49, 60, "A" * 12, alt, "Deletion")

    # two amplicons show it; the third ends inside it and takes one off
    got = _combine(spark, [gap(1, "A", 0.5), gap(2, "A", 0.4)], [(3, 50, 90)], [(1, 10, 80), (2, 20, 80), (3, 30, 55)])
    assert got == [(50, 1, "A", "Deletion", "span1", 1, 1, 0, 0)]
    # a single one is never taken off
    assert _combine(spark, [gap(1, "A", 0.5)], [(3, 50, 90)], [(1, 10, 80), (3, 30, 55)]) == [(50, 1, "A", "Deletion", "span1", 1, 1, 0, 0)]


def test_amplicons_without_good_variants(spark):
    assert _combine(spark, [_snv(1, "C", good=False)], [(2, 50, 10)], [(1, 10, 60), (2, 20, 70)]) == []
    # a good variant outside the inner span is not looked at
    assert _combine(spark, [_snv(1, "C")], [], [(1, 60, 90)]) == []

"""The overlap search against every start of every pair, claims and count moves by hand."""

import random

from pilecall.operators.clip_overlap import clip_overlap_adjust, clip_overlaps, overlap_changes, settle_pairs
from tests.test_mnp_amplicon import ALLELES, CLIPS

REGION = "region_id long, chr string, region_start long, region_end long, contig_len long, max_rlen int"
SPANS = [(1, "chr1", 1, 64, 64, 40)]
REF = "ACGTTGCAAGCTAGGATCCATTGACCGTAGTCAGGCATTCAAGTCCTGACGATGACTTAGCGAT"


def first_overlap(seq5, seq3):
    """Every start (bp5, bp3) in order, compared step by step; beyond a text's end nothing is equal."""
    left = seq3[::-1]
    for i in range(len(seq5) - 8):
        for j in range(len(seq3) - 9):
            bad = steps = 0
            while j + steps < len(left) and i + steps <= len(seq5):
                bad += left[j + steps] != (seq5 + "?")[i + steps]
                if bad == 4:
                    break
                steps += 1
            ends = j + steps + 1 >= len(left) or i + steps >= len(seq5)
            if ends and steps - bad > 8 and bad / steps < 0.1:
                return i, j + 1, steps - bad
    return None


def test_overlaps_against_every_start(spark):
    rng = random.Random(3)
    pairs = []
    for k in range(400):
        core = "".join(rng.choices("ACGT", k=rng.choice([9, 10, 12, 20, 25, 45, 60, 90])))
        other = list(core)
        for _ in range(rng.randrange(0, 6)):
            other[rng.choice([rng.randrange(len(core)), 0, -1])] = rng.choice("ACGT")

        def flank():
            return "".join(rng.choices("ACGT", k=rng.choice([0, 0, 1, 5, 12])))
        # seq5 is read leftwards, so the shared bases come in reverse there
        pairs.append((k, flank() + core[::-1] + rng.choice(["", flank()]), rng.choice(["", flank()]) + "".join(other) + flank()))
    for k, letters in enumerate(["A", "AC"] * 10):
        pairs.append((400 + k, "".join(rng.choices(letters, k=rng.randrange(1, 30))), "".join(rng.choices(letters, k=rng.randrange(1, 30)))))
    got = {r.id: (r.bp5, r.bp3, r.score) for r in clip_overlaps(spark.createDataFrame(pairs, "id int, seq5 string, seq3 string")).collect()}
    want = {k: first_overlap(a, b) for k, a, b in pairs if len(a) > 10 and len(b) > 10}
    assert got == {k: v for k, v in want.items() if v}
    assert 100 < len(got) < 420


def _clip(side, pos, text, cnt):
    return (1, side, pos, text, cnt, cnt, 0, 8 * cnt, 30.0 * cnt, 60 * cnt, 0, cnt, 0)


def _frames(spark, clips):
    blocks = [("chr1", b, 32 * b + 1, REF[32 * b: 32 * b + 32]) for b in range(2)]
    return (spark.createDataFrame(clips, CLIPS), spark.createDataFrame(SPANS, REGION),
            spark.createDataFrame(blocks, "chr string, block long, block_start long, seq string"))


def _around(p3, p5, new, side):
    """The clip's text where ``new`` stands between REF[..p3) and REF[p5..], 20 bases long."""
    text = new + REF[p5 - 1:] if side == 3 else (REF[: p3 - 1] + new)[::-1]
    return text[:20]


def test_shapes_of_changes(spark):
    def change(p3, p5, new, spoil=None):
        clips = [_clip(3, p3, _around(p3, p5, new, 3), 5), _clip(5, p5, spoil or _around(p3, p5, new, 5), 4)]
        return [(r.pos, r.allele, r.is_ins, r.ref_base) for r in overlap_changes(*_frames(spark, clips)).collect()]

    new = "GATTACAGATTGCC"
    # an insertion repeats the base at its place, as both ends of the known part count
    assert change(30, 30, new) == [(29, "+" + REF[29] + new, True, REF[28])]
    assert change(30, 34, new) == [(29, "+" + new[:10] + "&" + new[10:], True, REF[28])]
    assert change(24, 42, new) == [(24, "-18^" + new, False, REF[23])]
    assert change(26, 40, new) == [(26, "-14^" + new, False, REF[25])]
    # a text of one base, and a rest that isn't the reference (H10), give nothing
    assert change(30, 30, "AAAAAAAAAAAAAA") == []
    assert change(30, 30, new, new[::-1] + "".join("ACGT"["CATG".index(c)] for c in _around(30, 30, new, 5)[14:])) == []
    assert overlap_changes(*_frames(spark, [])).collect() == []


def test_each_clip_serves_once_and_counts_move(spark):
    new = "GATTACAGATTGCC"
    left, right = _around(30, 30, new, 3), _around(30, 30, new, 5)
    # clips that hold the change and nothing beyond it, so every pair spells one
    clips = [_clip(3, 30, new, 5), _clip(5, 30, new[::-1], 4), _clip(5, 31, new[::-1], 9), _clip(3, 29, new, 5), _clip(3, 28, new, 7), _clip(3, 45, "ACGT", 50)]
    clips, spans, blocks = _frames(spark, clips)
    changes = overlap_changes(clips, spans, blocks)
    won = settle_pairs(changes, clips)
    assert changes.count() == 6
    assert {(r.p5, r.p3) for r in won.collect()} == {(31, 28), (30, 29)}  # more reads first, then position

    one, spans, blocks = _frames(spark, [_clip(3, 30, left, 5), _clip(5, 30, right, 4)])
    found = settle_pairs(overlap_changes(one, spans, blocks), one)

    def allele(text, cnt, is_ins=False):
        return (1, "chr1", 1, 64, 64, 29, text, is_ins, cnt, cnt, 0, 10 * cnt, 30.0 * cnt, 60 * cnt, cnt, cnt, 0, False, False, cnt)

    rows = clip_overlap_adjust(spark.createDataFrame([allele(REF[28], 3), allele("T" + REF[28], 7, True)], ALLELES), found, one).collect()
    got = {(r.allele, r.is_ins): r for r in rows}
    whole = got["+" + REF[29] + new, True]
    assert (whole.cnt, whole.extracnt, whole.cov_add, whole.tp_sum, whole.pstd) == (9, 9, 4, 72, True)
    assert (whole.chr, whole.region_start, whole.region_end) == ("chr1", 1, 64)
    assert got[REF[28], False].cnt == 0 and got[REF[28], False].cov_add == 3  # 5 taken from 3 leaves none; its depth stays
    assert got["T" + REF[28], True].cnt == 7

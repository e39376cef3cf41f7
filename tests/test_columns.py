"""What is worked out in columns, batch by batch, against the same letter by letter."""

import random

from tests.oracle_check import rows_of

COLS = ("region_id long, chr string, region_start long, region_end long, contig_len long, start_pos long, mapq int, seq string, seq_qual string, tnm int, "
        "rlen1 int, rlen2 int, dir boolean, idx int, len int, op string, rofs int, qofs int, pofs int, nops int, prev_op string, first_op string, seg_start long, wseq string, wstart long")


def _text(rnd, n, letters="ACGT"):
    return "".join(rnd.choice(letters) for _ in range(n))


def _ops(spark, kind, seed):
    """Op rows of random reads over one reference: M runs with mismatches in a row, or clips on both sides that go on as the reference does."""
    rnd = random.Random(seed)
    under = _text(rnd, 60, "ACGTACGTACGTN.")
    rows = []
    for k in range(150):
        n, clip = 12, rnd.randint(1, 8)
        start = rnd.randint(9, 44)
        seq = list(under[start - 1 - (clip if kind == 5 else 0):][:n + clip].replace(".", "A"))
        for _ in range(rnd.choice([0, 1, 2, 2, 3])):
            at = rnd.randrange(len(seq))
            for j in range(at, min(at + rnd.choice([1, 2, 3, 5]), len(seq))):
                seq[j] = rnd.choice("ACGTN")
        seq, qual = "".join(seq), _text(rnd, len(seq), "#+5I")
        if k % 25 == 3:
            seq, qual = rnd.choice([(seq[:4], qual), (seq, None), (seq, qual[:3]), ("Ä" + seq[1:], qual)])
        region = (k % 3, "chr1", *rnd.choice([(10, 40), (20, 23), (1, 60)]), rnd.choice([60, 15]))
        common = (start, rnd.choice([10, 60, None]) if k % 25 == 4 else 30, seq, qual, 4, n, n + clip, rnd.random() < 0.5)
        idx, op, at, first = {0: (0, ("M", n), 0, start), 5: (0, ("S", clip), 0, start), 3: (1, ("S", clip), n, start + n)}[kind]
        rows.append((*region, *common, idx, op[1], op[0], first - start, at, min(at, n), 2, None, "M", first, under[4:], 5))
    return spark.createDataFrame(rows, COLS)


def _summed(events):
    from pilecall.operators import pileup as PU

    return rows_of(PU.aggregate_events(events).toPandas())


def test_merged_mismatches_in_columns(spark):
    from pilecall.operators import pileup as PU
    from pilecall.params import CallParams

    ops = PU._with_step(_ops(spark, 0, 1)).localCheckpoint()
    assert 0 < ops.where("odd").count() < 20
    for p in (CallParams(goodq=25.0), CallParams(goodq=25.0, trim=5)):
        got = _summed(PU._run_events(ops, p))
        assert got == _summed(PU._odd_run_events(ops, p))
        assert sum("&" in r["allele"] for r in PU._run_events(ops, p).collect()) > 0
    plan = PU._run_events(ops.where("NOT odd"), p)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan


def test_rescued_clips_in_columns(spark):
    from pyspark.sql import functions as F

    from pilecall.operators import pileup as PU
    from pilecall.params import CallParams

    for side in (5, 3):
        ops = PU._with_step(_ops(spark, side, 2)).localCheckpoint()
        assert {r["step"] for r in ops.select("step").distinct().collect()} == {"clip", "edge"}
        p = CallParams(goodq=25.0)
        got = _summed(PU._ref_events(ops, p))
        assert got == _summed(PU._with_high(PU._edge_events(ops.withColumn("step", F.lit("edge")), p)))
        assert len(got[1]) > 10


def test_op_table_holds_the_ops_that_count_in_their_region(spark):
    from pilecall.operators import pileup as PU
    from pilecall.params import CallParams

    cols = ("region_id long, chr string, region_start long, region_end long, contig_len long, start_pos long, mapq int, seq string, qual string, cigar string, "
            "nm int, tnm int, rlen1 int, rlen2 int, flag int")
    reads = [("3S4M2D4M3N2M2S", "ACGTACGTACGTACG"), ("4M1I4M2I4M", "ACGTACGTACGTACG"), ("4H5M", "ACGTA"), ("*", "ACGT")]
    rr = spark.createDataFrame([(1, "chr1", 14, 17, 100, 10, 30, s, "I" * len(s), c, 2, 0, 8, 9, 0) for c, s in reads], cols)
    ops = PU.op_table(rr)
    assert sorted((r["op"], r["seg_start"]) for r in ops.collect()) == [("D", 14), ("I", 18), ("M", 10), ("M", 14), ("M", 16), ("N", 20)]
    blocks = spark.createDataFrame([("chr1", k, 32 * k + 1, "ACGT" * 8) for k in range(3)], "chr string, block long, block_start long, seq string")
    alleles = {(r["pos"], r["allele"]): r["cnt"] for r in PU.pileup(rr, blocks, CallParams()).collect()}
    assert alleles[(14, "-2")] == 1 and alleles[(17, "+CG")] == 1


def test_pieces_of_cigars_in_columns(spark):
    import pyarrow as pa

    from pilecall.functions.cigar import parsed

    out = parsed(pa.array([["3S", "5I", "2M", "4I"], [], ["7="], ["12M"]], pa.list_(pa.string())))
    assert [len(x["ops"]) for x in out.to_pylist()] == [4, 0, 1, 1]
    assert [(x["ref_span"], x["rlen1"], x["rlen2"], x["indel_len"], x["md_len"]) for x in out.to_pylist()] == [(2, 11, 14, 9, 2), (0,) * 5, (7, 7, 7, 0, 7), (12, 12, 12, 0, 12)]
    assert [x["op"] for x in out.to_pylist()[0]["ops"]] == ["S", "I", "M", "S"]


def _clipped(spark, seed):
    """Region x read pairs clipped on either side, with the reference: some clips go on as the reference does, some texts are odd."""
    rnd = random.Random(seed)
    under = _text(rnd, 128)
    rows = []
    for k in range(120):
        a, b = rnd.choice([0, 0, 3, 7, 12]), rnd.choice([0, 0, 4, 9, 14])
        start = rnd.randint(20, 80)
        seq = list(under[start - 1 - a:start - 1 + 10 + b])
        for _ in range(rnd.choice([0, 1, 4])):
            seq[rnd.randrange(len(seq))] = rnd.choice("ACGTN")
        seq, qual = "".join(seq), _text(rnd, len(seq), "#+5IIII")
        if k % 20 == 3:
            seq, qual = rnd.choice([(seq[:-2], qual), (seq, qual[:-2]), ("Ä" + seq[1:], qual), (seq, "é" + qual[1:])])
        rows.append((k % 2, "chr1", 40, 60, 100, start, 30, seq, qual, (f"{a}S" if a else "") + "10M" + (f"{b}S" if b else ""), 1, 1, 10, 10 + a + b, rnd.choice([0, 16])))
    cols = ("region_id long, chr string, region_start long, region_end long, contig_len long, start_pos long, mapq int, seq string, qual string, cigar string, "
            "nm int, tnm int, rlen1 int, rlen2 int, flag int")
    blocks = [("chr1", k, 32 * k + 1, under[32 * k:32 * k + 32]) for k in range(4)]
    return spark.createDataFrame(rows, cols), spark.createDataFrame(blocks, "chr string, block long, block_start long, seq string")


def test_clips_walked_in_columns(spark, monkeypatch):
    from pyspark.sql import functions as F

    from pilecall.operators import clips as CL
    from pilecall.params import CallParams

    rr, blocks = _clipped(spark, 3)
    p = CallParams(buffer=15)
    kept = CL.kept_clips(rr, blocks, p)
    assert any("/clip_ops-" in f for f in kept.inputFiles())  # the look for long stretches doesn't join the reads again
    want = ["region_id", "side", "pos", "m", "base0", "w", "seq", "seq_qual", "dir"]
    rows = sorted(map(str, kept.select(want).collect()))
    bases = {(r["region_id"], r["side"], r["pos"], r["cidx"], r["base"]): (r["cnt"], r["q_sum"]) for r in CL.softclip_table(CL.kept_bases(kept)).collect()}
    by_hand = {}
    for r in kept.collect():
        for t in range(r["w"]["qn"]):
            at = r["base0"] - t if r["side"] == 5 else r["base0"] + t
            key = (r["region_id"], r["side"], r["pos"], t, r["seq"][at:at + 1])
            n, q = by_hand.get(key, (0, 0))
            by_hand[key] = n + 1, q + (ord(r["seq_qual"][at]) if at < len(r["seq_qual"]) else 0) - 33
    assert bases == by_hand and len(bases) > 100
    monkeypatch.setattr(CL, "is_whole_clip", lambda: F.lit(False))
    assert rows == sorted(map(str, CL.kept_clips(rr, blocks, p).select(want).collect()))


def test_consensus_needs_one_shuffle_of_the_bases(spark):
    from pilecall.operators import clips as CL

    bases = spark.createDataFrame([(1, 3, 10, 0, "A", 3, 90), (1, 3, 10, 1, "C", 2, 60), (1, 3, 10, 0, "A", 1, 30)], "region_id long, side int, pos long, cidx int, base string, cnt long, q_sum long")
    out = CL.softclip_consensus(CL.softclip_table(bases))
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert [(r["consensus"], r["total"], r["match"]) for r in out.collect()] == [("AC", 6, 6)]


def test_indel_events_in_columns():
    """Which ops an event takes, against a walk over each read's ops."""
    import pyarrow as pa

    from pilecall.functions.cigar import parsed
    from pilecall.operators.compound import _found

    rnd = random.Random(4)
    cigars = [[f"{rnd.randint(1, 5)}{rnd.choice('MMMIDSN')}" for _ in range(rnd.randint(0, 9))] for _ in range(300)]
    ops = parsed(pa.array(cigars, pa.list_(pa.string()))).field("ops")
    for got, read in zip(_found(ops, 2).to_pylist(), ops.to_pylist(), strict=True):
        want, free, read = [], 0, read + [{"op": "", "raw": None, "len": None}] * 3
        for i, x in enumerate(read[:-3]):
            if i < free or x["op"] not in ("I", "D"):
                continue
            a, b = read[i + 1:i + 3]
            kind = 2 if a["raw"] == "M" and a["len"] <= 2 and b["raw"] in ("I", "D") else 1 if x["op"] == "D" and a["raw"] == "I" else 0
            free, follow = i + 1 + kind, read[i + 1 + kind]
            want.append({"kind": kind, **{c: x[c] for c in ("op", "len", "qofs", "pofs", "rofs")}, "m1": a["len"], "m2": b["len"], "o2": b["raw"],
                         "more": follow["len"] if follow["raw"] == "M" else 0})
        assert got == want


def test_mismatch_scans_in_columns():
    """How far an event goes into the match behind it, against a walk over each one's bases."""
    import pyarrow as pa

    from pilecall.operators.compound import _extended

    rnd = random.Random(5)
    rows = []
    for _ in range(400):
        n = rnd.randint(0, 12)
        ref = _text(rnd, n, "ACGT" * 6 + "N.")
        read = "".join(rnd.choice("ACGTÄN") if rnd.random() < 0.4 else b for b in ref)
        rows.append((rnd.random() < 0.5, n, read[:rnd.choice([n, n, 5])], "".join(rnd.choice("I" * 9 + "#") for _ in range(rnd.choice([n, n, 6]))), ref[:rnd.choice([n, n, 7])]))
    got = _extended(*[pa.array([r[k] for r in rows]) for k in range(5)], 25.0, 3).to_pylist()
    for out, (deletion, n, read, qual, ref) in zip(got, rows, strict=True):
        run = off = nm = 0
        for t in range(n):
            b, q, u = read[t:t + 1], ord(qual[t]) - 33 if t < len(qual) else -33, ref[t:t + 1]
            if run > 3 or b in ("", "N") or q < 25 or (deletion and u == "N"):
                break
            if u not in ("", "."):
                run, off, nm = (0, t + 1, nm + 1) if b != u else (run + 1, off, nm)
        assert out == {"off": off, "nm": nm}
    assert sum(x["nm"] > 1 for x in got) > 20


def test_normalized_reads_are_stored_without_their_op_table(spark):
    """Rules and clips on reads with missing texts; the op table still describes the CIGAR as it came."""
    from pilecall.functions.cigar import with_cigar_columns
    from pilecall.operators.normalize import normalize_cigar

    rnd = random.Random(6)
    under = _text(rnd, 256)
    read = under[99:119] + under[122:142]
    rows = [("clip", 100, "20M3D15M5S", read), ("near", 100, "20M3D5M15S", read), ("none", 100, "20M3D20M", None), ("short", 100, "20M3D20M", read[:8]), ("end", 100, "20M3D5M", read[:25]),
            ("two", 100, "20M3D5M2I13M", read), ("odd", 100, "20=3D20X", read), ("plain", 100, "40M", read)]
    reads = with_cigar_columns(spark.createDataFrame([(*r, r[3] and "I" * len(r[3]), "chr1") for r in rows], "name string, start_pos long, cigar string, seq string, qual string, chr string"))
    blocks = spark.createDataFrame([("chr1", k, 32 * k + 1, under[32 * k:32 * k + 32]) for k in range(8)], "chr string, block long, block_start long, seq string")
    out = normalize_cigar(reads, blocks)
    assert out.columns == reads.columns
    assert [f for f in out.inputFiles() if "/indel_reads-" in f] and "aggregate(" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["name"]: (r["start_pos"], r["cigar"], len(r["ops"])) for r in out.collect()}
    assert got == {"clip": (100, "20M3D20M", 4), "near": (100, "20M20S", 4), "none": (100, "20M3D20M", 3), "short": (100, "20M3D20M", 3), "end": (100, "20M5S", 3),
                   "two": (100, "20M8D7I13M", 5), "odd": (100, "20=3D20X", 3), "plain": (100, "40M", 1)}


def test_spans_are_stored_before_clips_meet_them(spark, monkeypatch):
    """They come from all reads, which would be joined to the regions again for each of their uses."""
    from pilecall.operators import clip_overlap as CO

    names = []
    monkeypatch.setattr(CO, "stored", lambda df, name: names.append(name) or df)
    clips = spark.createDataFrame([], "region_id long, side int, pos long, consensus string, cnt long")
    spans = spark.createDataFrame([(1, "chr1", 1, 50, 64, 40)], "region_id long, chr string, region_start long, region_end long, contig_len long, max_rlen int")
    blocks = spark.createDataFrame([("chr1", 0, 1, "ACGT" * 8)], "chr string, block long, block_start long, seq string")
    assert CO.overlap_insertions(clips, spans, blocks).count() == 0
    assert names == ["spans"]


def test_an_edge_reads_shape_is_worked_out_once():
    from pilecall.fixtures import PRELUDE, SPARK_PRELUDE

    assert SPARK_PRELUDE.count("AS shape") == PRELUDE.count("AS shape") == 1
    assert "inline(array(struct(CASE shape" in SPARK_PRELUDE

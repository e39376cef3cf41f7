"""Queries that failed on larger or unusual tables; each compares with its SQL or with rows made by hand."""

from tests.oracle_check import duck, rows_of

SF = "/root/testdata/sf0.001"


def test_scan_alignments_takes_contigs_that_nothing_has_asked_for(spark):
    import __spark_entry__ as E

    got = rows_of(E.queries()["scan_alignments"](spark, SF).toPandas())
    assert got == rows_of(duck(SF).execute(E.oracle_sql()["scan_alignments"]).df())


def _ops(spark, rows):
    """Op rows of 8M runs from hand-made (read start, read bases, qualities, mapping quality, reverse)."""
    cols = ("region_id long, chr string, region_start long, region_end long, contig_len long, start_pos long, mapq int, seq string, seq_qual string, "
            "tnm int, rlen1 int, rlen2 int, dir boolean, idx int, len int, op string, rofs int, qofs int, pofs int, nops int, prev_op string, first_op string, seg_start long")
    return spark.createDataFrame([(1, "chr1", 3, 9, 100, s, mq, seq, qual, 0, 8, 8, rev, 0, 8, "M", 0, 0, 0, 1, None, "M", s) for s, seq, qual, mq, rev in rows], cols)


ODD = [(1, "ACGTACGT", "IIIIIIII", 30, False), (1, "ACGTACGA", "III#IIII", 40, True), (4, "ACNTACGT", "ABCDEFGH", 20, False),
       (4, "ACGTACGT", "ABC", 20, False), (5, "ACGTACGT", None, 20, True), (5, "ACGTACGT", "IIIIIIII", None, True), (6, "ACG", "III", 10, False),
       (2, "ACÄTACGT", "IIIIIIII", 50, False), (2, "ACGTACGT", "ÄIIIIIII", 50, False), (9, "ACGTACGT", "IIIIIIII", None, None), (40, "ACGTACGT", "IIIIIIII", 30, False)]


def test_sums_of_bases_are_those_of_single_bases(spark):
    from pilecall.operators import pileup as PU
    from pilecall.params import CallParams

    ops = _ops(spark, ODD * 3)
    for p in (CallParams(), CallParams(trim=5)):
        got = rows_of(PU.aggregate_events(PU._base_events(ops, p)).toPandas())
        assert got == rows_of(PU.aggregate_events(PU._letter_events(ops, p)).toPandas())
        assert got[1]


def test_pileup_hands_sums_to_the_shuffle_and_not_bases(spark):
    from pilecall.operators import pileup as PU
    from pilecall.params import CallParams

    ops = _ops(spark, ODD[:2] * 200).repartition(1)
    events = PU._plain_events(ops, CallParams())
    assert events.agg({"cov": "sum"}).first()[0] == 400 * 6
    assert events.count() <= 2 * 8


def test_costly_columns_are_computed_once(spark):
    from pyspark.sql import functions as F

    from pilecall.operators.clips import kept_clips
    from pilecall.plans import catalog as K

    fx = K._fx(spark, SF)
    plan = kept_clips(K._rr(spark, SF), fx["ref_blocks"], K.CHECK).select(F.col("w.qn"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(sequence(0, (m#") == 1


def test_breakpoint_search_tries_only_offsets_with_an_equal_part(spark):
    from pilecall.operators.realign import breakpoint_search
    from pilecall.operators.clips import softclip_consensus
    from pilecall.plans import catalog as K

    fx = K._fx(spark, SF)
    df = breakpoint_search(softclip_consensus(K._clip_table(spark, SF)), fx["ref_blocks"], fx["regions"], fx["contigs"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(sequence(0, (length(consensus") == 1
    assert rows_of(df.toPandas()) == rows_of(duck(SF).execute(__import__("__spark_entry__").oracle_sql()["breakpoint_search"]).df())


def test_stretches_between_merged_mismatches_are_sums(spark):
    """Two reads copied 200 times, one with an MNP inside the region, one that loses its qualities half way: few events, the counts of single bases."""
    from pyspark.sql import functions as F

    from pilecall.operators import pileup as PU
    from pilecall.params import CallParams

    rows = [(1, "ACTGACGA", "IIIIIIII", 30, False), (2, "CGTACGTT", "IIII", 20, True)]
    ops = _ops(spark, rows * 200).repartition(1).withColumns({"tnm": F.lit(3), "wseq": F.lit("ACGTACGTACGTACGT"), "wstart": F.lit(1).cast("long")})
    ops = PU._with_step(ops)
    assert {r.step for r in ops.select("step").distinct().collect()} == {"run"}
    events = PU._ref_events(ops, CallParams())
    whole = events.where("cov > 1")
    assert whole.count() and whole.count() <= 16  # sums of 200 bases, not bases
    got = {(r.pos, r.allele): (r.cnt, r.nm_sum, r.q_sum) for r in PU.aggregate_events(events).collect() if r.allele}
    # read 1 differs at positions 3, 4 (one MNP, counted once from there on) and 8, read 2 at position 9
    assert got[(3, "T&G")] == (200, 400, 8000.0)
    assert got[(4, "T")][:2] == (200, 600)
    assert got[(5, "A")][:2] == (400, 1000)
    assert got[(8, "A")] == (200, 400, 8000.0)
    assert got[(9, "T")][0] == 200


def test_ops_are_stored_with_the_branch_that_reads_them(spark):
    from pilecall.operators import pileup as PU
    from pilecall.plans import catalog as K

    ops = PU.op_table(K._rr(spark, SF))
    assert {"sum", "run", "edge", "gap"} <= {r.step for r in ops.select("step").distinct().collect()}
    plan = ops.where("step = 'gap'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(step), EqualTo(step,gap)]" in plan


def test_reads_of_one_whole_run_are_summed_without_the_op_table(spark):
    """Ordinary and odd reads: the same sums as through the op table, which holds only the reads that need it."""
    from pilecall.operators import pileup as PU
    from pilecall.params import CallParams

    cols = ("region_id long, chr string, region_start long, region_end long, contig_len long, start_pos long, mapq int, seq string, qual string, cigar string, "
            "nm int, tnm int, rlen1 int, rlen2 int, flag int")
    odd = [(3, 30, "ACGTACGT", "IIIIIIII", "8M", 0, 0), (4, 20, "ACNTACGA", "III#IIII", "8=", 1, 16), (2, 20, "ACGTACGT", "ABC", "8M", 0, 0), (5, 20, "ACGTACGT", None, "8M", 0, 16),
           (5, None, "ACGTACGT", "IIIIIIII", "8M", 0, 0), (2, 50, "ACÄTACGT", "IIIIIIII", "8M", 0, 0), (4, 10, "ACG", "III", "8M", 0, 0), (1, 9, "ACGTACGT", "IIIIIIII", "4M2D4M", 2, 0)]
    rows = [(1, "chr1", 3, 9, 100 if s < 5 else None, s, mq, seq, q, c, nm, 0, 8, 8, fl) for s, mq, seq, q, c, nm, fl in odd] * 3
    rr = spark.createDataFrame(rows, cols)
    blocks = spark.createDataFrame([("chr1", 0, 1, "ACGT" * 8)], "chr string, block long, block_start long, seq string")
    assert rr.where(PU._is_quiet()).count() == 2 * 3
    for p in (CallParams(), CallParams(trim=5)):
        got = rows_of(PU.aggregate_events(PU.pileup_events(rr, blocks, p)).toPandas())
        assert got == rows_of(PU.aggregate_events(PU._plain_events(PU.op_table(rr), p)).toPandas())
        assert got[1]


def test_reads_that_pass_the_op_table_by_are_told_from_stored_columns(spark):
    """So neither half of the reads parses the CIGARs of the other."""
    from pilecall.operators import pileup as PU
    from pilecall.plans import catalog as K

    plan = K._rr(spark, SF).where(~PU._is_quiet()).select("region_id", "ops")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("octet_length(")  # the filter stands below the parse


def test_microsatellite_search_equals_the_count_of_every_copy(spark):
    """Repeats at either side, none, shorter and empty texts, against the copies counted one by one."""
    import itertools

    from pilecall.operators.calls import msi_score

    def by_hand(t1, t2, left):
        s1, best = (left or "") + t1, (0.0, 0)
        for k in range(1, min(8, len(t1)) + 1):
            unit, c = t1[-k:], 0
            while (c + 1) * k <= len(s1) and s1.endswith(unit * (c + 1)):
                c += 1
            d = 0
            while (d + 1) * k <= len(t2) and t2.startswith(unit * (d + 1)):
                d += 1
            best = max(best, (float(c + d), k), key=lambda x: x[0])
        joined = t1 + t2
        return best + (next((i for i, x in enumerate(t2) if joined[i] != x), len(t2)),)

    texts = ["", "A", "AAAA", "ACACAC", "CACACACACA", "GATTACAGATTACA", "TTTTTTTTTTTTTTTTTTA", "ACGTTGCA"]
    cases = [(a, b, c) for a, b, c in itertools.product(texts, texts, [*texts[:4], None])]
    df = spark.createDataFrame(cases, "t1 string, t2 string, l string")
    for r in msi_score(df, "t1", "t2", "l").collect():
        assert (r.msi.msi, r.msi.unit, r.msi.shift3) == by_hand(r.t1, r.t2, r.l), r
    expr = msi_score(df, "t1", "t2")._jdf.queryExecution().analyzed().toString()
    assert "repeat(right(t1" in expr and "THEN 1 ELSE size" in expr  # one differing copy settles a count


def _aligned(spark, rows):
    """Parsed reads and reference blocks (256 bases) from (name, start, CIGAR, offsets of changed bases, inserted bases)."""
    import random
    import re

    from pilecall.operators.read_filters import with_read_columns

    text = "".join(random.Random(5).choice("ACGT") for _ in range(256))
    other = dict(zip("ACGT", "CGTA"))
    out = []
    for name, start, cigar, changed, new in rows:
        ops = [(int(n), o) for n, o in re.findall(r"(\d+)([MIDS])", cigar)]
        at, seq = start - (ops[0][0] if ops[0][1] == "S" else 0), ""
        for n, o in ops:
            seq += new if o == "I" else "" if o == "D" else text[at - 1:at - 1 + n]
            at += 0 if o == "I" else n
        seq = "".join(other[b] if i in changed else b for i, b in enumerate(seq))
        out.append((name, "tumor", "chr1", start, 0, 60, cigar, seq, "I" * len(seq), 8))
    reads = spark.createDataFrame(out, "read_name string, sample string, chr string, start_pos long, flag int, mapq int, cigar string, seq string, qual string, nm int")
    blocks = spark.createDataFrame([("chr1", k, 32 * k + 1, text[32 * k:32 * k + 32]) for k in range(8)], "chr string, block long, block_start long, seq string")
    return with_read_columns(reads), blocks, text, {x[0]: x[7] for x in out}


def test_complex_indels_meet_their_regions_once(spark):
    from pilecall.operators.compound import complex_events
    from pilecall.params import CallParams

    # a change every third base keeps a scan going beyond the bases that most need
    reads, blocks, text, seqs = _aligned(spark, [("far", 50, "10M2I30M", {14, 17, 20, 23, 26}, "GA"), ("out", 50, "10M3D30M", {}, ""), ("in", 70, "10M3D30M", {}, "")])
    regions = spark.createDataFrame([(1, "chr1", 70, 90, 256)], "region_id long, region_chr string, region_start long, region_end long, contig_len long").drop("region_chr")
    events = complex_events(reads.crossJoin(regions), blocks, CallParams(goodq=25.0))
    assert any("/indels-" in f for f in events.inputFiles())  # the look for long stretches doesn't join the reads again
    got = sorted((r["pos"], r["allele"], r["cnt"]) for r in events.collect())
    # the insertion lies before the region: its bases cover all the same; of the deletions only the one inside is left
    assert got == [(p, "", 0) for p in range(60, 75)] + [(80, "-3", 1)]
    wide = reads.where("read_name = 'far'").crossJoin(regions.selectExpr("region_id", "1L AS region_start", "200L AS region_end", "contig_len"))
    keys = {r["allele"] for r in complex_events(wide, blocks, CallParams(goodq=25.0)).collect()}
    assert keys == {"", "+GA&" + seqs["far"][12:27]}


def test_normalized_clips_are_walked_as_far_as_they_match(spark):
    from pilecall.operators.normalize import normalize_cigar

    reads, blocks, _, _ = _aligned(spark, [("all", 60, "20M20S", {}, ""), ("six", 60, "20M20S", {27}, ""), ("two", 60, "20M20S", {20, 21, 22, 23}, ""),
                                           ("head", 80, "20S20M", {}, ""), ("part", 80, "20S20M", {12}, ""), ("plain", 60, "40M", {}, ""), ("empty", 60, "20M0I20M", {}, "")])
    out = normalize_cigar(reads, blocks)
    assert any("/indel_reads-" in f for f in out.inputFiles())  # clips and indels are parsed once
    got = {r["read_name"]: (r["start_pos"], r["cigar"]) for r in out.collect()}
    assert got == {"all": (60, "40M"), "six": (60, "27M13S"), "two": (60, "20M20S"), "head": (60, "40M"), "part": (73, "13S27M"),
                   "plain": (60, "40M"), "empty": (60, "20M0I20M")}


def test_cigars_are_parsed_with_one_search(spark):
    from pilecall.functions.cigar import with_cigar_columns

    df = spark.createDataFrame([(1, "3I4=2X1D5M2N6M2I"), (1, "*"), (1, None), (1, "10H5S20M")], "start_pos long, cigar string")
    out = with_cigar_columns(df)
    assert out._jdf.queryExecution().analyzed().toString().count("regexp_extract_all(") == 1
    rows = out.collect()
    assert [tuple(x) for x in rows[0]["ops"]] == [
        (0, 3, "S", "I", 0, 0, 0, 8), (1, 4, "M", "M", 0, 3, 0, 8), (2, 2, "M", "M", 4, 7, 4, 8), (3, 1, "D", "D", 6, 9, 6, 8),
        (4, 5, "M", "M", 7, 9, 6, 8), (5, 2, "N", "N", 12, 14, 11, 8), (6, 6, "M", "M", 14, 14, 11, 8), (7, 2, "S", "I", 20, 20, 17, 8)]
    assert [rows[0][c] for c in ("ref_span", "rlen1", "rlen2", "indel_len", "md_len", "end_pos")] == [20, 22, 22, 6, 18, 20]
    assert [r["ops"] for r in rows[1:3]] == [[], []] and rows[3]["rlen2"] == 25

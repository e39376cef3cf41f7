"""Insertions and replacements from two overlapping clips (H7, H8, with H10 and the clip order J4).

Reads that run into a long change are clipped on its left side (3' clips) and on its
right side (5' clips). Where the two consensus texts overlap, together they spell the
change. The clips come from aggregated rows: one text and one set of counts per clip
position, paired by the band join C12, so work follows positions and not depth.

The overlap search looks at each diagonal of a pair once: what matters of it are its
last mismatches, since an overlap has to reach the end of one text. A row holds its
own pair only; nothing is shuffled for the search.

Edge cases: empty clips, texts of 10 bases and fewer, and pairs without an overlap give
no row; reference beyond the contig is never compared; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pilecall.functions.exprs import low_complexity
from pilecall.operators.joins import with_reference
from pilecall.operators.mnp import COUNTS, KEY, transfer_counts
from pilecall.operators.realign import clip_pair_join
from pilecall.session import ensure_checkpoint_dir, stored

MIN_CLIP = 10  # both texts are longer
MIN_SAME = 8  # an overlap has more equal bases
MAX_MISMATCHES = 3
MAX_RATE = 0.1
_REGION = ["chr", "region_start", "region_end", "contig_len"]


def clip_overlaps(pairs: DataFrame) -> DataFrame:
    """H8: pairs (seq5, seq3, both read away from the alignment) with their first overlap.

    ``bp5`` bases of seq5 come before the overlap and ``bp3`` - 1 bases of seq3 behind it;
    ``score`` counts equal bases. First is the smallest (bp5, bp3).

    A diagonal has n cells until one text ends; when seq5 ends first, the comparison makes one
    more step, which is a mismatch. An overlap that starts behind the m-th last mismatch has m
    of them; a fourth mismatch is allowed as the very last step only, and then is not counted as length.
    """
    texts = "named_struct('c5', split(seq5, ''), 'c3', split(reverse(seq3), ''), 'l5', length(seq5), 'l3', length(seq3))"
    diagonals = (
        "transform(sequence(9 - l3, l5 - 1), d -> named_struct('i', greatest(d, 0), 'j', greatest(-d, 0), "
        "'n', least(l5 - greatest(d, 0), l3 - greatest(-d, 0)), 'step', CASE WHEN l5 - greatest(d, 0) < l3 - greatest(-d, 0) THEN 1 ELSE 0 END, "
        "'miss', filter(sequence(0, least(l5 - greatest(d, 0), l3 - greatest(-d, 0)) - 1), k -> c5[greatest(d, 0) + k] <> c3[greatest(-d, 0) + k])))"
    )
    starts = []
    for m in range(MAX_MISMATCHES + 1, -1, -1):
        at = f"CASE WHEN size(x.miss) = {m} THEN 0 ELSE x.miss[size(x.miss) - {m + 1}] + 1 END"
        bad, reach = f"({m} + x.step)", f"(x.n - ({at}) + x.step)"
        tests = []
        if m <= MAX_MISMATCHES:
            tests.append((f"{bad} <= {MAX_MISMATCHES} AND {reach} - {bad} > {MIN_SAME} AND {bad} / {reach} < {MAX_RATE}", f"{reach} - {bad}"))
        if m >= MAX_MISMATCHES:  # the mismatch too many is the last step: the added one, or the last cell
            last = "x.step = 1" if m == MAX_MISMATCHES else "x.step = 0 AND x.miss[size(x.miss) - 1] = x.n - 1"
            over = MAX_MISMATCHES + 1
            tests.append((f"{last} AND {reach} - 1 - {over} > {MIN_SAME} AND {over} / ({reach} - 1) < {MAX_RATE}", f"{reach} - 1 - {over}"))
        for cond, score in tests:
            starts.append(f"WHEN size(x.miss) >= {m} AND {cond} AND x.j + ({at}) < l3 - 9 AND x.i + ({at}) < l5 - 8 "
                          f"THEN named_struct('bp5', x.i + ({at}), 'bp3', x.j + ({at}) + 1, 'score', {score})")
    out = pairs.where((F.length("seq5") > MIN_CLIP) & (F.length("seq3") > MIN_CLIP)).select("*", F.expr(f"inline(array({texts}))"))
    first = f"array_min(filter(transform({diagonals}, x -> CASE {' '.join(starts)} END), y -> y IS NOT NULL))"
    out = out.select("*", F.expr(f"inline(array({first}))")).drop("c5", "c3", "l5", "l3")
    return out.where(F.col("score").isNotNull())


def _beside(rest: str, ref: str) -> str:
    """At most two mismatches and under 15 percent between a clip's rest and the reference beside the change."""
    bad = (f"size(filter(sequence(1, least(length({rest}), length({ref}))), "
           f"i -> substr({rest}, i, 1) <> substr({ref}, i, 1)))")
    bad = f"CASE WHEN length({rest}) = 0 OR length({ref}) = 0 THEN 0 ELSE {bad} END"
    return f"({rest} = '' OR ({bad} <= 2 AND ({bad}) / length({rest}) < 0.15))"


def overlap_changes(clips: DataFrame, spans: DataFrame, ref_blocks: DataFrame) -> DataFrame:
    """Pairs of clips that spell a change, with its position and allele, before clips are given away.

    ``clips``: (region_id, side, pos, consensus, cnt, ...); ``spans``: (region_id, chr, region_start,
    region_end, contig_len, max_rlen). Right of the left clip's position, bases may be lost
    (p5 > p3) or repeated (p5 <= p3); what the clips hold beyond the change has to be the reference.
    """
    c = clips.where(F.length("consensus") > MIN_CLIP)
    found = clip_overlaps(clip_pair_join(c, spans)).join(spans.drop("max_rlen"), "region_id")
    found = found.withColumn("ins", F.expr("concat(substr(seq3, 1, length(seq3) - bp3 + 1), reverse(substr(seq5, 1, bp5)))"))
    found = found.where(~low_complexity("ins"))
    lo = F.greatest(F.lit(1), F.least("p5", "p3") - F.length("seq5") - 2)
    hi = F.greatest(lo, F.greatest("p5", "p3") + F.length("seq3") + 2)
    found = with_reference(found.withColumns({"_lo": lo, "_hi": hi}), ref_blocks)

    def ref(first: str, last: str) -> str:
        start = f"greatest({first}, wstart)"
        return f"replace(substr(wseq, cast({start} - wstart + 1 AS int), cast(greatest({last} - {start} + 1, 0) AS int)), '.', '')"

    found = found.selectExpr(
        "*",
        "substr(seq3, length(ins) + 1) AS rest3", "substr(seq5, length(ins) + 1) AS rest5",
        f"{ref('p5', 'p5 + length(seq3) - length(ins) + 2')} AS ref3",
        f"reverse({ref('p3 - length(seq5) + length(ins) - 2', 'p3 - 1')}) AS ref5",
        f"CASE WHEN p5 > p3 THEN '' WHEN length(ins) > p3 - p5 THEN {ref('p5', 'p3')} ELSE {ref('p5', 'p5 + (p3 - p5 - length(ins)) div 2')} END AS again",
    )
    found = found.where(F.expr(f"{_beside('rest3', 'ref3')} AND {_beside('rest5', 'ref5')}"))
    longer = "length(ins) > p5 - p3"
    allele = (f"CASE WHEN p5 <= p3 THEN concat('+', again, ins) WHEN {longer} THEN concat('+', substr(ins, 1, cast(length(ins) - (p5 - p3) AS int)), "
              "'&', right(ins, cast(p5 - p3 AS int))) ELSE concat('-', p5 - p3, '^', ins) END")
    found = found.selectExpr(
        "*", f"{allele} AS allele", f"p5 <= p3 OR {longer} AS is_ins",
        f"cast(CASE WHEN p5 <= p3 THEN p5 - 1 WHEN {longer} THEN p3 - 1 ELSE p3 END AS bigint) AS pos")
    base = ref("pos", "pos")
    return found.selectExpr("region_id", *_REGION, "p5", "p3", "seq5", "seq3", "bp5", "bp3", "score", "pos", "allele", "is_ins", f"{base} AS ref_base")


# one stretch: a pair comes about when neither clip has been used by an earlier one
_CLAIM = """
aggregate(wanted, named_struct('u5', cast(array() AS array<bigint>), 'u3', cast(array() AS array<bigint>), 'won', cast(array() AS array<struct<p5: bigint, p3: bigint>>)),
  (a, e) -> CASE WHEN array_contains(a.u5, e.p5) OR array_contains(a.u3, e.p3) THEN a
    ELSE named_struct('u5', array_append(a.u5, e.p5), 'u3', array_append(a.u3, e.p3), 'won', array_append(a.won, named_struct('p5', e.p5, 'p3', e.p3))) END,
  a -> a.won)
"""


def settle_pairs(changes: DataFrame, clips: DataFrame) -> DataFrame:
    """The pairs that come about when each clip serves once: 5' clips by reads, then position, each with its first 3' clip by the same order.

    Pairs can want the same clip only where their spans overlap, so each stretch of
    overlapping spans of a region is settled by one fold over its pairs.
    """
    n = clips.select("region_id", "side", "pos", "cnt")
    five = n.where("side = 5").select("region_id", F.col("pos").alias("p5"), F.col("cnt").alias("cnt5"))
    three = n.where("side = 3").select("region_id", F.col("pos").alias("p3"), F.col("cnt").alias("cnt3"))
    c = changes.join(five, ["region_id", "p5"]).join(three, ["region_id", "p3"])
    c = c.withColumns({"_a": F.least("p5", "p3"), "_b": F.greatest("p5", "p3")})
    w = Window.partitionBy("region_id").orderBy("_a", "p5", "p3")
    c = c.withColumn("_new", F.when(F.col("_a") > F.max("_b").over(w.rowsBetween(Window.unboundedPreceding, -1)), 1).otherwise(0))
    c = c.withColumn("stretch", F.sum("_new").over(w))
    turn = F.struct((-F.col("cnt5")).alias("n5"), "p5", (-F.col("cnt3")).alias("n3"), "p3")
    won = c.groupBy("region_id", "stretch").agg(F.array_sort(F.collect_list(turn)).alias("wanted"))
    won = won.select("region_id", F.expr(f"inline({_CLAIM})"))
    return c.drop("stretch", "_new", "_a", "_b").join(won, ["region_id", "p5", "p3"], "left_semi")


def overlap_insertions(clips: DataFrame, spans: DataFrame, ref_blocks: DataFrame) -> DataFrame:
    """H7: changes spelled by two clips, one row per pair that comes about.

    ``clips`` is read several times, so it should be a stored table; spans and the pairs that spell a change are stored here.
    """
    ensure_checkpoint_dir(clips.sparkSession)
    spans = stored(spans, "spans")  # comes from all reads and is joined twice
    return settle_pairs(overlap_changes(clips, spans, ref_blocks).checkpoint(), clips)


def clip_overlap_adjust(alleles: DataFrame, found: DataFrame, clips: DataFrame) -> DataFrame:
    """H7 on the pileup's rows: both clips' counts join the change, the left clip's leave the reference allele.

    The change's position gains the right clips' reads as depth. A change that no read
    shows whole gets a row of its own; what is taken never makes a count negative.
    """
    counts = clips.select("region_id", "side", F.col("pos").alias("clip_pos"), *COUNTS)
    ends = found.select("region_id", "pos", "allele", "is_ins", "ref_base", F.explode(F.array(
        F.struct(F.lit(5).alias("side"), F.col("p5").alias("clip_pos")), F.struct(F.lit(3).alias("side"), F.col("p3").alias("clip_pos")))).alias("e"))
    ends = ends.select("*", "e.side", "e.clip_pos").drop("e").join(counts, ["region_id", "side", "clip_pos"])
    depth = F.when(F.col("side") == 5, F.col("cnt")).otherwise(F.lit(0)).cast("long")
    gains = ends.select(*KEY, "is_ins", *COUNTS, F.col("cnt").cast("long").alias("extracnt"), depth.alias("cov_add"), F.lit(1).alias("sign"))
    lost = ends.where((F.col("side") == 3) & (F.col("ref_base") != ""))
    losses = lost.select("region_id", "pos", F.col("ref_base").alias("allele"), F.lit(False).alias("is_ins"), *[(-F.col(c)).alias(c) for c in COUNTS],
                         F.lit(0).cast("long").alias("extracnt"), F.lit(0).cast("long").alias("cov_add"), F.lit(-1).alias("sign"))
    new = found.select("region_id", *_REGION, *KEY[1:], "is_ins").distinct().join(alleles.select(*KEY, "is_ins"), [*KEY, "is_ins"], "left_anti")
    made = {f.name: f for f in alleles.schema.fields}
    rest = [F.lit(False if t.dataType.simpleString() == "boolean" else 0).cast(t.dataType).alias(c) for c, t in made.items() if c not in new.columns]
    new = new.select("*", *rest).select(*[F.col(c).cast(made[c].dataType).alias(c) for c in alleles.columns])
    return transfer_counts(alleles.unionByName(new), gains.unionByName(losses))

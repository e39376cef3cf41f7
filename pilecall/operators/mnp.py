"""MNP adjustment on aggregated rows (E17 with C8, C9 and the count transfer E16).

A read that ends inside a multi-base change shows only a part of it, and an
aligner may clip the read there instead. Both are evidence of the whole change:
fragments (the change's first or last bases as alleles of their own) and clips
whose consensus begins or ends with the change hand their counts to it.

Every join here is between aggregated rows: alleles of a position, clips of a
position, reference tiles. Order decides who gets a fragment that several
changes want: by position, then allele, inside one change by split point. Only
changes whose spans overlap can want the same fragment, so each stretch of
overlapping spans is settled by one fold over its candidate transfers.

Edge cases: no MNP, no clips or empty tables leave the alleles as they are; a
fragment without a positive count is never taken; bases beyond the known
reference count as mismatches of a clip's rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pilecall.operators.joins import with_reference

KEY = ["region_id", "pos", "allele"]
COUNTS = ["cnt", "fwd", "rev", "tp_sum", "q_sum", "mq_sum", "nm_sum", "hicnt", "locnt"]
_FLOORED = [c for c in COUNTS if c != "nm_sum"]


def _signed(df: DataFrame, pos: str, allele: str, src: str, sign: int, cov) -> DataFrame:
    """Move rows: the counts of ``src`` (a column prefix) given to or taken from an allele."""
    counts = [(F.lit(sign) * F.col(src + c)).alias(c) for c in COUNTS]
    extra = F.col(src + "cnt") if sign > 0 else F.lit(0)
    return df.select("region_id", F.col(pos).alias("pos"), F.col(allele).alias("allele"), *counts,
                     extra.cast("long").alias("extracnt"), cov.cast("long").alias("cov_add"), F.lit(sign).alias("sign"))


def transfer_counts(alleles: DataFrame, moves: DataFrame) -> DataFrame:
    """Alleles with the signed count rows of ``moves`` added.

    What an allele receives also counts as ``extracnt`` and makes its positions and
    qualities vary (``pstd``, ``qstd``); what is taken from one never makes a sum
    negative. Rows of ``moves`` without an allele to go to are left out; without a column
    ``is_ins`` they go to alleles that aren't insertions.
    """
    if "is_ins" not in moves.columns:
        moves = moves.withColumn("is_ins", F.lit(False))
    sums = moves.groupBy(*KEY, "is_ins").agg(
        *[F.sum(c).alias("_" + c) for c in [*COUNTS, "extracnt", "cov_add"]],
        (F.min("sign") < 0).alias("_less"), (F.max("sign") > 0).alias("_more"))
    out = alleles.join(sums, [*KEY, "is_ins"], "left")
    cols = {}
    for c in [*COUNTS, "cov_add"]:
        total = F.col(c) + F.coalesce(F.col("_" + c), F.lit(0))
        if c in _FLOORED:
            total = F.when(F.col("_less"), F.greatest(total, F.lit(0))).otherwise(total)
        cols[c] = total.cast(alleles.schema[c].dataType)
    had = F.col("extracnt") if "extracnt" in alleles.columns else F.lit(0).cast("long")
    cols["extracnt"] = had + F.coalesce(F.col("_extracnt"), F.lit(0).cast("long"))
    for c in ("pstd", "qstd"):
        cols[c] = F.when(F.col("_more"), F.lit(True)).otherwise(F.col(c))
    return out.withColumns(cols).select(*alleles.columns, *([] if "extracnt" in alleles.columns else ["extracnt"]))


def multi_base_changes(alleles: DataFrame) -> DataFrame:
    """The MNPs among the alleles, with their bases as ``mnt`` and their last position ``stop``."""
    m = alleles.where(~F.col("is_ins") & F.col("allele").rlike("^[ACGT]&[ACGT]+$"))
    m = m.withColumn("mnt", F.expr("replace(allele, '&', '')"))
    return m.select("region_id", "chr", "pos", "allele", "cnt", "mnt", (F.col("pos") + F.length("mnt") - 1).alias("stop"))


def fragment_candidates(mnps: DataFrame, alleles: DataFrame) -> DataFrame:
    """(MNP, split point) with the alleles that hold its bases before or after that point.

    Kept are fragments seen near read ends only: their mean position is at most the
    number of bases that a read cut there would still show.
    """
    n = F.length("mnt")
    split = mnps.withColumn("at", F.explode(F.sequence(F.lit(1), n - 1)))
    left = split.select("*", F.col("pos").alias("f_pos"), F.expr("substr(mnt, 1, at)").alias("f_allele"),
                        F.col("at").alias("reach"), (2 * F.col("at")).alias("step"), F.lit(False).alias("after"))
    right = split.select("*", (F.col("pos") + F.col("at")).alias("f_pos"), F.expr("substr(mnt, at + 1)").alias("f_allele"),
                         (n - F.col("at")).alias("reach"), (2 * F.col("at") + 1).alias("step"), F.lit(True).alias("after"))
    frags = alleles.where(~F.col("is_ins") & (F.col("cnt") > 0)).select(
        "region_id", F.col("pos").alias("f_pos"), F.col("allele").alias("f_allele"), *[F.col(c).alias("f_" + c) for c in COUNTS])
    found = left.unionByName(right).join(frags, ["region_id", "f_pos", "f_allele"])
    return found.where(F.floor(F.col("f_tp_sum") / F.col("f_cnt")) <= F.col("reach"))


_SETTLE = """
aggregate(
  wanted,
  named_struct('pos', -1L, 'allele', '', 'cnt', 0L, 'taken', cast(array() AS array<struct<pos:bigint,allele:string>>),
               'won', cast(array() AS array<struct<pos:bigint,allele:string,step:int>>)),
  (a, e) -> CASE
    WHEN NOT array_contains(a.taken, named_struct('pos', e.f_pos, 'allele', e.f_allele))
         AND e.f_cnt < IF(a.pos = e.pos AND a.allele = e.allele, a.cnt, e.cnt)
    THEN named_struct('pos', e.pos, 'allele', e.allele, 'cnt', IF(a.pos = e.pos AND a.allele = e.allele, a.cnt, e.cnt) + e.f_cnt,
                      'taken', array_append(filter(a.taken, t -> t.pos >= e.pos), named_struct('pos', e.f_pos, 'allele', e.f_allele)),
                      'won', array_append(a.won, named_struct('pos', e.pos, 'allele', e.allele, 'step', e.step)))
    ELSE named_struct('pos', e.pos, 'allele', e.allele, 'cnt', IF(a.pos = e.pos AND a.allele = e.allele, a.cnt, e.cnt),
                      'taken', a.taken, 'won', a.won) END,
  a -> a.won)
"""


def settle_fragments(candidates: DataFrame) -> DataFrame:
    """The candidates that come about, when transfers are made in order (position, allele, split point).

    A fragment goes to the first change that has more reads than it, counting what the
    change has received before. One group holds the candidates of a stretch of
    overlapping changes inside a region.
    """
    w = Window.partitionBy("region_id").orderBy("pos", "allele", "step")
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    c = candidates.withColumn("_new", F.when(F.col("pos") > reach, 1).otherwise(0))
    c = c.withColumn("stretch", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_new")
    event = F.struct("pos", "allele", "step", "cnt", "f_pos", "f_allele", "f_cnt")
    won = c.groupBy("region_id", "stretch").agg(F.array_sort(F.collect_list(event)).alias("wanted"))
    won = won.select("region_id", F.expr(f"inline({_SETTLE})"))
    return c.drop("stretch").join(won, ["region_id", "pos", "allele", "step"], "left_semi")


def clip_candidates(mnps: DataFrame, clips: DataFrame, ref_blocks: DataFrame) -> DataFrame:
    """The clips that show an MNP, each with the first MNP (position, allele) that it fits.

    ``clips``: (region_id, side, pos, consensus, COUNTS). A clip on the right side of
    its read starts at the change and begins with its bases; one on the left ends where
    the change ends. The rest has to match the reference beside the change with at
    most three mismatches and under 15 percent of its bases.
    """
    m = mnps.select("region_id", "chr", "pos", "allele", "mnt", F.explode(F.array(
        F.struct(F.lit(3).alias("side"), F.col("pos").alias("clip_pos")),
        F.struct(F.lit(5).alias("side"), (F.col("stop") + 1).alias("clip_pos")))).alias("_at"))
    m = m.select("*", "_at.side", "_at.clip_pos").drop("_at")
    c = clips.where(F.col("consensus") != "").withColumnRenamed("pos", "clip_pos")
    j = m.join(c, ["region_id", "side", "clip_pos"])
    n, k = F.length("consensus"), F.length("mnt")
    fits = F.when(F.col("side") == 3, F.col("consensus").startswith(F.col("mnt"))).otherwise(F.reverse("consensus").endswith(F.col("mnt")))
    j = j.where((n >= k) & fits).withColumn("rest", F.expr("substr(CASE WHEN side = 3 THEN consensus ELSE reverse(consensus) END, "
                                                           "CASE WHEN side = 3 THEN length(mnt) + 1 ELSE 1 END, length(consensus) - length(mnt))"))
    first = F.when(F.col("side") == 3, F.col("pos") + k).otherwise(F.col("pos") - F.length("rest"))
    j = j.withColumn("rest_start", first)
    j = with_reference(j.withColumns({"_lo": F.greatest(first, F.lit(1)), "_hi": F.greatest(first + F.length("rest") - 1, F.lit(1))}), ref_blocks)
    same = ("size(filter(sequence(1, length(rest)), i -> rest_start + i - 1 >= wstart "
            "AND substr(rest, i, 1) = substr(wseq, cast(rest_start + i - wstart AS int), 1)))")
    j = j.withColumn("_mm", F.when(F.col("rest") == "", F.lit(0)).otherwise(F.length("rest") - F.expr(same)))
    j = j.where((F.col("rest") == "") | ((F.col("_mm") <= 3) & (F.col("_mm") / F.length("rest") < 0.15)))
    w = Window.partitionBy("region_id", "side", "clip_pos").orderBy("pos", "allele")
    return j.withColumn("_nr", F.row_number().over(w)).where("_nr = 1").drop("_nr", "_mm", "wseq", "wstart", "rest", "rest_start")


def mnp_adjust(alleles: DataFrame, clips: DataFrame, ref_blocks: DataFrame) -> DataFrame:
    """Alleles (pileup rows) after fragments and clips have joined their MNPs; adds ``extracnt``.

    A fragment that is taken leaves the table but for its depth, which stays at its
    position as a coverage row (allele ''). Depth is added at the change for fragments
    from behind its first base and for clips.
    """
    mnps = multi_base_changes(alleles)
    won = settle_fragments(fragment_candidates(mnps, alleles))
    cov = F.when(F.col("after"), F.col("f_cnt")).otherwise(F.lit(0))
    gains = _signed(won, "pos", "allele", "f_", 1, cov)
    losses = _signed(won, "f_pos", "f_allele", "f_", -1, F.lit(0))
    fits = clip_candidates(mnps, clips, ref_blocks)
    clipped = _signed(fits, "pos", "allele", "", 1, F.col("cnt"))
    out = transfer_counts(alleles, gains.unionByName(losses).unionByName(clipped))
    gone = won.select("region_id", F.col("f_pos").alias("pos"), F.col("f_allele").alias("allele"), F.lit(False).alias("is_ins"), F.lit(True).alias("_gone"))
    out = out.join(gone, [*KEY, "is_ins"], "left")
    return out.withColumn("allele", F.when(F.col("_gone"), F.lit("")).otherwise(F.col("allele"))).select(*alleles.columns, *([] if "extracnt" in alleles.columns else ["extracnt"]))

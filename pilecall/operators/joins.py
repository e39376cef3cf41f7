"""Range joins without cartesian products.

Interval overlap is an equi-join on ``(chr, bin)`` plus a residual predicate.
Both sides are exploded to the fixed-width bins they touch and a pair is kept
only in its first common bin, so no ``distinct`` is needed. Which side is
broadcast is left to AQE, which checks the real size at run time
(``spark.sql.autoBroadcastJoinThreshold``); beyond it the join is a
sort-merge join on ``(chr, bin)`` and AQE splits a hot bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pilecall.fixtures import BLOCK

DEFAULT_BIN = 1000


def _bins(lo: Column, hi: Column, width: int) -> Column:
    return F.sequence(F.floor(lo / width), F.floor(hi / width))


def region_read_overlap(
    regions: DataFrame,
    reads: DataFrame,
    *,
    inclusive: bool = False,
    bin_width: int = DEFAULT_BIN,
) -> DataFrame:
    """Reads overlapping a region; strict on both ends unless ``inclusive``.

    ``reads`` needs ``chr, start_pos, end_pos``; ``regions`` needs
    ``region_id, chr, region_start, region_end``. Output: all read columns plus
    the region columns (a read joins every region it overlaps).
    """
    rd = reads.withColumn("_rb", _bins(F.col("start_pos"), F.col("end_pos"), bin_width))
    rd = rd.withColumn("_bin", F.explode("_rb")).withColumn("_rb0", F.col("_rb")[0]).drop("_rb")
    rg = regions.withColumnRenamed("chr", "_rchr")
    rg = rg.withColumn("_gb", _bins(F.col("region_start"), F.col("region_end"), bin_width))
    rg = rg.withColumn("_gbin", F.explode("_gb")).withColumn("_gb0", F.col("_gb")[0]).drop("_gb")
    if inclusive:
        ov = (F.col("start_pos") <= F.col("region_end")) & (F.col("end_pos") >= F.col("region_start"))
    else:
        ov = (F.col("start_pos") < F.col("region_end")) & (F.col("end_pos") > F.col("region_start"))
    # a merge join on both sides' order: its rows come bin by bin, so what is summed per position downstream meets in one batch
    joined = rd.hint("merge").join(
        rg,
        (F.col("chr") == F.col("_rchr")) & (F.col("_bin") == F.col("_gbin")),
        "inner",
    ).where(ov & (F.col("_bin") == F.greatest(F.col("_rb0"), F.col("_gb0"))))
    return joined.drop("_bin", "_rb0", "_rchr", "_gbin", "_gb0")


def region_flank(regions: DataFrame, contigs: DataFrame | None = None, flank: int = 700) -> DataFrame:
    """``[start - flank, end + flank]``, clamped to [1, contig length] when known."""
    out = regions.withColumn("flank_start", F.greatest(F.lit(1), F.col("region_start") - flank))
    out = out.withColumn("flank_end", F.col("region_end") + flank)
    if contigs is not None:
        out = out.join(contigs.select("chr", F.col("length").alias("_len")), "chr", "left")
        out = out.withColumn("flank_end", F.least(F.col("flank_end"), F.coalesce(F.col("_len"), F.col("flank_end"))))
        out = out.drop("_len")
    return out


def region_ref_window(regions: DataFrame, ref_blocks: DataFrame, flank: int = 700) -> DataFrame:
    """Every reference base within ``flank`` of a region, as (region_id, chr, pos, base).

    Regions explode to the 32-base block ids they need; the join is an
    equi-join on ``(chr, block)``; bases are only exploded after the join.
    """
    rg = regions.select(
        "region_id", "chr",
        (F.col("region_start") - flank).alias("lo"),
        (F.col("region_end") + flank).alias("hi"),
    )
    rg = rg.withColumn(
        "block",
        F.explode(F.sequence(F.floor((F.greatest(F.col("lo"), F.lit(1)) - 1) / BLOCK),
                             F.floor((F.col("hi") - 1) / BLOCK))),
    )
    j = rg.join(ref_blocks, ["chr", "block"])
    j = j.withColumn("i", F.explode(F.sequence(F.lit(0), F.length("seq") - 1)))
    j = j.withColumn("pos", F.col("block_start") + F.col("i"))
    j = j.where((F.col("pos") >= F.col("lo")) & (F.col("pos") <= F.col("hi")))
    return j.select("region_id", "chr", "pos", F.substring("seq", F.col("i") + 1, 1).alias("base"))


TILE = 8 * BLOCK  # bases from one reference tile to the next; a tile's text is twice as long


def reference_tiles(ref_blocks: DataFrame, per: int = TILE // BLOCK) -> DataFrame:
    """The reference as overlapping texts: (chr, tile, wseq), twice ``per`` blocks from block ``tile * per`` on.

    Any stretch of up to ``per`` blocks of bases lies inside the tile of its first base, so
    looking one up is a single equi-join, without regrouping. Unknown bases read '.'.
    """
    home = F.floor(F.col("block") / per)
    b = ref_blocks.select("chr", "block", "seq", F.explode(F.array(home, home - 1)).alias("tile")).where("tile >= 0")
    at = F.col("block") - F.col("tile") * per
    parts = [F.coalesce(F.max(F.when(at == k, F.col("seq"))), F.lit("." * BLOCK)) for k in range(2 * per)]
    return b.groupBy("chr", "tile").agg(F.concat(*parts).alias("wseq"))


def with_reference(df: DataFrame, ref_blocks: DataFrame, per: int = TILE // BLOCK) -> DataFrame:
    """C4: the reference around ``_lo`` .. ``_hi`` of each row, as ``wseq`` from position ``wstart`` on.

    A stretch of up to ``per`` blocks joins the tile of its first base; a longer one (long
    reads) joins exactly the blocks that it touches, put together once per range.
    """
    width = per * BLOCK
    long = F.col("_hi") - F.col("_lo") >= width
    short = df.where(~long).withColumn("tile", F.floor((F.col("_lo") - 1) / width))
    out = short.join(reference_tiles(ref_blocks, per), ["chr", "tile"], "left").withColumn("wstart", F.col("tile") * width + 1).drop("tile")
    far = df.where(long)
    if not far.isEmpty():
        far = far.withColumns({"wblock": F.floor((F.col("_lo") - 1) / BLOCK), "wlast": F.floor((F.col("_hi") - 1) / BLOCK)})
        win = needed_windows(far.select("chr", "wblock", "wlast").distinct(), ref_blocks)
        far = far.join(win, ["chr", "wblock", "wlast"], "left").withColumn("wstart", F.col("wblock") * BLOCK + 1)
        out = out.unionByName(far.drop("wblock", "wlast"))
    return out.withColumn("wseq", F.coalesce("wseq", F.lit(""))).drop("_lo", "_hi")


def needed_windows(keys: DataFrame, ref_blocks: DataFrame) -> DataFrame:
    """Reference text of the block ranges in ``keys`` (chr, wblock, wlast), as wseq, for stretches over ``TILE`` bases.

    Only the blocks that some key names are read; a group holds the blocks of one range.
    Missing blocks become '.' so string offsets equal genome offsets.
    """
    k = keys.withColumn("block", F.explode(F.sequence("wblock", "wlast")))
    j = k.join(ref_blocks.select("chr", "block", "seq"), ["chr", "block"], "left")
    text = F.expr(f"listagg(coalesce(seq, repeat('.', {BLOCK})), '') WITHIN GROUP (ORDER BY block)")
    return j.groupBy("chr", "wblock", "wlast").agg(text.alias("wseq"))


def ref_char(wseq: Column, wstart: Column, pos: Column) -> Column:
    """Reference base at ``pos`` from a window; '' when unknown."""
    ch = F.substring(wseq, (pos - wstart + 1).cast("int"), 1)
    return F.when((pos >= wstart) & (ch != ".") , ch).otherwise(F.lit(""))


def ref_context(
    keys: DataFrame, ref_blocks: DataFrame, lo: str, hi: str, key_cols: list[str]
) -> DataFrame:
    """Reference text for ``[lo, hi]`` per key row (C4 for call-level lookups).

    Returns ``key_cols + [ctx_start, ctx]`` where ``ctx`` holds positions
    ``ctx_start..`` with '.' for unknown bases. The group per key is bounded by
    ``(hi - lo) / 32 + 2`` blocks.
    """
    k = keys.select(*key_cols, "chr", F.col(lo).alias("_lo"), F.col(hi).alias("_hi"))
    k = k.withColumn("_b0", F.floor((F.greatest(F.col("_lo"), F.lit(1)) - 1) / BLOCK))
    k = k.withColumn("block", F.explode(F.sequence(F.col("_b0"), F.floor((F.col("_hi") - 1) / BLOCK))))
    j = k.join(ref_blocks.select("chr", "block", "seq"), ["chr", "block"], "left")
    g = j.groupBy(*key_cols, "_b0").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("block") - F.col("_b0"), F.col("seq")))).alias("m"),
        F.max(F.col("block") - F.col("_b0")).alias("nb"),
    )
    ctx = F.expr(f"array_join(transform(sequence(0, nb), j -> coalesce(m[j], repeat('.', {BLOCK}))), '')")
    return g.select(*key_cols, (F.col("_b0") * BLOCK + 1).alias("ctx_start"), ctx.alias("ctx"))


def ref_range(ctx: Column, ctx_start: Column, a: Column, b: Column) -> Column:
    """joinRef: known bases of positions a..b (unknown ones skipped)."""
    start = F.greatest(a, ctx_start)
    raw = F.when(b >= start, F.substring(ctx, (start - ctx_start + 1).cast("int"), (b - start + 1).cast("int"))).otherwise(F.lit(""))
    return F.replace(raw, F.lit("."), F.lit(""))


def splice_antijoin(calls: DataFrame, splices: DataFrame) -> DataFrame:
    """Drop deletions whose ``sp-ep`` equals an observed splice junction (one left join)."""
    sp = splices.select("region_id", F.col("junction").alias("_junction")).distinct().withColumn("_hit", F.lit(True))
    keyed = calls.withColumn("_junction", F.concat_ws("-", F.col("sp").cast("string"), F.col("ep").cast("string")))
    out = keyed.join(sp, ["region_id", "_junction"], "left")
    out = out.where(~((F.col("vartype") == "Deletion") & F.coalesce(F.col("_hit"), F.lit(False))))
    return out.drop("_junction", "_hit")


def position_amplicons(positions: DataFrame, amplicons: DataFrame, bin_width: int = DEFAULT_BIN) -> DataFrame:
    """Which amplicons cover each position by their inner (primer-free) span.

    ``positions``: (chr, pos, ...); ``amplicons``: (amplicon_id, chr, istart, iend).
    The same binned equi-join as the read overlap, inclusive on both ends.
    """
    pts = positions.withColumn("start_pos", F.col("pos")).withColumn("end_pos", F.col("pos"))
    amp = amplicons.select(F.col("amplicon_id").alias("region_id"), "chr",
                           F.col("istart").alias("region_start"), F.col("iend").alias("region_end"))
    j = region_read_overlap(amp, pts, inclusive=True, bin_width=bin_width)
    return j.withColumnRenamed("region_id", "amplicon_id").drop("start_pos", "end_pos", "region_start", "region_end")

"""Soft-clip collection and consensus.

Only reads with a soft clip at either end take part; each clipped op is
joined to one reference window (for the rescue length, E12), the clip walk
goes over the clip's own bases in columns, and the per-position tables are plain
aggregations. The consensus keeps a bounded list per clip position (at most
one entry per clip index, i.e. at most a read length).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pilecall.functions.exprs import computed_once
from pilecall.operators.pileup import AT_ONCE, RESCUED_3, RESCUED_5, attach_windows, clip_texts, flat, in_slices, is_clip, is_whole_clip, key_code, letter_codes, read_ops, rescued_bases
from pilecall.params import CallParams
from pilecall.session import shared_scratch, stored


# read index of walk step t: 5' walks leftwards from the clip end, 3' rightwards
_STEP = "CASE WHEN side = 5 THEN base0 - t ELSE base0 + t END"


def _walks(side, len, contig_len, _from, _ref, _under, _bases, _quals):
    """Of each clip how many bases are rescued (E12), and how far the walk over the others goes."""
    clips = pa.RecordBatch.from_arrays([side, len, contig_len, _from, _ref, _under, _bases, _quals],
                                       ["side", "len", "contig_len", "_from", "_ref", "_under", "_bases", "_quals"])
    row, t, base, q, _, rescued = rescued_bases(clips)
    n = len.to_numpy(zero_copy_only=False)
    first = np.cumsum(n) - n  # each clip's first base
    walked = t >= rescued[row]
    unknown = walked & (base == ord("N"))
    low = walked & ~unknown & (q <= 12)
    lows = np.cumsum(low) - (np.concatenate([[0], np.cumsum(low)])[first])[row]
    ends = np.flatnonzero(unknown | (low & (lows == 2)))
    stop = n.copy()  # where the walk ends: at an unknown base or a second base of low quality
    np.minimum.at(stop, row[ends], t[ends])
    counted = np.bincount(row[low & (t <= stop[row])], minlength=clips.num_rows)
    walk = [pa.array(stop < n), pa.array(counted, pa.int32()), pa.array(stop - rescued, pa.int32())]
    return pa.StructArray.from_arrays([pa.array(rescued, pa.int32()), pa.StructArray.from_arrays(walk, ["stop", "low", "qn"])], ["rescued", "w"])


def _sliced_walks(*columns):
    """``_walks``, some bases at once."""
    ends, at, parts = np.cumsum(columns[1].to_numpy(zero_copy_only=False)), 0, []
    while at < len(ends):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")))
        parts.append(_walks(*[c.slice(at, end - at) for c in columns]))
        at = end
    return pa.concat_arrays(parts) if parts else _walks(*columns)


def kept_clips(region_reads: DataFrame, ref_blocks: DataFrame, p: CallParams) -> DataFrame:
    """E11 per read: one row per clip that is kept, with its side, position, length ``m`` and walk ``w``.

    Clips whose texts have one byte a base are walked in columns, the others letter by letter.
    """
    if "cigar" in region_reads.columns:
        region_reads = region_reads.where(F.col("cigar").rlike("[SI]"))  # on a stored column: other reads are neither parsed nor joined
    ops = read_ops(region_reads).where(is_clip(5) | is_clip(3)).withColumn("_odd", ~is_whole_clip())
    # written once: the reference lookup looks for long stretches first
    s = clip_texts(attach_windows(stored(ops.drop("prev_op", "first_op", "rofs", "op"), "clip_ops").withColumn("op", F.lit("S")), ref_blocks))
    even = [F.when(~F.col("_odd"), F.col(c)).otherwise(F.lit("")) for c in ("_under", "_bases", "_quals")]
    u = F.arrow_udf(_sliced_walks, "struct<rescued: int, w: struct<stop: boolean, low: int, qn: int>>")(
        "side", F.when(F.col("_odd"), 0).otherwise(F.col("len")), "contig_len", F.col("_from").cast("long"), F.col("_ref").cast("long"), *even)
    s = computed_once(s, _u=u).drop("_under", "_bases", "_quals", "_from", "_ref")
    ap = F.when(F.col("side") == 5, F.expr(f"array_position(transform(sequence(0, len - 1), t -> {RESCUED_5}), false)")).otherwise(
        F.expr(f"array_position(transform(sequence(0, len - 1), t -> {RESCUED_3}), false)"))
    s = computed_once(s, rescued=F.when(~F.col("_odd"), F.col("_u.rescued")).otherwise(F.when(ap == 0, F.col("len")).otherwise(ap - 1)))
    s = s.withColumn("m", F.col("len") - F.col("rescued")).where(F.col("m") > 0)
    s = s.withColumn("pos", F.when(F.col("side") == 5, F.col("start_pos") - F.col("rescued")).otherwise(F.col("seg_start") + F.col("rescued")))
    s = s.withColumn("base0", F.when(F.col("side") == 5, F.col("m") - 1).otherwise(F.col("qofs") + F.col("rescued")))
    si = _STEP
    walk = (
        "aggregate(sequence(0, m - 1), named_struct('stop', false, 'low', 0, 'qn', 0), (a, t) -> CASE "
        f"WHEN a.stop THEN a "
        f"WHEN substr(seq, ({si}) + 1, 1) = 'N' THEN named_struct('stop', true, 'low', a.low, 'qn', a.qn) "
        f"WHEN ascii(substr(seq_qual, ({si}) + 1, 1)) - 33 <= 12 AND a.low >= 1 THEN named_struct('stop', true, 'low', a.low + 1, 'qn', a.qn) "
        f"WHEN ascii(substr(seq_qual, ({si}) + 1, 1)) - 33 <= 12 THEN named_struct('stop', false, 'low', a.low + 1, 'qn', a.qn + 1) "
        "ELSE named_struct('stop', false, 'low', a.low, 'qn', a.qn + 1) END)"
    )
    s = s.where((F.col("pos") >= F.col("region_start") - p.buffer) & (F.col("pos") <= F.col("region_end") + p.buffer))
    s = computed_once(s, w=F.when(~F.col("_odd"), F.col("_u.w")).otherwise(F.expr(walk))).drop("_u", "_odd")
    return s.where((F.col("w.qn") >= 1) & (F.col("w.qn") > F.col("w.low")))


def clip_bases(region_reads: DataFrame, ref_blocks: DataFrame, p: CallParams) -> DataFrame:
    """E11 per read: the clipped bases kept by the walk, as (region, side, pos, idx, base, cnt, q_sum); see ``kept_bases``."""
    return kept_bases(kept_clips(region_reads, ref_blocks, p))


_CLIP = ["region_id", "side", "pos"]


def _base_sums(clips: pa.RecordBatch) -> pa.RecordBatch:
    """One batch of kept clips as sums over their equal bases."""
    n, side, base0 = (clips.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "side", "base0"))
    row, t = flat(n)
    at = base0[row] + np.where(side[row] == 5, -t, t)
    letters = []
    for c in ("seq", "seq_qual"):
        codes, starts = letter_codes(clips, c)
        there = at < (starts[1:] - starts[:-1])[row]  # a text may end before its clip does: no letter, which counts as 0
        codes = codes if len(codes) else np.zeros(1, np.uint8)
        letters.append(np.where(there, codes[np.where(there, starts[row] + at, 0)], 0).astype(np.int64))
    for x, c in zip(letters, ("seq", "seq_qual")):
        x[~clips.column(c).is_valid().to_numpy(zero_copy_only=False)[row]] = -1
    base, q = letters
    names, base = np.unique(base, return_inverse=True)
    unknown = q < 0
    code, width = key_code(clips, _CLIP), int(t.max()) + 1
    key = (code[row] * width + t) * len(names) + base
    _, some, key = np.unique(key, return_index=True, return_inverse=True)
    total = np.bincount(key, weights=np.where(unknown, 0, q - 33), minlength=len(some)).astype(np.int64)
    known = np.bincount(key[~unknown], minlength=len(some)) > 0
    texts = pa.array([None if x < 0 else chr(x) if x else "" for x in names.tolist()], pa.string())
    head = clips.select(_CLIP).take(pa.array(row[some]))
    return pa.RecordBatch.from_arrays([*head.columns, pa.array(t[some], pa.int32()), texts.take(pa.array(base[some])), pa.array(np.bincount(key), pa.int64()),
                                       pa.array(total, pa.int64(), mask=~known)], [*_CLIP, "cidx", "base", "cnt", "q_sum"])


def kept_bases(kept: DataFrame) -> DataFrame:
    """The bases of kept clips, by their place in the walk: equal ones of a position are summed batch by batch, in columns (count and quality sum)."""
    s = kept.select("region_id", "side", F.col("pos").cast("long").alias("pos"), F.col("base0").cast("long").alias("base0"), F.col("w.qn").alias("n"), "seq", "seq_qual")
    kinds = {f.name: f.dataType.simpleString() for f in s.schema.fields}
    schema = f"region_id {kinds['region_id']}, side int, pos long, cidx int, base string, cnt long, q_sum long"
    return s.mapInArrow(in_slices(lambda batch: [_base_sums(batch)], lambda b: b.column("n").to_numpy()), schema)


def clip_evidence(region_reads: DataFrame, ref_blocks: DataFrame, p: CallParams) -> DataFrame:
    """Per clip position its consensus (E13) and its accumulators; the kept clips are written once and read for both."""
    kept = kept_clips(region_reads.where(F.col("cigar").contains("S")), ref_blocks, p)
    path = shared_scratch(kept.sparkSession, "clips")
    kept.select("region_id", "side", "pos", "m", "base0", "w", "mapq", "tnm", "dir", "seq", "seq_qual").write.option("compression", "zstd").parquet(path)
    kept = kept.sparkSession.read.parquet(path)
    consensus = softclip_consensus(softclip_table(kept_bases(kept))).select("region_id", "side", "pos", "consensus")
    return consensus.join(clip_counts(kept, p), ["region_id", "side", "pos"])


def softclip_table(clips: DataFrame) -> DataFrame:
    """E11 aggregate: per (region, side, clip position, index, base) count and quality sum.

    The bases, already summed batch by batch, meet by their clip position: the consensus needs no further shuffle.
    """
    return clips.repartition(*_CLIP).groupBy(*_CLIP, "cidx", "base").agg(F.sum("cnt").alias("cnt"), F.sum("q_sum").alias("q_sum"))


def clip_counts(kept: DataFrame, p: CallParams) -> DataFrame:
    """E11 accumulators of a clip position, as an allele has them: each clip counts once, with its mean base quality."""
    q = F.expr(f"aggregate(transform(sequence(0, w.qn - 1), t -> ascii(substr(seq_qual, ({_STEP}) + 1, 1)) - 33), 0D, (a, x) -> a + x) / w.qn")
    k = kept.select("region_id", "side", F.col("pos").cast("long").alias("pos"), "m", "mapq", "tnm", "dir", q.alias("q"))
    return k.groupBy("region_id", "side", "pos").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.count(F.when(~F.col("dir"), 1)).alias("fwd"), F.count(F.when(F.col("dir"), 1)).alias("rev"),
        F.sum("m").cast("long").alias("tp_sum"), F.sum("q").alias("q_sum"),
        F.sum("mapq").cast("long").alias("mq_sum"), F.sum("tnm").cast("long").alias("nm_sum"),
        F.count(F.when(F.col("q") >= p.goodq, 1)).alias("hicnt"), F.count(F.when(F.col("q") < p.goodq, 1)).alias("locnt"))


def softclip_consensus(table: DataFrame) -> DataFrame:
    """Per clip position, the highest-quality base per index, walked until the second weak index.

    A weak index has (total - max > 2 or max <= total - max) and max/total < 0.8.
    Accepted when matched/total > 0.9, length/1.5 > last index - length, and
    (length/last index > 0.8 or last index - length < 10 or length > 25).
    """
    key = ["region_id", "side", "pos"]
    wi = Window.partitionBy(*key, "cidx")
    t = table.withColumns({
        "tt": F.sum("cnt").over(wi),
        "_r": F.row_number().over(wi.orderBy(F.col("q_sum").desc(), F.col("base").asc())),
    }).where(F.col("_r") == 1).drop("_r")
    weak = ((F.col("tt") - F.col("cnt") > 2) | (F.col("cnt") <= F.col("tt") - F.col("cnt"))) & (F.col("cnt") / F.col("tt") < 0.8)
    wk = Window.partitionBy(*key).orderBy("cidx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("weak_run", F.sum(F.when(weak, 1).otherwise(0)).over(wk))
    t = t.withColumn("last_idx", F.max("cidx").over(Window.partitionBy(*key)))
    kept = t.where(F.col("weak_run") <= 1)
    g = kept.groupBy(*key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cidx", "base"))), lambda x: x["base"]), "").alias("seq"),
        F.sum("tt").alias("total"), F.sum("cnt").alias("match"), F.max("last_idx").alias("last_idx"),
    )
    n = F.length("seq")
    li = F.col("last_idx")
    ok = (F.col("total") != 0) & (F.col("match") / F.col("total") > 0.9) & (n / 1.5 > li - n) & (
        F.when(li == 0, F.lit(True)).otherwise(n / li > 0.8) | (li - n < 10) | (n > 25))
    return g.select(*key, F.when(ok, F.col("seq")).otherwise(F.lit("")).alias("consensus"), "total", "match")

"""Complex indels (E7, E8): an indel together with a close second one and close mismatches.

An indel op opens an event. The ops right behind it may belong to the same event:

* a match of at most ``vext`` bases and another indel: ``#match^second`` (E7), the second
  one as its bases or its length;
* an insertion right behind a deletion: ``^bases``;
* the first bases of the match that follows, up to the last mismatch that is reached
  without more than ``vext`` matching bases in a row: ``&bases`` (E8).

Which ops an event takes is found in columns over the op arrays of a batch; the events' ops join
the reference once, and the mismatch scan goes over the following matches of a batch at once. Each event is
one signed row of the pileup's event schema, so the same aggregation counts it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pilecall.functions.cigar import with_ops
from pilecall.functions.exprs import computed_once
from pilecall.operators.joins import with_reference
from pilecall.operators.pileup import _in_region, _Kinds, _REGION_KEYS, _tp, aggregate_events, flat, letter_codes
from pilecall.params import CallParams
from pilecall.session import stored


_EVENT = "kind: int, op: string, len: int, qofs: int, pofs: int, rofs: int, m1: int, m2: int, o2: string, more: int"


def _found(ops: pa.Array, vext: int) -> pa.Array:
    """The events of each read's ops in order: the opening op, what it takes and the match behind it.

    An event takes a short match and another indel behind it (``kind`` 2) or, being a deletion, an
    insertion right behind it (1); what one takes opens no other.
    """
    size = ops.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(size) - size
    fields = ops.flatten()
    op, raw = (fields.field(c).to_numpy(zero_copy_only=False).astype("U1") for c in ("op", "raw"))
    length = fields.field("len").to_numpy(zero_copy_only=False)
    row, place = flat(size)

    def behind(x: np.ndarray, k: int, none) -> np.ndarray:
        """``x`` of the op ``k`` places behind each one."""
        out = np.full(len(x), none, x.dtype)
        there = np.flatnonzero(place + k < size[row])
        out[there] = x[there + k]
        return out

    second = (behind(raw, 1, "") == "M") & (behind(length, 1, 0) <= vext) & np.isin(behind(raw, 2, ""), ["I", "D"])
    kind = np.where(second, 2, np.where((op == "D") & (behind(raw, 1, "") == "I"), 1, 0))
    indel, opened, free = np.isin(op, ["I", "D"]), np.zeros(len(op), bool), np.zeros(len(size), np.int64)
    for k in range(int(size.max(initial=0))):
        rows = np.flatnonzero(size > k)
        at = starts[rows] + k
        opens = indel[at] & (free[rows] <= k)
        opened[at[opens]] = True
        free[rows[opens]] = k + 1 + kind[at[opens]]
    e = np.flatnonzero(opened)
    then = kind[e] + 1  # the op behind the event
    there = place[e] + then < size[row[e]]
    follow = np.where(there, e + then, 0)
    more = np.where(there & (raw[follow] == "M"), length[follow], 0) if len(e) else np.zeros(0, np.int64)

    def ints(x: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
        return pa.array(x, pa.int32(), mask=missing)

    none = [place[e] + k >= size[row[e]] for k in (1, 2)]
    columns = [ints(kind[e]), pa.array(op[e].tolist(), pa.string()), *(fields.field(c).take(pa.array(e)) for c in ("len", "qofs", "pofs", "rofs")),
               ints(behind(length, 1, 0)[e], none[0]), ints(behind(length, 2, 0)[e], none[1]),
               pa.array([x or None for x in behind(raw, 2, "")[e].tolist()], pa.string()), ints(more)]
    ends = np.concatenate([[0], np.cumsum(np.bincount(row[e], minlength=len(size)))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, [x.split(":")[0] for x in _EVENT.split(", ")]))


def _extended(deletion: pa.Array, more: pa.Array, read: pa.Array, qual: pa.Array, under: pa.Array, goodq: float, vext: int) -> pa.StructArray:
    """E8 of each event: how many bases of the following match it takes (``off``), with how many mismatches (``nm``).

    The scan goes base by base over all events that are still in it; most end within the first bases.
    """
    n = more.to_numpy(zero_copy_only=False)
    deletion = deletion.to_numpy(zero_copy_only=False).astype(bool)
    run, off, nm = (np.zeros(len(n), np.int64) for _ in range(3))
    texts = [letter_codes(pa.RecordBatch.from_arrays([c], ["c"]), "c") for c in (read, qual, under)]

    def at(k: int, rows: np.ndarray, t: int) -> np.ndarray:
        codes, starts = texts[k]
        there = starts[rows] + t < starts[rows + 1]
        if not len(codes):
            return np.zeros(len(rows), np.int64)
        return np.where(there, codes[np.where(there, starts[rows] + t, 0)], 0).astype(np.int64)

    rows, t = np.flatnonzero(n > 0), 0
    while len(rows):
        base, q, ref = (at(k, rows, t) for k in range(3))
        on = (run[rows] <= vext) & (base != 0) & (base != ord("N")) & (q - 33 >= goodq) & ~(deletion[rows] & (ref == ord("N")))
        rows, base, ref = rows[on], base[on], ref[on]
        known = (ref != 0) & (ref != ord("."))
        differs = known & (base != ref)
        run[rows] = np.where(differs, 0, run[rows] + known)
        off[rows[differs]] = t + 1
        nm[rows[differs]] += 1
        t += 1
        rows = rows[n[rows] > t]
    return pa.StructArray.from_arrays([pa.array(off, pa.int32()), pa.array(nm, pa.int32())], ["off", "nm"])


def _mean_quality(quals: pa.Array) -> pa.Array:
    """The mean of each text's qualities; null for a missing or empty one."""
    codes, starts = letter_codes(pa.RecordBatch.from_arrays([quals], ["quals"]), "quals")
    total = np.concatenate([[0], np.cumsum(codes.astype(np.int64) - 33)])
    n = starts[1:] - starts[:-1]
    return pa.array((total[starts[1:]] - total[starts[:-1]]) / np.maximum(n, 1), pa.float64(), mask=n == 0)


def indel_events(region_reads: DataFrame, p: CallParams) -> DataFrame:
    """One row per event: the opening op, what it takes (``kind`` 2: E7, 1: joined insertion, 0: neither) and the match behind it."""
    if "cigar" in region_reads.columns:
        region_reads = region_reads.where(F.col("cigar").rlike("[ID]"))  # on a stored column: other reads are neither parsed nor joined
    base = with_ops(region_reads).select(
        *_REGION_KEYS[:4], F.coalesce(F.col("contig_len"), F.lit(2**62).cast("long")).alias("contig_len"),
        "start_pos", "mapq", "seq", F.col("qual").alias("seq_qual"), "tnm", "rlen1",
        (F.col("flag").bitwiseAND(F.lit(16)) != 0).alias("dir"), "ops",
    )
    vext = p.vext

    def events(ops: pa.Array) -> pa.Array:
        return _found(ops, vext)

    found = base.select("*", F.inline(F.arrow_udf(events, f"array<struct<{_EVENT}>>")("ops"))).drop("ops")
    # how far the event itself goes in the read and in the reference
    read = "CASE op WHEN 'I' THEN len ELSE 0 END + CASE kind WHEN 2 THEN m1 + CASE WHEN o2 = 'I' THEN m2 ELSE 0 END WHEN 1 THEN m1 ELSE 0 END"
    ref = "CASE op WHEN 'D' THEN len ELSE 0 END + CASE WHEN kind = 2 THEN m1 + CASE WHEN o2 = 'D' THEN m2 ELSE 0 END ELSE 0 END"
    return found.withColumns({"seg_start": F.col("start_pos") + F.col("rofs"), "read_on": F.expr(f"qofs + {read}"), "ref_on": F.expr(f"start_pos + rofs + {ref}")})


def complex_events(region_reads: DataFrame, ref_blocks: DataFrame, p: CallParams) -> DataFrame:
    """Signed event rows (the pileup's schema) of all indels, complex ones under their compound key.

    An insertion's mismatch bases add coverage of their own (rows without an allele).
    """
    # a deletion counts at its first base only; an insertion covers what it takes wherever that lies
    ev = indel_events(region_reads, p).where((F.col("op") == "I") | _in_region(F.col("seg_start")))
    # written once: the reference lookup looks for long stretches first
    ev = stored(ev, "indels")
    lo = F.greatest(F.lit(1), F.col("ref_on"))
    ev = with_reference(ev.withColumns({"_lo": lo, "_hi": F.greatest(lo, F.col("ref_on") + F.col("more") - 1)}), ref_blocks)
    read, ref = "substr(seq, read_on + t + 1, 1)", "substr(wseq, cast(ref_on + t - wstart + 1 AS int), 1)"
    stop = f"({read} IN ('N', '') OR ascii(substr(seq_qual, read_on + t + 1, 1)) - 33 < {p.goodq} OR (op = 'D' AND {ref} = 'N'))"
    step = (
        f"(a, t) -> CASE WHEN NOT a.on OR a.run > {p.vext} OR {stop} THEN named_struct('run', a.run, 'off', a.off, 'nm', a.nm, 'on', false) "
        f"WHEN {ref} IN ('.', '') THEN a "
        f"WHEN {read} <> {ref} THEN named_struct('run', 0, 'off', t + 1, 'nm', a.nm + 1, 'on', true) "
        "ELSE named_struct('run', a.run + 1, 'off', a.off, 'nm', a.nm, 'on', true) END"
    )
    scan = (f"aggregate(CASE WHEN more > 0 THEN sequence(0, more - 1) ELSE cast(array() AS array<int>) END, "
            f"named_struct('run', 0, 'off', 0, 'nm', 0, 'on', true), {step})")
    goodq, vext = p.goodq, p.vext

    def extended(*columns: pa.Array) -> pa.Array:
        return _extended(*columns, goodq, vext)

    # events without a text or before the reference go letter by letter, the others in columns
    odd = F.coalesce(F.col("seq").isNull() | F.col("seq_qual").isNull() | (F.col("ref_on") < 1), F.lit(True))
    cuts = ["substr(seq, read_on + 1, more)", "substr(seq_qual, read_on + 1, more)", "substr(wseq, cast(ref_on - wstart + 1 AS int), more)"]
    far = F.arrow_udf(extended, "struct<off: int, nm: int>")(F.col("op") == "D", F.when(odd, 0).otherwise(F.col("more")), *[F.coalesce(F.expr(c), F.lit("")) for c in cuts])
    ev = computed_once(ev, far=far)
    s = F.expr(scan)
    ev = computed_once(ev, s=F.when(odd, F.struct(s["off"].alias("off"), s["nm"].alias("nm"))).otherwise(F.col("far")))
    ev = ev.withColumns({"off": F.col("s.off"), "ext_nm": F.col("s.nm")}).drop("wseq", "wstart", "s", "far")

    def pieces(of: str, second_deletion: str) -> list[str]:
        """The event's stretches of ``of`` (bases or qualities) in order."""
        at = "qofs + CASE op WHEN 'I' THEN len ELSE 0 END"
        return [
            f"CASE op WHEN 'I' THEN substr({of}, qofs + 1, len) ELSE '' END",
            f"CASE kind WHEN 0 THEN '' ELSE substr({of}, {at} + 1, m1) END",
            f"CASE WHEN kind <> 2 THEN '' WHEN o2 = 'I' THEN substr({of}, {at} + m1 + 1, m2) ELSE {second_deletion} END",
            f"substr({of}, read_on + 1, off)",
        ]

    first, middle, second, ext = pieces("seq", "cast(m2 AS string)")
    key = (f"concat(CASE op WHEN 'I' THEN '+' ELSE concat('-', cast(len AS string)) END, {first}, "
           f"CASE kind WHEN 2 THEN concat('#', {middle}, '^', {second}) WHEN 1 THEN concat('^', {middle}) ELSE '' END, "
           f"CASE WHEN off > 0 THEN concat('&', {ext}) ELSE '' END)")
    # a deletion's quality has the better of its two neighbours too; an insertion followed by a deletion the base behind
    behind = "CASE op WHEN 'I' THEN substr(seq_qual, qofs + len + m1 + 1, 1) ELSE '' END"
    before, after = "substr(seq_qual, qofs, 1)", "substr(seq_qual, qofs + off + 1, 1)"
    flank = (f"CASE WHEN op = 'I' THEN '' WHEN qofs + off >= length(seq_qual) THEN {before} WHEN qofs < 1 THEN {after} "
             f"ELSE greatest({before}, {after}) END")
    quals = f"concat({', '.join(pieces('seq_qual', behind))}, {flank})"
    mean = f"aggregate(sequence(1, length(quals)), 0D, (a, k) -> a + ascii(substr(quals, k, 1)) - 33) / length(quals)"
    ev = computed_once(ev, key=F.expr(key), quals=F.expr(quals))
    ev = computed_once(ev, q=F.arrow_udf(_mean_quality, "double")("quals"))
    ev = ev.withColumn("q", F.when(F.length("quals") == 0, F.expr(mean)).otherwise(F.col("q")))
    ins = F.col("op") == "I"
    rows = ev.withColumn("k", F.explode(F.sequence(F.lit(0), F.when(ins, F.col("off")).otherwise(F.lit(0)))))
    kinds = _Kinds(p.goodq)
    anchor = F.col("seg_start") - 1
    kinds.add(ins & (F.col("k") == 0), anchor, F.col("key"), is_ins=True, q=F.col("q"), tp=_tp(F.col("pofs")), cov=0,
              keep=_in_region(anchor) & ~F.col("key").contains("N"))
    kinds.add(F.col("k") == 0, F.col("seg_start"), F.col("key"), q=F.col("q"), tp=_tp(F.col("pofs")), cov=0, nmoff=F.col("ext_nm"), keep=_in_region(F.col("seg_start")))
    kinds.add(ins, F.col("ref_on") + F.col("k") - 1, F.lit(""), q=F.lit(0.0), tp=F.lit(0), cnt=0, std=False, hilo=False)
    return kinds.project(rows)


def complex_indels(region_reads: DataFrame, ref_blocks: DataFrame, p: CallParams) -> DataFrame:
    """Accumulators of every indel allele per (region, pos), complex ones included; rows without an allele carry coverage."""
    return aggregate_events(complex_events(region_reads, ref_blocks, p))

"""Pileup: reads -> per (region, position, allele) accumulators.

Plan shape (one Spark job, two shuffles before calling):

1. ``region_reads`` (reads already joined to regions, CIGARs parsed before the
   join): reads that are one M run with at most one mismatch are summed as they
   leave the join. The others are exploded to one row per CIGAR op (``inline``
   over the op array) and written once to the shared folder, and every later
   step reads plain columns.
2. Ops that need the reference — M runs of reads with two or more mismatches
   (possible MNP), insertions (anchor check) and soft clips (clip rescue) —
   join the one reference tile that holds them on ``(chr, tile)``. Plain M runs
   of reads with at most one mismatch skip the reference entirely; N and D ops
   never need it.
3. Every op emits signed event rows with one fixed schema; M runs explode to
   bases only inside the region.
4. ``groupBy(region, pos, allele)`` with map-side partial aggregation; counts,
   sums and min/max only, so a hot region never sits in one task.

Counting and quality rules follow SURVEY §2.14.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilecall.functions.cigar import ONE_RUN, with_ops
from pilecall.functions.exprs import computed_once
from pilecall.operators.joins import ref_char, with_reference
from pilecall.operators.read_filters import REVERSE
from pilecall.params import CallParams
from pilecall.session import ensure_checkpoint_dir, shared_scratch

EVENT_COLS = [
    "region_id", "chr", "region_start", "region_end", "contig_len", "pos", "allele", "is_ins",
    "cnt", "fwd", "rev", "tp_sum", "q_sum", "mq_sum", "nm_sum", "hicnt", "locnt",
    "std_tp", "std_q", "cov",
]

_HIGH = ["std_tp_high", "std_q_high"]  # an event of several bases has their smallest and largest values

SPLICE_PREFIX = "~"  # marks junction rows inside the allele aggregation

_REGION_KEYS = ["region_id", "chr", "region_start", "region_end", "contig_len"]


def _q_at(idx: Column) -> Column:
    return F.ascii(F.substring(F.col("seq_qual"), idx + 1, 1)) - 33


def _tp(p: Column) -> Column:
    """Distance to the nearer read end: p+1 when p < rlen1-p, else rlen1-p."""
    return F.when(p < F.col("rlen1") - p, p + 1).otherwise(F.col("rlen1") - p)


def _in_region(pos: Column) -> Column:
    return (pos >= F.col("region_start")) & (pos <= F.col("region_end"))


def _not_trimmed(n: Column, p: CallParams) -> Column:
    if not p.trim:
        return F.lit(True)
    return F.when(~F.col("dir"), n <= p.trim).otherwise(F.col("rlen2") - n <= p.trim)


def read_ops(region_reads: DataFrame) -> DataFrame:
    """One row per CIGAR op with its offsets (idx, len, op, rofs, qofs, pofs, nops)."""
    base = with_ops(region_reads).select(
        *_REGION_KEYS[:4],
        F.coalesce(F.col("contig_len"), F.lit(2**62).cast("long")).alias("contig_len"),
        "start_pos", "mapq", "seq", F.col("qual").alias("seq_qual"), "tnm", "rlen1", "rlen2",
        (F.col("flag").bitwiseAND(F.lit(REVERSE)) != 0).alias("dir"), "ops",
    )
    ops = base.select("*", F.inline("ops"))
    return ops.withColumns({
        "prev_op": F.expr("CASE WHEN idx > 0 THEN ops[idx - 1].op END"),
        "first_op": F.expr("ops[0].op"),
        "seg_start": F.col("start_pos") + F.col("rofs"),
    }).drop("ops", "raw")


def _is_quiet() -> Column:
    """Whether a read is one M run that ``_sum_runs`` takes: at most one mismatch, texts of one byte a base, no number missing.

    Judged on stored columns only, so the filter and its opposite reach the scan, before CIGARs
    are parsed and reads meet regions. ``tnm`` is at most ``nm``.
    """
    numbers = " AND ".join(f"{c} IS NOT NULL" for c in ("flag", "mapq", "start_pos"))
    n = "cast(left(cigar, length(cigar) - 1) AS int)"
    texts = " AND ".join(f"octet_length({c}) = {n} AND length({c}) = {n}" for c in ("seq", "qual"))
    return F.coalesce(F.expr(f"cigar RLIKE '{ONE_RUN}' AND nm < 2 AND {numbers} AND {texts}"), F.lit(False))


def _quiet_runs(region_reads: DataFrame) -> DataFrame:
    """The M runs of quiet reads with their bases ``_lo`` .. ``_hi`` inside the region."""
    zero = F.lit(0)
    runs = region_reads.select(
        *_REGION_KEYS[:4], F.coalesce(F.col("contig_len"), F.lit(2**62).cast("long")).alias("contig_len"),
        F.lit("M").alias("op"), F.col("rlen1").alias("len"), (F.col("flag").bitwiseAND(F.lit(REVERSE)) != 0).alias("dir"), "mapq", "tnm", "rlen1", "rlen2",
        F.col("start_pos").alias("seg_start"), zero.alias("qofs"), zero.alias("pofs"), "seq", F.col("qual").alias("seq_qual"))
    lo, hi = _m_range()
    return runs.withColumns({"_lo": lo, "_hi": hi}).where("_lo <= _hi")


def is_clip(side: int) -> Column:
    """Whether an op is the soft clip at the read's start (5) or end (3)."""
    if side == 5:
        return (F.col("op") == "S") & (F.col("idx") == 0)
    return (F.col("op") == "S") & (F.col("idx") == F.col("nops") - 1) & (F.col("idx") > 0)


def is_whole_clip() -> Column:
    """Whether a clip's texts have one byte a base and no number is missing, so that it is compared in columns."""
    return F.coalesce(_whole_run("0", "len") & (F.col("seg_start") > 0) & (F.col("len") > 0), F.lit(False))


def _with_step(ops: DataFrame) -> DataFrame:
    """Add ``step``: which branch reads an op, and ``odd``: whether it goes letter by letter where others are worked out in columns."""
    if "step" in ops.columns:
        return ops
    is_m = F.col("op") == "M"
    whole = F.coalesce(_whole_run("0", "len") & (F.col("seg_start") > 0), F.lit(False))
    step = (
        F.when(is_m & (F.col("tnm") >= 2), "run")
        .when(is_m, F.when(F.coalesce(_whole_run("0", "len"), F.lit(False)), "sum").otherwise("letter"))
        .when((is_clip(5) | is_clip(3)) & is_whole_clip(), "clip")
        .when(F.col("op").isin("I", "S"), "edge")
        .when(F.col("op").isin("D", "N"), "gap").otherwise("none")
    )
    return ops.withColumns({"step": step, "odd": ~whole})


def _counts_here() -> Column:
    """Whether an op can have events in its region; a junction counts wherever it lies."""
    lo, hi = _m_range()
    first, last, op = F.col("seg_start"), F.col("seg_start") + F.col("len") - 1, F.col("op")
    before = (F.col("start_pos") - F.col("len") <= F.col("region_end")) & (F.col("start_pos") > F.col("region_start"))
    return (
        F.when(op == "M", lo <= hi).when(op == "D", _in_region(first)).when(op == "I", _in_region(first - 1))
        .when(is_clip(5), (F.col("len") < 1) | before)
        .when(is_clip(3), (F.col("len") < 1) | (first <= F.col("region_end")) & (last >= F.col("region_start")))
        .otherwise(op == "N")
    )


def op_table(region_reads: DataFrame) -> DataFrame:
    """``read_ops`` that have events in their region, written to the shared folder and read again: what all later branches start from.

    ``step`` names the branch that reads an op; a branch that no op of a file needs skips the file.
    """
    ops = _with_step(read_ops(region_reads).where(_counts_here()))
    path = shared_scratch(ops.sparkSession, "ops")
    ops.write.option("compression", "zstd").parquet(path)
    return ops.sparkSession.read.schema(ops.schema).parquet(path)


class _Kinds:
    """Event kinds of one explode: each kind is (condition, field expressions).

    The kinds become CASE expressions of a single projection after a single
    ``explode(sequence(0, nrows - 1))``, so every op is read once and the
    per-base path stays inside whole-stage codegen.
    """

    def __init__(self, goodq: float):
        self.goodq = goodq
        self.kinds: list[tuple[Column, dict[str, Column]]] = []

    def add(self, cond, pos, allele, *, q, tp, cnt=1, is_ins=False, std=True, cov=1, hilo=True, keep=None, nmoff=None):
        self.kinds.append((cond, {
            "pos": pos.cast("long"),
            "allele": allele,
            "is_ins": F.lit(is_ins),
            "sgn": F.lit(cnt) if isinstance(cnt, int) else cnt,
            "tp": tp.cast("long"),
            "q": q.cast("double"),
            "std": F.lit(std),
            "cov": F.lit(cov),
            "hilo": F.lit(hilo),
            "nmoff": nmoff if nmoff is not None else F.lit(0),
            "_keep": keep if keep is not None else F.lit(True),
        }))

    def project(self, df: DataFrame) -> DataFrame:
        # 1. which kind a row is: every condition evaluated once
        kind = None
        for i, (cond, _) in enumerate(self.kinds):
            kind = F.when(cond, F.lit(i)) if kind is None else kind.when(cond, F.lit(i))
        df = df.withColumn("_kind", kind)
        # 2. the raw fields, switching on the small kind number
        raw = []
        for name in self.kinds[0][1]:
            expr = None
            for i, (_, fields) in enumerate(self.kinds):
                expr = F.when(F.col("_kind") == i, fields[name]) if expr is None else expr.when(F.col("_kind") == i, fields[name])
            raw.append(expr.alias(name))
        d = F.col("dir")
        df = df.select(*_REGION_KEYS, d.alias("dir"), "mapq", "tnm", *raw).where(F.col("_keep"))
        # 3. the signed accumulator inputs from plain columns
        sgn, q = F.col("sgn"), F.col("q")
        hi = F.when(F.col("hilo") & (q >= self.goodq), 1).otherwise(0)
        lo = F.when(F.col("hilo") & (q < self.goodq), 1).otherwise(0)
        return df.select(
            *_REGION_KEYS, "pos", "allele", "is_ins",
            sgn.alias("cnt"),
            (sgn * F.when(~F.col("dir"), 1).otherwise(0)).alias("fwd"),
            (sgn * F.when(F.col("dir"), 1).otherwise(0)).alias("rev"),
            (sgn * F.col("tp")).cast("long").alias("tp_sum"),
            (sgn * q).alias("q_sum"),
            (sgn * F.col("mapq")).cast("long").alias("mq_sum"),
            (sgn * (F.col("tnm") - F.col("nmoff"))).cast("long").alias("nm_sum"),
            (sgn * hi).alias("hicnt"),
            (sgn * lo).alias("locnt"),
            F.when(F.col("std"), F.col("tp")).cast("int").alias("std_tp"),
            F.when(F.col("std"), q).alias("std_q"),
            F.col("cov"),
        )


def _with_high(events: DataFrame) -> DataFrame:
    return events.select("*", F.col("std_tp").alias(_HIGH[0]), F.col("std_q").alias(_HIGH[1]))


def _m_range():
    lo = F.greatest(F.lit(0), F.col("region_start") - F.col("seg_start"))
    hi = F.least(F.col("len") - 1, F.col("region_end") - F.col("seg_start"))
    return lo.cast("int"), hi.cast("int")


def _base_rows(ops: DataFrame, *more: str, at: Column | None = None) -> DataFrame:
    """One row per base ``i`` of M runs inside their region (or of the array ``at``), with its letter ``base`` and quality letter ``qch``.

    Texts are cut to the region before the explode, so a base costs the same however long its read is.
    """
    lo, hi = _m_range()
    m = ops.where(F.col("op") == "M").withColumns({"_lo": lo, "_hi": hi}).where("_lo <= _hi")
    cut = "substr({}, qofs + _lo + 1, _hi - _lo + 1)"
    m = m.select(*_REGION_KEYS, "dir", "mapq", "tnm", "rlen1", "rlen2", "seg_start", "qofs", "pofs", "_lo", *more,
                 F.expr(cut.format("seq")).alias("_bases"), F.expr(cut.format("seq_qual")).alias("_quals"), F.explode(F.sequence("_lo", "_hi") if at is None else at).alias("i"))
    at = F.col("i") - F.col("_lo") + 1
    return m.withColumns({"base": F.substring("_bases", at, 1), "qch": F.substring("_quals", at, 1)})


_SUMS = ["cnt", "fwd", "rev", "tp_sum", "q_sum", "mq_sum", "nm_sum", "hicnt", "locnt"]
AT_ONCE = 1 << 20  # bases that a task holds at once


_NUMBERS = ["mapq", "tnm", "rlen1", "rlen2", "seg_start", "qofs", "pofs"]


def _whole_run(lo: str, n: str) -> Column:
    """Whether ``n`` bases of an M run from ``lo`` on have one byte each, in both texts, and no number of the run is missing."""
    cuts = [f"substr({t}, qofs + {lo} + 1, {n})" for t in ("seq", "seq_qual")]
    return F.expr(" AND ".join([*(f"octet_length({c}) = {n} AND length({c}) = {n}" for c in cuts), *(f"{c} IS NOT NULL" for c in ["dir", *_NUMBERS])]))


def _summed_numbers(trim: int) -> list[str]:
    return ["_lo", "_hi", *(c for c in _NUMBERS if trim or c not in ("rlen2", "qofs"))]


def _numbers(batch: pa.RecordBatch, *names: str) -> dict[str, np.ndarray]:
    return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}


def letter_codes(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The letters of a text column, one row's behind the other's, and where each row's begin (and the last one's end)."""
    texts = batch.column(name).fill_null("").cast(pa.large_string())
    if pc.all(pc.equal(pc.binary_length(texts), pc.utf8_length(texts))).as_py() is False:  # letters of several bytes
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        codes = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
        return codes, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    codes = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return codes[ends[0]:ends[-1]], ends - ends[0]


def flat(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in it) of the ``n`` places of each row."""
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)


def _reference_at(batch: pa.RecordBatch, row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The letter at place ``at`` of each row's reference text, and whether there is one."""
    under, starts = letter_codes(batch, "_under")
    known = (at >= 0) & (at < (starts[1:] - starts[:-1])[row])
    if not len(under):
        return np.zeros(len(row), np.uint8), known
    return under[np.where(known, starts[row] + at, 0)], known


def key_code(runs: pa.RecordBatch, keys=_REGION_KEYS) -> np.ndarray:
    """A number from 0 on for each row, equal for equal keys."""
    code, codes = np.zeros(runs.num_rows, np.int64), 1
    for key in keys:
        k = runs.column(key).dictionary_encode(null_encoding="encode")
        if len(k.dictionary) > 1:
            if codes * len(k.dictionary) >= 1 << 62:
                code = np.unique(code, return_inverse=True)[1]
                codes = runs.num_rows
            code, codes = code * len(k.dictionary) + k.indices.to_numpy(), codes * len(k.dictionary)
    return np.unique(code, return_inverse=True)[1]


def _near_end(at: np.ndarray, rlen1: np.ndarray) -> np.ndarray:
    """``_tp`` in columns."""
    left = rlen1 - at
    return np.where(at < left, at + 1, left)


def _not_cut(n: np.ndarray, rev: np.ndarray, rlen2: np.ndarray, trim: int) -> np.ndarray:
    """``_not_trimmed`` in columns."""
    return np.where(rev, rlen2 - n, n) <= trim


def _batch(runs: pa.RecordBatch, some: np.ndarray, values: list) -> pa.RecordBatch:
    """Event rows: the region keys of the rows ``some`` and the other columns in order."""
    head = runs.select(_REGION_KEYS).take(pa.array(some))
    return pa.RecordBatch.from_arrays([*head.columns, *map(pa.array, values)], [*_REGION_KEYS, "pos", "allele", "is_ins", *_SUMS, "std_tp", "std_q", "cov", *_HIGH])


def _summed(runs: pa.RecordBatch, goodq: float, trim: int) -> pa.RecordBatch:
    """One batch of M runs as the sums of its bases per (region, position, letter)."""
    col = _numbers(runs, "dir", *_summed_numbers(trim))
    row, i = flat(col["_hi"] - col["_lo"] + 1)
    i = i + col["_lo"][row]
    base, q = letter_codes(runs, "_bases")[0], letter_codes(runs, "_quals")[0].astype(np.int64) - 33
    rev = col["dir"].astype(bool)[row]
    keep = base != ord("N")
    if trim:
        keep &= _not_cut(col["qofs"][row] + i, rev, col["rlen2"][row], trim)
    if not keep.all():
        row, i, base, q = (x[keep] for x in (row, i, base, q))
    at = (col["pofs"][row] + i).astype(np.int64)
    return _totals(runs, row, col["seg_start"][row] + i, base, q, _near_end(at, col["rlen1"][row]), col["tnm"][row], goodq)


def _totals(runs: pa.RecordBatch, row: np.ndarray, pos: np.ndarray, base: np.ndarray, q: np.ndarray, tp: np.ndarray, nm: np.ndarray, goodq: float, spread: bool = True) -> pa.RecordBatch:
    """Single bases (their rows in ``runs``, positions, letters, qualities, ...) as sums per (region, position, letter).

    Without ``spread`` they have no say in whether places and qualities differ.
    """
    if not len(row):
        return None
    col = _numbers(runs, "region_start", "dir", "mapq")
    code = key_code(runs)
    rev = col["dir"].astype(bool)[row]
    offset = pos - col["region_start"][row]
    letters = np.flatnonzero(np.bincount(base, minlength=256))
    numbered = np.zeros(256, np.int64)
    numbered[letters] = np.arange(len(letters))
    base = numbered[base]
    width = int(offset.max()) + 1
    key = (code[row] * width + offset) * len(letters) + base
    cells = (int(code.max()) + 1) * width * len(letters)
    if cells > 4 * len(key) + 4096:  # wide regions with few bases: number the keys that exist
        kept, key = np.unique(key, return_inverse=True)
        cells = len(kept)
    else:
        kept = np.arange(cells)
    cnt = np.bincount(key, minlength=cells)
    at = np.flatnonzero(cnt)

    def total(x):
        return np.bincount(key, weights=x, minlength=cells)[at]  # sums of integers, exact in doubles

    def end(x, ufunc, start, kind):
        if not spread:
            return pa.nulls(len(at), pa.from_numpy_dtype(kind))
        out = np.full(cells, start, np.int64)
        ufunc.at(out, key, x)
        return out[at].astype(kind)

    some = np.zeros(cells, np.int64)
    some[key] = row  # a row of each key
    some, cnt, kept = some[at], cnt[at], kept[at]
    big = np.iinfo(np.int64).max
    fwd, hicnt = (total(x).astype(np.int64) for x in (~rev, q >= goodq))
    tps, mqs = (total(x).astype(np.int64) for x in (tp, col["mapq"][row]))
    nms = total(nm).astype(np.int64) if nm.any() else np.zeros(len(at), np.int64)
    sums = [cnt, fwd, cnt - fwd, tps, total(q), mqs, nms, hicnt, cnt - hicnt]
    ends = [end(tp, np.minimum, big, np.int32), end(q, np.minimum, big, float), cnt, end(tp, np.maximum, -big, np.int32), end(q, np.maximum, -big, float)]
    names = pa.array([chr(x) for x in letters], pa.string()).take(pa.array(kept % len(letters)))
    pos = (col["region_start"][some] + kept // len(letters) % width).astype(np.int64)
    return _batch(runs, some, [pos, names, np.zeros(len(at), bool), *sums, *ends])


def _merged(row: np.ndarray, i: np.ndarray, linked: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multi-base changes (E4) out of mismatches in order: those that belong to one, which of these are first, and each one's length.

    A mismatch is ``linked`` when it lies in the region and could go on from the one before; of
    mismatches linked one to the other, all from the first ``good`` one on are one change.
    """
    linked = linked & np.concatenate([[False], (row[1:] == row[:-1]) & (i[1:] == i[:-1] + 1)])[:len(row)]
    first = np.flatnonzero(~linked)
    chain = np.cumsum(~linked) - 1
    before = (np.cumsum(good) - good)[first]
    opened = np.cumsum(good) > before[chain]
    size = np.bincount(chain[opened], minlength=len(first))
    member = opened & (size[chain] > 1)
    head = member & ~np.concatenate([[False], member[:-1] & linked[1:]])[:len(row)]
    return member, head, size[chain]


def _run_batches(runs: pa.RecordBatch, goodq: float, trim: int):
    """One batch of M runs with two or more mismatches as event rows: sums of single bases, a row for each multi-base change, depth under the others' bases."""
    col = _numbers(runs, "region_start", "region_end", "dir", "mapq", "_lo", "_hi", "_at", *_NUMBERS)
    row, i = flat(col["_hi"] - col["_at"] + 1)
    under, known = _reference_at(runs, row, i)
    i = i + col["_at"][row]
    base, q = letter_codes(runs, "_bases")[0], letter_codes(runs, "_quals")[0].astype(np.int64) - 33
    k = np.flatnonzero(known & (under != ord(".")) & (under != ord("N")) & (base != ord("N")) & (base != under))
    pos = col["seg_start"][row] + i
    here = (pos >= col["region_start"][row]) & (pos <= col["region_end"][row])
    member, head, size = _merged(row[k], i[k], here[k], q[k] >= goodq)
    inside, first, length = np.zeros(len(row), bool), np.zeros(len(row), bool), np.zeros(len(row), np.int64)
    inside[k[member]] = True
    first[k[head]] = True
    length[k[head]] = size[head]
    # mismatches that the run's changes have absorbed up to here count once
    total = np.cumsum(np.where(first, length - 1, 0))
    start = np.cumsum(col["_hi"] - col["_at"] + 1) - (col["_hi"] - col["_at"] + 1)
    absorbed = total - (np.concatenate([[0], total])[start])[row]
    rev = col["dir"].astype(bool)[row]
    ok = (i >= col["_lo"][row]) & (base != ord("N"))
    if trim:
        ok &= _not_cut(col["qofs"][row] + i, rev, col["rlen2"][row], trim)
    at, nm, rlen1 = col["pofs"][row] + i, col["tnm"][row] - absorbed, col["rlen1"][row]
    one = ok & ~inside
    out = _totals(runs, row[one], pos[one], base[one], q[one], _near_end(at[one], rlen1[one]), nm[one], goodq)
    if out is not None:
        yield out
    h = np.flatnonzero(ok & first)
    if len(h):
        n = length[h]
        text = base.tobytes().decode("latin-1")
        names = pa.array([f"{text[a]}&{text[a + 1:a + m]}" for a, m in zip(h.tolist(), n.tolist())], pa.string())
        sums = np.concatenate([[0], np.cumsum(q)])
        mean = (sums[h + n] - sums[h]) / n
        tp = _near_end(at[h] + n - 1, rlen1[h])
        ones = np.ones(len(h), np.int64)
        high = (mean >= goodq).astype(np.int64)
        r = rev[h].astype(np.int64)
        ends = [tp.astype(np.int32), mean]
        yield _batch(runs, row[h], [pos[h], names, np.zeros(len(h), bool), ones, 1 - r, r, tp.astype(np.int64), mean, col["mapq"][row[h]].astype(np.int64),
                                    nm[h].astype(np.int64), high, 1 - high, *ends, ones, *ends])
    # the other bases of a change that begins in the region
    begins = np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
    rest = np.flatnonzero(ok & inside & ~first & (i[begins] >= col["_lo"][row])) if len(row) else []
    if len(rest):
        code, offset = key_code(runs)[row[rest]], pos[rest] - col["region_start"][row[rest]]
        _, some, depth = np.unique(code * (int(offset.max()) + 1) + offset, return_index=True, return_counts=True)
        some = rest[some]
        none = np.zeros(len(some), np.int64)
        ends = [pa.nulls(len(some), pa.int32()), pa.nulls(len(some), pa.float64())]
        yield _batch(runs, row[some], [pos[some], pa.array([""] * len(some), pa.string()), none.astype(bool), none, none, none, none, none.astype(float), none,
                                       none, none, none, *ends, depth.astype(np.int64), *ends])


def rescued_bases(clips: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """E12 in columns: (row, step, letter, quality, whether rescued) of every clipped base, from the alignment outwards, and each clip's number of rescued bases.

    Needs side, len, contig_len, ``_from`` (the first clipped position outwards), ``_under`` (the
    reference from ``_ref`` on), and the clip's ``_bases`` and ``_quals``, a byte a base.
    """
    col = _numbers(clips, "side", "len", "contig_len", "_from", "_ref")
    row, t = flat(col["len"])
    five = (col["side"] == 5)[row]
    pos = col["_from"][row] + np.where(five, -t, t)
    text = np.cumsum(col["len"]) - col["len"]
    at = text[row] + np.where(five, col["len"][row] - 1 - t, t)
    base, q = letter_codes(clips, "_bases")[0][at], letter_codes(clips, "_quals")[0][at].astype(np.int64) - 33
    under, known = _reference_at(clips, row, pos - col["_ref"][row])
    same = known & (base == under) & (q > 10) & (~five | (pos <= col["contig_len"][row]))
    stops = np.concatenate([[0], np.cumsum(~same)])
    rescued = same & (stops[1:] == stops[text[row]])
    return row, t, base, q, rescued, np.bincount(row[rescued], minlength=len(col["len"]))


def _clip_sums(clips: pa.RecordBatch, goodq: float) -> pa.RecordBatch:
    """One batch of soft clips as the sums of their rescued bases inside the region."""
    row, t, base, q, rescued, _ = rescued_bases(clips)
    col = _numbers(clips, "side", "len", "_from", "region_start", "region_end", "rlen2", "pofs", "tnm")
    five = (col["side"] == 5)[row]
    pos = col["_from"][row] + np.where(five, -t, t)
    k = rescued & (pos >= col["region_start"][row]) & (pos <= col["region_end"][row])
    tp = np.where(five, col["len"][row] - t, col["rlen2"][row] - (col["pofs"][row] + t))
    return _totals(clips, row[k], pos[k], base[k], q[k], tp[k], col["tnm"][row[k]], goodq, spread=False)


def in_slices(work, size):
    """A function over batches that hands ``work`` slices of about ``AT_ONCE`` bases; ``size`` says how many each row has."""
    def sums(batches):
        for batch in batches:
            n = np.cumsum(size(batch))
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(n, (n[at - 1] if at else 0) + AT_ONCE, "right")))
                yield from (out for out in work(batch.slice(at, end - at)) if out is not None)
                at = end

    return sums


def _sums_schema(ops: DataFrame, p: CallParams) -> T.StructType:
    kept = {f.name: f for f in _with_high(_letter_events(ops, p)).schema.fields}
    return T.StructType([T.StructField(c, T.LongType() if c in _SUMS and c != "q_sum" or c == "cov" else kept[c].dataType) for c in [*EVENT_COLS, *_HIGH]])


def _sum_runs(m: DataFrame, p: CallParams) -> DataFrame:
    """The bases ``_lo`` .. ``_hi`` of whole M runs, summed per (region, position, letter) batch by batch, in columns.

    So the shuffle's partial aggregation meets sums and not bases.
    """
    cuts = {c: f"substr({t}, qofs + _lo + 1, _hi - _lo + 1)" for c, t in (("_bases", "seq"), ("_quals", "seq_qual"))}
    runs = m.select(*_REGION_KEYS, "dir", *_summed_numbers(p.trim), *[F.expr(t).alias(c) for c, t in cuts.items()])
    goodq, trim = p.goodq, p.trim
    sums = in_slices(lambda batch: [_summed(batch, goodq, trim)], lambda b: b.column("_hi").to_numpy() - b.column("_lo").to_numpy() + 1)
    return runs.mapInArrow(sums, _sums_schema(m, p))


def _base_events(ops: DataFrame, p: CallParams) -> DataFrame:
    """M runs of reads with <= 1 mismatch, which make most of all events.

    Runs that lack a number or quality, or whose texts don't have one byte a base, go base by base.
    """
    lo, hi = _m_range()
    ops = _with_step(ops)
    m = ops.where(F.col("step") == "sum").withColumns({"_lo": lo, "_hi": hi}).where("_lo <= _hi")
    return _sum_runs(m, p).unionByName(_with_high(_letter_events(ops.where(F.col("step") == "letter"), p)))


def _letter_events(ops: DataFrame, p: CallParams) -> DataFrame:
    """Bases of M runs as they are, an event each."""
    rows = _base_rows(ops)
    kinds = _Kinds(p.goodq)
    kinds.add(F.lit(True), F.col("seg_start") + F.col("i"), F.col("base"), q=F.ascii("qch") - 33, tp=_tp(F.col("pofs") + F.col("i")),
              keep=(F.col("base") != "N") & _not_trimmed(F.col("qofs") + F.col("i"), p))
    return kinds.project(rows)


def _gap_events(ops: DataFrame, p: CallParams, splices: bool = False) -> DataFrame:
    """Deletions (E6). With ``splices`` each N op also emits one row keyed ``~start-end``
    so junction counts come out of the same aggregation.
    """
    nrows = F.when((F.col("op") == "D") & _in_region(F.col("seg_start")), F.col("len")).otherwise(F.lit(0))
    nrows = F.when(F.col("op") == "N", F.lit(1)).otherwise(nrows) if splices else nrows
    rows = ops.where(F.col("step") == "gap").withColumn("_n", nrows).where(F.col("_n") > 0)
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    kinds = _Kinds(p.goodq)
    # deletion event at the first deleted base
    q1 = F.substring("seq_qual", F.col("qofs"), 1)
    q2 = F.substring("seq_qual", F.col("qofs") + 1, 1)
    qch = F.when(F.col("qofs") >= F.length("seq_qual"), q1).when(F.col("qofs") < 1, q2).otherwise(F.greatest(q1, q2))
    kinds.add((F.col("op") == "D") & (F.col("k") == 0), F.col("seg_start"),
              F.concat(F.lit("-"), F.col("len").cast("string")), q=F.ascii(qch) - 33, tp=_tp(F.col("pofs")))
    # coverage over the other deleted bases
    kinds.add(F.col("op") == "D", F.col("seg_start") + F.col("k"), F.lit(""), q=F.lit(0.0), tp=F.lit(0),
              cnt=0, std=False, hilo=False, keep=_in_region(F.col("seg_start") + F.col("k")))
    if splices:
        junction = F.concat(F.lit(SPLICE_PREFIX), (F.col("seg_start") - 1).cast("string"), F.lit("-"),
                            (F.col("seg_start") + F.col("len") - 1).cast("string"))
        kinds.add(F.col("op") == "N", F.col("seg_start") - 1, junction, q=F.lit(0.0), tp=F.lit(0),
                  std=False, cov=0, hilo=False)
    return kinds.project(rows)


def _plain_events(ops: DataFrame, p: CallParams, splices: bool = False) -> DataFrame:
    """Ops needing no reference: M runs of reads with <= 1 mismatch, deletions and, if asked for, junctions."""
    ops = _with_step(ops)
    return _base_events(ops, p).unionByName(_with_high(_gap_events(ops, p, splices)))


_MNP_FOLD = (
    "aggregate(mmidx, "
    "named_struct('ev', cast(array() AS array<struct<s:int,l:int>>), 'cs', -10, 'cl', 0, 'open', false), "
    "(acc, j) -> CASE WHEN acc.open AND j = acc.cs + acc.cl AND seg_start + j BETWEEN region_start AND region_end "
    "THEN named_struct('ev', acc.ev, 'cs', acc.cs, 'cl', acc.cl + 1, 'open', true) "
    "ELSE named_struct('ev', CASE WHEN acc.cl > 1 THEN concat(acc.ev, array(named_struct('s', acc.cs, 'l', acc.cl))) ELSE acc.ev END, "
    "'cs', j, 'cl', 1, 'open', (ascii(substr(seq_qual, qofs + j + 1, 1)) - 33) >= {goodq}) END, "
    "acc -> CASE WHEN acc.cl > 1 THEN concat(acc.ev, array(named_struct('s', acc.cs, 'l', acc.cl))) ELSE acc.ev END)"
)


# whether clipped base t (from the alignment outwards) matches the reference
RESCUED_5 = (
    "(start_pos - 1 - t > 0 AND start_pos - 1 - t <= contig_len AND start_pos - 1 - t >= wstart "
    "AND substr(seq, len - t, 1) = substr(wseq, start_pos - 1 - t - wstart + 1, 1) "
    "AND ascii(substr(seq_qual, len - t, 1)) - 33 > 10)"
)
RESCUED_3 = (
    "(substr(seq, qofs + t + 1, 1) = substr(wseq, seg_start + t - wstart + 1, 1) "
    "AND ascii(substr(seq_qual, qofs + t + 1, 1)) - 33 > 10)"
)


def _run_events(ops: DataFrame, p: CallParams) -> DataFrame:
    """M runs joined to a reference window: mismatches merged into MNPs (E4, only when >= 2 mismatches).

    Bases outside MNPs are summed, each with the mismatches that its run still counts; only MNPs
    are events of their own. A merge may start one base before the region.
    """
    lo, hi = _m_range()
    ops = _with_step(ops)
    m = ops.where(~F.col("odd")).withColumns({"_lo": lo, "_hi": hi, "_at": F.greatest(lo - 1, F.lit(0))}).where("_lo <= _hi")
    cuts = {"_bases": "substr(seq, qofs + _at + 1, _hi - _at + 1)", "_quals": "substr(seq_qual, qofs + _at + 1, _hi - _at + 1)",
            "_under": "substr(wseq, cast(seg_start - wstart + _at + 1 AS int), _hi - _at + 1)"}
    m = m.select(*_REGION_KEYS, "dir", *_NUMBERS, "_lo", "_hi", "_at", *[F.expr(t).alias(c) for c, t in cuts.items()])
    goodq, trim = p.goodq, p.trim
    sums = in_slices(lambda batch: _run_batches(batch, goodq, trim), lambda b: b.column("_hi").to_numpy() - b.column("_at").to_numpy() + 1)
    return m.mapInArrow(sums, _sums_schema(ops, p)).unionByName(_odd_run_events(ops.where("odd"), p))


def _odd_run_events(ops: DataFrame, p: CallParams) -> DataFrame:
    """The same base by base, for runs that lack a number or quality or whose texts don't have one byte a base."""
    goodq = p.goodq
    lo, hi = _m_range()
    m = computed_once(ops.withColumns({"_lo": lo, "_hi": hi}).where("_lo <= _hi"), _read=F.expr("substr(seq, qofs + 1, len)"),
                      _under=F.expr("substr(wseq, cast(seg_start - wstart + 1 AS int), len)"))
    # beyond the window nothing differs, beyond the read's text everything does
    mm = "substr(_under, i + 1, 1) NOT IN ('.', '', 'N') AND substr(_read, i + 1, 1) NOT IN ('N', substr(_under, i + 1, 1))"
    m = computed_once(m, mmidx=F.expr(f"filter(sequence(0, len - 1), i -> coalesce({mm}, false))")).drop("_read", "_under")
    empty = F.expr("cast(array() AS array<struct<s:int,l:int>>)")
    m = computed_once(m, mnps=F.when(F.size("mmidx") >= 2, F.expr(_MNP_FOLD.format(goodq=goodq))).otherwise(empty))
    rows = _base_rows(m, "mnps", "seq", "seq_qual")
    rows = rows.withColumn("mnp", F.expr("CASE WHEN size(mnps) > 0 THEN get(filter(mnps, x -> x.s <= i AND i < x.s + x.l), 0) END"))
    kinds = _Kinds(goodq)
    # single bases, MNP heads and bases swallowed by an MNP
    base = F.col("base")
    base_ok = (base != "N") & _not_trimmed(F.col("qofs") + F.col("i"), p)
    # mismatches that the op's MNPs have absorbed up to here count once
    absorbed = F.expr("CASE WHEN size(mnps) > 0 THEN aggregate(filter(mnps, x -> x.s <= i), 0, (a, x) -> a + x.l - 1) ELSE 0 END")
    kinds.add(F.col("mnp").isNull(), F.col("seg_start") + F.col("i"), base, q=F.ascii("qch") - 33,
              tp=_tp(F.col("pofs") + F.col("i")), keep=base_ok, nmoff=absorbed)
    mlen = F.col("mnp.l")
    allele = F.concat(base, F.lit("&"), F.expr("substr(seq, qofs + i + 2, mnp.l - 1)"))
    qmean = F.expr("aggregate(sequence(0, mnp.l - 1), 0D, (a, k2) -> a + ascii(substr(seq_qual, qofs + i + k2 + 1, 1)) - 33) / mnp.l")
    kinds.add(F.col("mnp.s") == F.col("i"), F.col("seg_start") + F.col("i"), allele, q=qmean,
              tp=_tp(F.col("pofs") + F.col("i") + mlen - 1), keep=base_ok, nmoff=absorbed)
    kinds.add(F.lit(True), F.col("seg_start") + F.col("i"), F.lit(""), q=F.lit(0.0), tp=F.lit(0), cnt=0, std=False,
              hilo=False, keep=base_ok & _in_region(F.col("seg_start") + F.col("mnp.s")))
    return _with_high(kinds.project(rows))


def _ref_events(ops: DataFrame, p: CallParams) -> DataFrame:
    """Ops joined to a reference window: MNP runs (E4), insertions (E5), clip rescue."""
    edges = _with_high(_edge_events(ops.where(F.col("step") == "edge"), p))
    return _run_events(ops.where(F.col("step") == "run"), p).unionByName(_clip_events(ops.where(F.col("step") == "clip"), p)).unionByName(edges)


def clip_texts(clips: DataFrame) -> DataFrame:
    """What ``rescued_bases`` needs of soft clips joined to their reference window."""
    five = F.col("idx") == 0
    s = clips.withColumns({"side": F.when(five, F.lit(5)).otherwise(F.lit(3)), "_from": F.when(five, F.col("start_pos") - 1).otherwise(F.col("seg_start")),
                           "_ref": F.when(five, F.greatest(F.col("start_pos") - F.col("len"), F.col("wstart"))).otherwise(F.col("seg_start"))})
    cut = "substr({}, CASE side WHEN 5 THEN 1 ELSE qofs + 1 END, len)"
    under = "substr(wseq, cast(_ref - wstart + 1 AS int), CASE side WHEN 5 THEN cast(start_pos - _ref AS int) ELSE len END)"
    return s.withColumns({"_bases": F.expr(cut.format("seq")), "_quals": F.expr(cut.format("seq_qual")), "_under": F.expr(under)})


def _clip_events(ops: DataFrame, p: CallParams) -> DataFrame:
    """Clip rescue (E12) of clips whose texts have one byte a base."""
    s = clip_texts(ops).select(*_REGION_KEYS, "dir", "mapq", "tnm", "rlen2", "pofs", "len", "side", "_from", "_ref", "_bases", "_quals", "_under")
    goodq = p.goodq
    sums = in_slices(lambda batch: [_clip_sums(batch, goodq)], lambda b: b.column("len").to_numpy())
    return s.mapInArrow(sums, _sums_schema(ops, p))


def _edge_events(ops: DataFrame, p: CallParams) -> DataFrame:
    """Insertions (E5) and clip rescue (E12) of clips that go letter by letter."""
    goodq = p.goodq
    # -- soft clips: how many clipped bases are rescued
    is5, is3 = is_clip(5), is_clip(3)
    ap = (
        F.when(is5, F.expr(f"array_position(transform(sequence(0, len - 1), t -> {RESCUED_5}), false)"))
        .when(is3, F.expr(f"array_position(transform(sequence(0, len - 1), t -> {RESCUED_3}), false)"))
    )
    ops = computed_once(ops, rescued=F.when(ap == 0, F.col("len")).otherwise(ap - 1))
    # -- insertions: the insertion, the anchor subtraction, the anchor added after a leading clip
    is_i = F.col("op") == "I"
    anchor = F.col("seg_start") - 1
    iq = F.expr("aggregate(sequence(0, len - 1), 0D, (a, k2) -> a + ascii(substr(seq_qual, qofs + k2 + 1, 1)) - 33) / len")
    ops = computed_once(ops, iq=F.when(is_i & _in_region(anchor), iq))
    iq = F.col("iq")
    key = F.concat(F.lit("+"), F.expr("substr(seq, qofs + 1, len)"))
    counted = _in_region(anchor) & ~key.contains("N")
    rbase = ref_char(F.col("wseq"), F.col("wstart"), anchor)
    prev_base = F.substring("seq", F.col("qofs"), 1)
    taken = counted & (F.col("prev_op") == "M") & (prev_base == rbase)
    added = counted & (F.col("idx") == 1) & F.col("first_op").isin("S", "H") & (rbase != "")
    steps = F.array_compact(F.array(F.when(counted, 0), F.when(taken, 1), F.when(added, 2)))
    rescued = F.when((is5 | is3) & (F.col("rescued") > 0), F.sequence(F.lit(0), F.col("rescued") - 1))
    rows = ops.withColumn("k", F.explode(F.when(is_i, steps).otherwise(rescued)))
    kinds = _Kinds(goodq)
    kinds.add(is_i & (F.col("k") == 0), anchor, key, is_ins=True, q=iq, tp=_tp(F.col("pofs")))
    kinds.add(is_i & (F.col("k") == 1), anchor, prev_base, cnt=-1, q=_q_at(F.col("qofs") - 1), tp=_tp(F.col("pofs")),
              std=False, cov=0)
    kinds.add(is_i & (F.col("k") == 2), anchor, rbase, q=iq, tp=_tp(F.col("pofs")), std=False, hilo=False)
    # S: rescued clip bases count as reference matches
    pos5 = F.col("start_pos") - 1 - F.col("k")
    kinds.add(is5, pos5, F.substring("seq", F.col("len") - F.col("k"), 1), q=_q_at(F.col("len") - 1 - F.col("k")),
              tp=F.col("len") - F.col("k"), std=False, keep=_in_region(pos5))
    pos3 = F.col("seg_start") + F.col("k")
    kinds.add(is3, pos3, F.substring("seq", F.col("qofs") + F.col("k") + 1, 1), q=_q_at(F.col("qofs") + F.col("k")),
              tp=F.col("rlen2") - (F.col("pofs") + F.col("k")), std=False, keep=_in_region(pos3))
    return kinds.project(rows)


def _needs_ref() -> Column:
    return F.col("step").isin("run", "edge", "clip")


def _ref_lo() -> Column:
    lo = (
        F.when(F.col("op") == "I", F.col("seg_start") - 1)
        .when((F.col("op") == "S") & (F.col("idx") == 0), F.col("start_pos") - F.col("len"))
        .otherwise(F.col("seg_start"))
    )
    return F.greatest(lo, F.lit(1))


def _ref_hi() -> Column:
    hi = (
        F.when(F.col("op") == "I", F.col("seg_start") - 1)
        .when((F.col("op") == "S") & (F.col("idx") == 0), F.col("start_pos") - 1)
        .otherwise(F.col("seg_start") + F.col("len") - 1)
    )
    return F.greatest(hi, _ref_lo())


def attach_windows(ops: DataFrame, ref_blocks: DataFrame) -> DataFrame:
    """C4: the reference around each op, as ``wseq`` from ``wstart`` on."""
    return with_reference(ops.withColumns({"_lo": _ref_lo(), "_hi": _ref_hi()}), ref_blocks)


def pileup_events(region_reads: DataFrame, ref_blocks: DataFrame, p: CallParams,
                  splices: bool = False) -> DataFrame:
    """All signed event rows (EVENT_COLS) of the reads that overlap each region.

    Reads that are one whole M run and need no reference (most of all) are summed as they leave the
    overlap join. The others go through one op table with a branch for ops that need no reference
    and one for ops joined to a reference tile, each split so that a branch has one kind of rows.
    Each branch explodes once, and its generated code stays small enough to be compiled to machine
    code: one projection over all kinds was not, and ran interpreted.
    """
    quiet = _is_quiet()
    ops = op_table(region_reads.where(~quiet))
    plain = _plain_events(ops.where(~_needs_ref()), p, splices)
    withref = _ref_events(attach_windows(ops.where(_needs_ref()), ref_blocks), p)
    return _sum_runs(_quiet_runs(region_reads.where(quiet)), p).unionByName(plain).unionByName(withref)


def aggregate_events(events: DataFrame) -> DataFrame:
    """groupBy(region, pos, allele) with map-side partial aggregation."""
    events = events if _HIGH[0] in events.columns else _with_high(events)
    return events.groupBy(*_REGION_KEYS, "pos", "allele", "is_ins").agg(
        F.sum("cnt").cast("long").alias("cnt"),
        F.sum("fwd").cast("long").alias("fwd"),
        F.sum("rev").cast("long").alias("rev"),
        F.sum("tp_sum").alias("tp_sum"),
        F.sum("q_sum").alias("q_sum"),
        F.sum("mq_sum").alias("mq_sum"),
        F.sum("nm_sum").alias("nm_sum"),
        F.sum("hicnt").cast("long").alias("hicnt"),
        F.sum("locnt").cast("long").alias("locnt"),
        (F.min("std_tp") != F.max(_HIGH[0])).alias("pstd"),
        (F.min("std_q") != F.max(_HIGH[1])).alias("qstd"),
        F.sum("cov").cast("long").alias("cov_add"),
        # an aggregate (not a key) so a filter on it stays above the shuffle and
        # both consumers of this aggregation share one exchange
        F.max(F.col("allele").startswith(SPLICE_PREFIX)).alias("is_splice"),
    )


def pileup(region_reads: DataFrame, ref_blocks: DataFrame, p: CallParams) -> DataFrame:
    """Allele accumulators per (region, pos, allele); rows with allele '' carry coverage only."""
    return aggregate_events(pileup_events(region_reads, ref_blocks, p))


def pileup_tables(region_reads: DataFrame, ref_blocks: DataFrame, p: CallParams) -> tuple[DataFrame, DataFrame]:
    """(alleles, splices) from one aggregation over the reads.

    The aggregate is checkpointed (eager) into the session's shared checkpoint
    folder: it is the expensive, read-sized part of the job, both outputs and
    every later window/join read it back instead of rescanning the reads, and a
    lost executor afterwards costs a re-read of the checkpoint, not a re-pileup.
    """
    agg = aggregate_events(pileup_events(region_reads, ref_blocks, p, splices=True))
    ensure_checkpoint_dir(agg.sparkSession)
    agg = agg.checkpoint(eager=True)
    is_sp = F.col("is_splice")
    alleles = agg.where(~is_sp)
    spl = agg.where(is_sp).select("region_id", F.expr("substr(allele, 2)").alias("junction"), F.col("cnt"))
    return alleles, spl


def _covered(ops: DataFrame, p: CallParams) -> DataFrame:
    """Depth changes (pos, step) of the ops that need no reference: two rows an op, whatever its length.

    An M run covers its part inside the region (and the trimmed range); bases 'N' are
    taken out one by one. A deletion whose start lies in the region covers its bases there.
    """
    lo, hi = _m_range()
    is_m = F.col("op") == "M"
    if p.trim:
        # n = qofs + i counts from 0: forward reads keep n <= trim, reverse ones rlen2 - n <= trim
        hi = F.when(is_m & ~F.col("dir"), F.least(hi, p.trim - F.col("qofs"))).otherwise(hi)
        lo = F.when(is_m & F.col("dir"), F.greatest(lo, F.col("rlen2") - p.trim - F.col("qofs"))).otherwise(lo)
    rows = ops.where(F.col("op").isin("M", "D")).withColumns({"lo": lo.cast("int"), "hi": hi.cast("int")}).where(
        (F.col("lo") <= F.col("hi")) & (is_m | _in_region(F.col("seg_start"))))
    rows = rows.withColumn("part", F.when(is_m, F.expr("substr(seq, qofs + lo + 1, hi - lo + 1)")).otherwise(F.lit("")))
    # a read may end before its CIGAR does: what lies beyond holds no base (an empty string is none of 'N')
    steps = "array(struct(lo AS at, 1 AS step), struct(hi + 1 AS at, -1 AS step))"
    gaps = ("flatten(transform(filter(sequence(1, length(part)), i -> substr(part, i, 1) = 'N'), "
            "i -> array(struct(lo + i - 1 AS at, -1 AS step), struct(lo + i AS at, 1 AS step))))")
    steps = f"CASE WHEN instr(part, 'N') > 0 THEN concat({steps}, {gaps}) ELSE {steps} END"
    rows = rows.select(*_REGION_KEYS, "seg_start", F.expr(f"inline({steps})"))
    return rows.select(*_REGION_KEYS, (F.col("seg_start") + F.col("at")).alias("pos"), "step")


def coverage(region_reads: DataFrame, ref_blocks: DataFrame, p: CallParams) -> DataFrame:
    """Depth per (region, pos), from changes of depth at the ends of segments.

    Ops that need no reference give +1 and -1 at their ends; the events of the others give
    theirs at each base. Changes are summed per position (map-side combined), and the
    running sum over a region's changes is the depth up to the next change.
    """
    ops = op_table(region_reads)
    points = _ref_events(attach_windows(ops.where(_needs_ref()), ref_blocks), p).where("cov <> 0")
    points = points.select(*_REGION_KEYS, F.expr("inline(array(struct(pos, cov AS step), struct(pos + 1 AS pos, -cov AS step)))"))
    steps = _covered(ops.where(~_needs_ref()), p).unionByName(points)
    steps = steps.groupBy(*_REGION_KEYS, "pos").agg(F.sum("step").alias("step"))
    # a window holds the changes inside one region: as many as the region has positions, at most
    w = Window.partitionBy("region_id").orderBy("pos")
    runs = steps.withColumns({"cov": F.sum("step").over(w).cast("long"), "_next": F.lead("pos").over(w)}).where("cov > 0")
    return runs.select(*_REGION_KEYS, F.explode(F.sequence("pos", F.col("_next") - 1)).alias("pos"), "cov")


def splice_counts(region_reads: DataFrame) -> DataFrame:
    """Reads per intron ``start-end`` seen in each region's reads."""
    ops = read_ops(region_reads).where(F.col("op") == "N")
    junction = F.concat_ws("-", (F.col("seg_start") - 1).cast("string"), (F.col("seg_start") + F.col("len") - 1).cast("string"))
    return ops.groupBy("region_id", junction.alias("junction")).agg(F.count(F.lit(1)).alias("cnt"))

"""Best-fit packing of token pieces into sequences by a configuration linear program.

Every document is its token ids and an end id; only documents longer than a sequence
are cut, into whole sequences, the shorter rest first. The pieces' length histogram
(at most ``capacity`` numbers) goes to the driver, which solves the covering program

    minimise  sum x_p  over configurations p  with  sum a_pl x_p >= n_l  for each length l

by multiplicative weights: lengths covered less get larger weights, and the next
configuration is the best filling of a sequence by the weights, priced by a knapsack
dynamic program over the capacity. A share of the fractional solution is rounded to whole
sequences, the program is solved anew for the pieces left, and so on; only the last few
sequences are packed best fit: the longest length left, filled up by a subset-sum program.
The driver holds histograms and configurations only; pieces are matched to places in
Spark by their rank among pieces of equal length, ranked within salted buckets whose
sizes give each bucket's first rank.

Edge cases: null and empty texts are one end id; repeated rows are packed as often as
they occur; a null ``doc_id`` stays null; extra columns are ignored; no documents, no
sequences.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import default_tokenizer, slices, written
from .tokens import Encoder


@dataclass(frozen=True)
class PackParams:
    capacity: int = 1024
    end_id: int = 2
    tokenizer: tuple[str, str] | None = None  # files of ranks and JSON; None: the installed public ones
    rounds: int = 80  # least number of rounds of the multiplicative weights, each time that the program is solved
    work: int = 90_000  # rounds times lengths: few lengths get more rounds
    step: tuple[float, float] = (0.05, 0.5)  # least and largest share of a length's demand that one round may cover
    eta: float = 8.0  # how fast a covered length loses weight
    lean: float = 0.5  # how much more than in proportion a long piece weighs at first
    share: float = 0.6  # of the sequences that the pieces left need, taken from one solution
    tail: int = 12  # sequences that are packed best fit in the end
    buckets: int = 1024  # for ranking the pieces of one length


def pieces(docs: DataFrame, p: PackParams = PackParams()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of every document."""
    paths = p.tokenizer or default_tokenizer()

    def run(batches):
        encoder = Encoder(*paths)
        for batch in slices(batches):
            docs_, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            where, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(texts):
                ids = np.append(encoder.ids(text or ""), np.uint32(p.end_id)).astype("<u4")
                first = len(ids) % p.capacity or p.capacity
                cuts = [0, *range(first, len(ids) + 1, p.capacity)]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    where.append(k)
                    piece.append(i)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [docs_.take(pa.array(where, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_filling(lengths: np.ndarray, values: np.ndarray, capacity: int, most: np.ndarray | None = None) -> dict[int, int]:
    """Knapsack dynamic program: the multiset of length indexes of the largest value within ``capacity``.

    ``most`` bounds how often each length may occur; numbers are split into powers of two.
    """
    best = np.zeros(capacity + 1)
    items: list[tuple[int, int, np.ndarray]] = []
    for k, n in enumerate(lengths.tolist()):
        left = capacity // n if most is None else min(int(most[k]), capacity // n)
        unit = 1
        while left > 0:
            many = min(unit, left)
            w = n * many
            gain = best[: capacity + 1 - w] + values[k] * many
            better = gain > best[w:] + 1e-12
            np.copyto(best[w:], gain, where=better)
            items.append((k, many, better))
            left -= many
            unit *= 2
    out: dict[int, int] = {}
    c = capacity
    for k, many, better in reversed(items):
        w = int(lengths[k]) * many
        if c >= w and better[c - w]:
            out[k] = out.get(k, 0) + many
            c -= w
    return out


def fullest(lengths: list[int], counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Best fit for the longest length left: the fullest sequence that holds it, by a bounded subset-sum program."""
    longest = lengths[0]
    room = capacity - longest
    reach = 1  # bit c: a total of c is possible
    steps = []
    for n in lengths:
        if n > room:
            continue
        left = min(counts[n] - (n == longest), room // n)
        unit = 1
        while left > 0:  # binary splitting of the count
            take = min(unit, left)
            steps.append((n, take, reach))
            reach |= reach << (n * take)
            left -= take
            unit *= 2
        reach &= (1 << (room + 1)) - 1
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    out = {longest: 1}
    for n, take, before in reversed(steps):
        if not before >> total & 1:
            out[n] = out.get(n, 0) + take
            total -= n * take
    return out


Config = tuple[tuple[int, int], ...]  # ((length, number), ...)


def fractional(histogram: dict[int, int], p: PackParams) -> dict[Config, float]:
    """Configurations and how often to use them: the covering program by multiplicative weights.

    No configuration holds a length more often than there are pieces of it. The weights
    end when every length is covered, and the solution is scaled to the total length.
    """
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[n] for n in lengths.tolist()], np.int64)
    first = lengths * (1 + p.lean * lengths / p.capacity)  # short pieces fill any gap, so they are worth keeping
    cover = np.zeros(len(lengths))
    solution: dict[Config, float] = {}
    step = min(max(p.step[0], len(lengths) / 1200), p.step[1])  # few lengths, finer steps
    for _ in range(max(p.rounds, p.work // len(lengths))):
        values = first * np.exp(-p.eta * (cover - cover.min()))
        picked = best_filling(lengths, values, p.capacity, demand)
        x = step * min(demand[k] / a for k, a in picked.items())
        for k, a in picked.items():
            cover[k] += a * x / demand[k]
        key = tuple(sorted((int(lengths[k]), a) for k, a in picked.items()))
        solution[key] = solution.get(key, 0.0) + x
        if cover.min() >= 1:
            break
    total = sum(x * sum(n * a for n, a in key) for key, x in solution.items())
    return {key: x * float(lengths @ demand) / total for key, x in solution.items()}


def rounded(solution: dict[Config, float], left: dict[int, int], most: int):
    """(configuration, number of uses) within the pieces ``left``: whole uses first, then further ones by their fraction, up to ``most`` in all."""
    left = dict(left)

    def uses(key: Config, wanted: int) -> int:
        many = min([wanted, most - used, *(left[n] // a for n, a in key)])
        for n, a in key:
            left[n] -= a * many
        return many

    used = 0
    full = {key: sum(n * a for n, a in key) for key in solution}
    for key in sorted(solution, key=lambda key: (-full[key], key)):
        if (many := uses(key, int(solution[key]))) > 0:
            used += many
            yield key, many
    for key in sorted(solution, key=lambda key: (-full[key], -(solution[key] % 1), key)):
        if (many := uses(key, 1)) > 0:
            used += many
            yield key, many


def configurations(histogram: dict[int, int], p: PackParams = PackParams()) -> list[tuple[dict[int, int], int]]:
    """(lengths with their numbers in one sequence, number of such sequences), covering ``histogram`` exactly.

    Lengths that nothing fits beside are sequences of their own. The program is solved for
    the pieces, a share of its solution rounded to whole uses, and solved anew for the pieces
    left, so each sequence is priced for what is still there; the last ``tail`` sequences'
    worth of pieces is packed best fit.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    plan: list[tuple[dict[int, int], int]] = []

    def use(config: dict[int, int], many: int) -> None:
        plan.append((config, many))
        for n, a in config.items():
            left[n] -= a * many
            if not left[n]:
                del left[n]

    if left:
        shortest = min(left)
        for n in [n for n in left if n + shortest > p.capacity]:
            use({n: 1}, left[n])
    while (least := sum(n * c for n, c in left.items()) / p.capacity) > p.tail:
        for key, many in list(rounded(fractional(left, p), left, max(1, int(least * p.share)))):
            use(dict(key), many)
    while left:
        config = fullest(sorted(left, reverse=True), left, p.capacity)
        use(config, min(left[n] // a for n, a in config.items()))
    return plan


def places(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length: rows (first rank, number in a sequence, first sequence, offset), by first rank."""
    rank: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for config, many in plan:
        offset = 0
        for n, a in sorted(config.items(), reverse=True):
            out.setdefault(n, []).append((rank.get(n, 0), a, sequence, offset))
            rank[n] = rank.get(n, 0) + a * many
            offset += n * a
        sequence += many
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def pack(docs: DataFrame, p: PackParams = PackParams()) -> DataFrame:
    """Every piece with its sequence and its place there."""
    cut = written(pieces(docs, p), "pieces")
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(p.buckets)).cast("int"))
    sizes = written(cut.groupBy("length", "bucket").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows
    shared = docs.sparkSession.sparkContext.broadcast(places(configurations(histogram, p)))
    ahead = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    ranked = cut.withColumn("rank", F.row_number().over(within) - 1).join(firsts, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("first")).alias("rank"))

    def run(batches):
        slots = shared.value
        for batch in slices(batches):
            lengths, ranks = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for n in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == n)
                rows = slots[n][np.searchsorted(slots[n][:, 0], ranks[at], "right") - 1]
                k = ranks[at] - rows[:, 0]
                sequence[at] = rows[:, 2] + k // rows[:, 1]
                offset[at] = rows[:, 3] + k % rows[:, 1] * n
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return ranked.mapInArrow(run, schema)

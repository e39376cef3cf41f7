"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is a line of words: its documents in an order drawn by hash, each with the
interval of words that it fills. The line is cut into blocks of equal length, and the
source's target gives a quota of blocks: whole epochs, and the first blocks of one more
permutation for the rest. The quotas of all sources are the root of a tree over the output
shards. A node hands each child a fixed number of blocks; how many of them come from each
source is a multivariate-hypergeometric draw seeded by the node, so that the children's
quotas add up to the node's exactly and a shard is what a shuffle of all blocks would deal
to it. A shard's task walks from the root to its leaf by itself: it draws the splits on
the way, adds up what goes to its left, and so knows which stretch of every source's
permuted blocks is its own. The stretches of different shards are disjoint. The task puts
its blocks in a random order, and a join on (source, block) turns blocks into the parts of
documents that they hold.

A block holds ``block_words`` words, fewer in a source under a thousand blocks (one
thousandth of it, one word at least), more in a mix of over ``most_blocks`` blocks; a
source's taken words differ from its target by one block at most. No word is taken more
often than the target asks for, rounded up to whole epochs, hence ``most`` times at most.

Targets: sources in code point order, null last, weigh 5, 2, 1 and so on repeating; they
share the words of the whole table by weight; a target above ``most`` times its source
stops there and the excess is shared by weight among the others, until none is above.
The table of sources (a row each: name, words, target) is held by the driver and every
shard's task, like any table of mixing weights; nothing else is.

Edge cases: null and empty texts have no words and take part in nothing, but keep their
row; a null source is a source of its own; rows that are equal in all columns share their
order by chance of place, so results are the same as a table; an empty table gives an
empty mix. Columns other than doc_id, text and source are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import written

WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixParams:
    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 3  # epochs of a source at most
    block_words: int = 256
    shard_blocks: int = 2048  # blocks of an output shard, one more or less
    most_blocks: int = 2**29  # blocks in a mix, beyond that they get longer
    seed: int = 11


@dataclass(frozen=True)
class Source:
    """One row of the table of sources; ``draws`` blocks of ``block`` words out of ``blocks`` distinct ones."""

    name: str | None
    size: int
    target: float
    block: int
    blocks: int
    draws: int


def targets(sizes: list[int], weights: list[int], most: int) -> list[Fraction]:
    """Exact shares of all words by weight, none above ``most`` times its size."""
    out: list[Fraction | None] = [None] * len(sizes)
    left, open_ = Fraction(sum(sizes)), set(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        above = {i for i in open_ if left * weights[i] > total * most * sizes[i]}
        if not above:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in above:
            out[i] = Fraction(most * sizes[i])
        left -= sum(most * sizes[i] for i in above)
        open_ -= above
    return out  # type: ignore[return-value]


def plan(sizes: list[tuple[str | None, int]], p: MixParams) -> list[Source]:
    """The sources in order with their blocks and quotas."""
    rows = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    goal = targets([n for _, n in rows], [p.weights[i % len(p.weights)] for i in range(len(rows))], p.most)
    longest = max(p.block_words, -(-sum(n for _, n in rows) // p.most_blocks))
    out = []
    for (name, size), t in zip(rows, goal):
        block = max(1, min(longest, size // 1000))
        blocks = -(-size // block)
        epochs = int(t // size) if size else 0
        rest = round((t - epochs * size) / block)
        out.append(Source(name, size, float(t), block, blocks, min(p.most * blocks, epochs * blocks + min(rest, blocks))))
    return out


def n_shards(sources: list[Source], p: MixParams) -> int:
    return -(-sum(s.draws for s in sources) // p.shard_blocks)


def shard_stretches(shard: int, shards: int, quotas: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first draw, number of draws) of every source for one shard: the walk from the root to its leaf."""
    lo, hi, begin, have = 0, shards, np.zeros_like(quotas), quotas
    total = int(quotas.sum())
    cut = lambda k: k * total // shards  # noqa: E731  draws that go to shards before k
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng((seed, lo, hi))
        left = rng.multivariate_hypergeometric(have, cut(mid) - cut(lo), method="marginals")
        if shard < mid:
            hi, have = mid, left
        else:
            lo, begin, have = mid, begin + left, have - left
    return begin, have


def permuted(place: np.ndarray, n: int, key: int) -> np.ndarray:
    """A permutation of 0..n-1 applied to ``place``: a Feistel network of six rounds, walked until inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(1, 1 << 62, 12, dtype=np.uint64) | np.uint64(1)

    def once(x: np.ndarray) -> np.ndarray:
        a, b = x >> np.uint64(half), x & mask
        for mul, add in zip(keys[:6], keys[6:]):
            mixed = (b + add) * mul
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            a, b = b, a ^ ((mixed >> np.uint64(33)) & mask)
        return (a << np.uint64(half)) | b

    out = once(place.astype(np.uint64))
    while (far := out >= np.uint64(n)).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def shard_blocks(shard: int, shards: int, sources: list[Source], p: MixParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(source number, epoch, block) of one shard in its shuffled order."""
    begin, have = shard_stretches(shard, shards, np.array([s.draws for s in sources], np.int64), p.seed)
    number, epoch, block = [], [], []
    for i in np.flatnonzero(have).tolist():
        draw = np.arange(begin[i], begin[i] + have[i])
        turn = draw // sources[i].blocks
        for e in np.unique(turn).tolist():
            at = draw[turn == e] - e * sources[i].blocks
            block.append(permuted(at, sources[i].blocks, (p.seed << 40) + (i << 8) + e))
            epoch.append(np.full(len(at), e))
            number.append(np.full(len(at), i))
    order = np.random.default_rng((p.seed, shards, shard)).permutation(int(have.sum()))
    return tuple(np.concatenate(x)[order] if x else np.zeros(0, np.int64) for x in (number, epoch, block))  # type: ignore[return-value]


def lined_up(docs: DataFrame) -> DataFrame:
    """doc_id, source, text_key, size, at: each row's words and where they start in the line of its source.

    Rows are dealt by ranges of (source, hash), so a hot source has many tasks; a task adds
    up sizes within its range, and the sums of whole ranges (a row for each range and
    source) give where a range starts.
    """
    sized = docs.select(
        F.col("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("text_key"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORDS)), F.lit(0)).cast("bigint").alias("size"),
    ).withColumn("draw", F.xxhash64("doc_id", "text_key"))
    sized = written(sized, "sized").withColumn("chance", F.monotonically_increasing_id())  # only tells equal rows apart
    by = [F.col("source").asc_nulls_last(), "draw", "doc_id", "text_key", "chance"]
    ranges = sized.repartitionByRange(*by).sortWithinPartitions(*by).drop("draw", "chance")

    def run(batches):
        part, last, at = TaskContext.get().partitionId(), False, 0
        for batch in batches:
            names, sizes = batch.column("source").to_pylist(), batch.column("size").to_numpy()
            out = np.zeros(len(names), np.int64)
            edges = [i for i in range(len(names)) if (names[i - 1] if i else last) != names[i]]
            for i, j in zip([0, *edges], [*edges, len(names)]):
                if i < j:
                    at = 0 if i in edges else at
                    ends = at + np.cumsum(sizes[i:j])
                    out[i:j], at = ends - sizes[i:j], int(ends[-1])
            last = names[-1] if names else last
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out), pa.array(np.full(len(names), part, np.int32))], [*batch.schema.names, "at", "part"])

    rows = written(ranges.mapInArrow(run, StructType([*ranges.schema, StructField("at", LongType()), StructField("part", IntegerType())])), "lines")
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("n"))
    # a row for each task of the range sort and source: as few as tasks, whatever the rows
    before = F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(F.col("source").alias("of"), F.col("part").alias("in"), F.coalesce(before, F.lit(0)).alias("before"))
    joined = rows.join(parts, rows.source.eqNullSafe(parts["of"]) & (rows.part == parts["in"]))
    return joined.select("doc_id", "source", "text_key", "size", (F.col("at") + F.col("before")).alias("at"))


def sources_of(lines: DataFrame, p: MixParams) -> list[Source]:
    return plan([(r.source, r.n) for r in lines.groupBy("source").agg(F.sum("size").alias("n")).collect()], p)


def mixed(lines: DataFrame, sources: list[Source], p: MixParams = MixParams()) -> DataFrame:
    """The mix: shard, place (of a block in it), number (of the source), epoch, doc_id, text_key, at, start, length.

    A row is a part of one document: ``length`` words from word ``start`` on; ``at`` is the
    document's place in its source's line. A shard's order is place, at.
    """
    spark, shards = lines.sparkSession, n_shards(sources, p)

    def draw(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                number, epoch, block = shard_blocks(shard, shards, sources, p)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(block), shard)), pa.array(np.arange(len(block))), pa.array(number), pa.array(epoch), pa.array(block)], ["shard", "place", "number", "epoch", "block"])

    tasks = max(1, min(shards, spark.sparkContext.defaultParallelism * 4))
    draws = spark.range(0, shards, 1, tasks).mapInArrow(draw, "shard bigint, place bigint, number bigint, epoch bigint, block bigint")
    table = spark.createDataFrame([(s.name, i, s.block) for i, s in enumerate(sources)], "of string, number bigint, words bigint")
    words = lines.where("size > 0").join(table, F.col("source").eqNullSafe(F.col("of")))
    parts = words.withColumn("block", F.explode(F.expr("sequence(at div words, (at + size - 1) div words)")))
    first, last = F.greatest("at", F.expr("block * words")), F.least(F.expr("at + size"), F.expr("(block + 1) * words"))
    parts = parts.select("number", "block", "doc_id", "text_key", "at", (first - F.col("at")).alias("start"), (last - first).alias("length"))
    # made rows have no size that Spark could know: no broadcast of what grows with the mix
    return draws.hint("merge").join(parts, ["number", "block"]).select("shard", "place", "number", "epoch", "doc_id", "text_key", "at", "start", "length")


def mixed_texts(docs: DataFrame, p: MixParams = MixParams()) -> DataFrame:
    """The mix with its words: shard, place, at, doc_id, source number, text (the part's words, one space between them)."""
    lines = lined_up(docs)
    mix = mixed(lines, sources_of(lines, p), p)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").alias("of"), text.alias("text")).distinct()
    texts = texts.withColumn("key", F.md5(F.col("text").cast("binary")))
    words = F.slice(F.regexp_extract_all("text", F.lit(WORDS), F.lit(0)), F.col("start") + 1, F.col("length"))
    joined = mix.join(texts, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("key")))
    return joined.select("shard", "place", "at", "doc_id", "number", F.array_join(words, " ").alias("text"))


def taken(docs: DataFrame, p: MixParams = MixParams()) -> DataFrame:
    """doc_id, size, source_size, target, taken, source: the words that the mix takes of each row, repeats counted."""
    lines = lined_up(docs)
    sources = sources_of(lines, p)
    spark = docs.sparkSession
    got = mixed(lines, sources, p).groupBy("number", "at").agg(F.sum("length").alias("taken"))
    table = spark.createDataFrame([(s.name, i, s.size, s.target) for i, s in enumerate(sources)], "of string, number bigint, source_size bigint, target double")
    rows = lines.join(table, F.col("source").eqNullSafe(F.col("of")))
    full = rows.where("size > 0").join(got.hint("merge"), ["number", "at"], "left")
    empty = rows.where("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
    out = ["doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"), "source"]
    return full.select(out).union(empty.select(out))

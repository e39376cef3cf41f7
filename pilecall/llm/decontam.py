"""Benchmark decontamination: BM25 over benchmark items with block-max WAND.

The benchmark items are the indexed side. Every document is cut into overlapping
passages, and every passage is a query against the index: all items whose BM25 score
reaches ``threshold`` of the item's own score are retrieved, none is missed. Scores are
divided by the item's own score, so one threshold serves all items. Document frequencies,
the mean length and the passage length are those of the whole benchmark, whatever the
shards.

Retrieval moves over a passage's terms from the most common one on. As long as the largest
scores of the terms so far add up to less than ``skip`` of the threshold, no item can come
near it by them alone: their posting lists, the longest ones, are skipped. The term that
crosses it is the pivot; the block lists of the pivot and of the rarer terms behind it give
the blocks to look at, each with its block maxima plus what the skipped terms can add at
most. Only items in blocks whose bound reaches the threshold are scored, exactly and with
all terms. All passages of a document take these steps together. A retrieved item is a leak if the passage and its surroundings hold enough of the
word trigrams both of the item's question (all lines but the last) and of its answer (the
last line; see ``question_and_answer``). Items of under ``least_words`` words are no queries
for BM25: they leak where their words stand in the text in a row.

A passage is twice as long as the longest item and starts every half passage, so each
occurrence of an item lies within one passage. An item of over ``item_words`` words is
indexed as several, each under its identifier, so that all its words count. Shards of about
``shard_items`` items are indexed by Spark tasks; the driver hands on one built shard at a
time as a broadcast, and with several shards the documents are written down in between, so
that a task holds one index.

Edge cases: null or empty texts have no passage; items without words (null and empty ones)
name no leak; repeated rows repeat their results, repeated items do not; a null identifier
stays null; without items there are no leaks.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, written

WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class DecontamParams:
    threshold: float = 0.6  # of an item's own score
    overlap: float = 0.6  # of the question's and of the answer's trigrams
    k1: float = 1.2
    b: float = 0.75
    skip: float = 0.4  # of the threshold: what the common terms whose lists are skipped can add at most
    block: int = 4  # items in a block of a posting list
    least_words: int = 4
    item_words: int = 2000
    shard_items: int = 20_000
    together: int = 64  # passages of a document that are looked up at once


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def grams(words: list[str], n: int = 3) -> set[tuple[str, ...]]:
    """Distinct word trigrams; of fewer words, the words as one."""
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of all lines but the last, and of the last; halves where one of them has under three words."""
    lines = [x for x in (words_of(line) for line in text.split("\n")) if x]
    words = [w for line in lines for w in line]
    cut = len(words) - len(lines[-1]) if lines else 0
    if min(cut, len(words) - cut) < 3:
        cut = len(words) // 2
    return words[:cut], words[cut:]


def overlap(part: list[str], near: list[str]) -> float:
    """Share of the part's distinct trigrams (or of its whole, if shorter) that occur in ``near``."""
    sought = grams(part)
    return len(sought & grams(near, min(3, len(part)))) / len(sought) if sought else 1.0


@dataclass(frozen=True)
class Stats:
    """What scores need to know of the whole benchmark: parts, words of a part on average, and of the longest."""

    parts: int
    mean: float
    longest: int


def parts_of(text: str | None, p: DecontamParams) -> list[list[str]]:
    """An item's words in parts of at most ``item_words``; none if the item is too short for BM25."""
    words = words_of(text)
    return [words[at : at + p.item_words] for at in range(0, len(words), p.item_words)] if len(words) >= p.least_words else []


class Index:
    """Posting lists in blocks with block maxima, all scores as shares of the item's own score.

    Terms are numbered from the most common one on. ``df`` and ``stats`` are those of the
    whole benchmark; without them the items are taken to be the whole.
    """

    def __init__(self, items: list[tuple[int | None, str | None]], p: DecontamParams, df: dict[str, int] | None = None, stats: Stats | None = None):
        self.p = p
        parts = [(item, words, question_and_answer(text)) for item, text in items for words in parts_of(text, p)]
        if df is None:
            df = Counter(t for _, words, _ in parts for t in set(words))
        if stats is None:
            stats = Stats(len(parts), sum(len(w) for _, w, _ in parts) / max(1, len(parts)), max((len(w) for _, w, _ in parts), default=1))
        self.ids = [item for item, _, _ in parts]
        self.checks = [whole for _, _, whole in parts]
        self.longest = stats.longest
        self.reach = max((len(q) + len(a) for _, _, (q, a) in parts), default=1)
        self.short: dict[tuple[str, ...], list] = {}
        for item, text in items:
            words = tuple(words_of(text))
            if 0 < len(words) < p.least_words:
                self.short.setdefault(words, []).append(item)
        own_terms = {t for _, words, _ in parts for t in words}
        self.terms = {t: i for i, t in enumerate(sorted(own_terms, key=lambda t: (-df[t], t)))}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for k, (_, words, _) in enumerate(parts):
            norm = p.k1 * (1 - p.b + p.b * len(words) / stats.mean)
            tf = Counter(words)
            score = {t: math.log(1 + (stats.parts - df[t] + 0.5) / (df[t] + 0.5)) * n * (p.k1 + 1) / (n + norm) for t, n in tf.items()}
            own = sum(score.values())
            for t, s in score.items():
                postings[self.terms[t]].append((k, s / own))
        self.top = np.array([max(s for _, s in x) for x in postings] or [0.0])
        self.starts = np.cumsum([0, *map(len, postings)])
        self.items = np.array([k for x in postings for k, _ in x], np.int64)
        self.scores = np.array([s for x in postings for _, s in x])
        blocks = [sorted((b, max(s for k, s in x if k // p.block == b)) for b in {k // p.block for k, _ in x}) for x in postings]
        self.block_starts = np.cumsum([0, *map(len, blocks)])
        self.blocks = np.array([b for x in blocks for b, _ in x], np.int64)
        self.block_tops = np.array([s for x in blocks for _, s in x])
        self.n_blocks = len(parts) // p.block + 1

    @staticmethod
    def gather(starts: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all list entries of ``terms``, and which of the terms each one is of."""
        sizes = starts[terms + 1] - starts[terms]
        ends = np.cumsum(sizes)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[terms] - (ends - sizes), sizes), np.repeat(np.arange(len(terms)), sizes)

    def retrieve(self, passage: np.ndarray, term: np.ndarray) -> list[tuple[int, int, float]]:
        """(passage, item, score) wherever a passage's distinct terms reach the threshold.

        The pairs are in order of (passage, term); passages count from 0.
        """
        least = self.p.threshold - 1e-9
        if not len(term):
            return []
        top = self.top[term]
        ends = np.cumsum(top)
        edges = np.concatenate(([0], np.flatnonzero(passage[1:] != passage[:-1]) + 1, [len(term)]))
        ends -= np.repeat((ends - top)[edges[:-1]], edges[1:] - edges[:-1])
        behind = ends >= self.p.skip * least  # the pivot and the terms behind it
        if not (ends >= least).any():
            return []
        n = int(passage[-1]) + 1
        skipped = np.bincount(passage[~behind], top[~behind], n)
        at, of = self.gather(self.block_starts, term[behind])
        cell = passage[behind][of] * self.n_blocks + self.blocks[at]
        bounds = np.bincount(cell, self.block_tops[at], n * self.n_blocks).reshape(n, -1)
        pivots = (bounds > 0) & (bounds + skipped[:, None] >= least)
        hit = pivots.any(axis=1)
        if not hit.any():
            return []
        mine = hit[passage]
        at, of = self.gather(self.starts, term[mine])
        who = passage[mine][of]
        inside = pivots[who, self.items[at] // self.p.block]
        at, who = at[inside], who[inside]
        pairs, number = np.unique(who * len(self.ids) + self.items[at], return_inverse=True)
        scores = np.bincount(number, self.scores[at])
        return [(int(x // len(self.ids)), int(x % len(self.ids)), float(s)) for x, s in zip(pairs[scores >= least], scores[scores >= least])]

    def leaks(self, text: str | None) -> list[tuple[int | None, int, float, float, float]]:
        """(item, first word of the passage, score, question overlap, answer overlap), the best passage of each item."""
        words = words_of(text)
        found = self.short_leaks(words) if self.short else []
        get = self.terms.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        at = np.flatnonzero(ids >= 0)
        if not len(at):
            return found
        ids, half = ids[at], self.longest
        # every place lies in two passages; passage k holds the halves k and k + 1, and a term once
        part = at // half + 1
        size = len(self.terms)
        pairs = np.concatenate((part * size + ids, (part - 1) * size + ids))
        pairs.sort()
        pairs = np.concatenate((pairs[:1], pairs[1:][pairs[1:] != pairs[:-1]]))
        passage, term = np.divmod(pairs, size)
        best: dict = {}
        for lo in range(int(passage[0]), int(passage[-1]) + 1, self.p.together):
            i, j = np.searchsorted(passage, (lo, lo + self.p.together))
            for k, item, score in self.retrieve(passage[i:j] - lo, term[i:j]):
                first = max(0, (k + lo - 1) * half)
                near = words[max(0, first - self.reach) : (k + lo + 1) * half + self.reach]
                q, a = (overlap(part, near) for part in self.checks[item])
                if q >= self.p.overlap and a >= self.p.overlap:
                    key = self.ids[item] if self.ids[item] is not None else ("null", item)
                    best[key] = max(best.get(key, (0.0,)), (score, -first, q, a, item))  # parts of one item count once
        return found + [(self.ids[item], -at, score, q, a) for score, at, q, a, item in sorted(best.values(), key=lambda x: x[-1])]

    def short_leaks(self, words: list[str]) -> list[tuple[int | None, int, float, float, float]]:
        """Items of few words: their first occurrence, word by word."""
        first: dict[tuple[str, ...], int] = {}
        for n in sorted({len(x) for x in self.short}):
            for i in range(len(words) - n + 1):
                if (gram := tuple(words[i : i + n])) in self.short:
                    first.setdefault(gram, i)
        return [(item, i, 1.0, 1.0, 1.0) for gram, i in first.items() for item in self.short[gram]]


def shards(benchmark: DataFrame, p: DecontamParams):
    """The benchmark's index in parts of bounded size, each built by a Spark task with the statistics of the whole."""
    rows = benchmark.select(F.col("item_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()

    def split(batches):
        for batch in slices(batches):
            out = [(i, t, words_of(t)) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            out = [(i, t, len(w), [[len(x), sorted(set(x))] for x in parts_of(t, p)]) for i, t, w in out if w]
            yield pa.RecordBatch.from_pylist([{"item_id": i, "text": t, "parts": [{"n": n, "terms": x} for n, x in parts]} for i, t, _, parts in out], schema)

    schema = pa.schema([("item_id", pa.int64()), ("text", pa.string()), ("parts", pa.list_(pa.struct([("n", pa.int64()), ("terms", pa.list_(pa.string()))])))])
    rows = written(rows.mapInArrow(split, "item_id bigint, text string, parts array<struct<n: bigint, terms: array<string>>>"), "items")
    each = rows.select(F.explode("parts").alias("part"))
    whole = each.agg(F.count("*").alias("parts"), F.avg("part.n").alias("mean"), F.max("part.n").alias("longest")).first()
    stats = Stats(whole["parts"], whole["mean"] or 1.0, whole["longest"] or 1)
    items = rows.count()
    if not items:
        return
    n = -(-items // p.shard_items)
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    df = each.select(F.explode("part.terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    named = rows.select(F.col("shard").alias("of"), F.explode("parts").alias("part")).select("of", F.explode("part.terms").alias("term")).distinct().join(df, "term")

    def build(key, own, frequencies):
        own = own.sort_values(["item_id", "text"], na_position="last")
        items = [(None if i != i or i is None else int(i), t) for i, t in zip(own["item_id"], own["text"])]
        index = Index(items, p, dict(zip(frequencies["term"], frequencies["df"].astype(int))), stats)
        return type(own)({"shard": [key[0]], "index": [pickle.dumps(index)]})

    # a group is one shard: bounded by shard_items items of any text length
    built = rows.select("shard", "item_id", "text").groupBy("shard").cogroup(named.groupBy("of")).applyInPandas(build, "shard bigint, index binary")
    built = written(built, "index")
    for shard in range(n):
        for row in built.where(F.col("shard") == shard).select("index").collect():
            yield pickle.loads(row["index"])


HIT = "array<struct<item_id:bigint,at:bigint,score:double,question:double,answer:double>>"


def with_leaks(docs: DataFrame, benchmark: DataFrame, p: DecontamParams = DecontamParams(), name: str = "leaks") -> DataFrame:
    """``docs`` with a column of the benchmark items that each text holds (a column of this name is replaced)."""
    out = docs.drop(name).withColumn(name, F.expr(f"cast(array() as {HIT})"))
    for number, index in enumerate(shards(benchmark, p)):
        if number:  # a task holds one shard's index
            out = written(out, "scanned")
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            index = shared.value
            for batch in slices(batches):
                old = batch.column(name)
                hits = [
                    (had or []) + [dict(zip(("item_id", "at", "score", "question", "answer"), x)) for x in index.leaks(t)]
                    for had, t in zip(old.to_pylist(), batch.column("text").to_pylist())
                ]
                yield batch.set_column(batch.schema.get_field_index(name), name, pa.array(hits, old.type))

        out = out.mapInArrow(run, out.schema)
    return out


def leaked_items(docs: DataFrame, benchmark: DataFrame, p: DecontamParams = DecontamParams()) -> DataFrame:
    """doc_id, item_id, at (first word of the passage), score, question, answer: one row per document and item it holds."""
    found = with_leaks(docs.select("doc_id", "text"), benchmark, p).select("doc_id", F.explode("leaks").alias("leak"))
    return found.select("doc_id", "leak.*")


def keep_unleaked(docs: DataFrame, benchmark: DataFrame, p: DecontamParams = DecontamParams()) -> DataFrame:
    """Documents that hold no benchmark item; columns unchanged."""
    found = with_leaks(docs, benchmark, p, "leaks found")
    return found.where(F.size("leaks found") == 0).select(docs.columns)

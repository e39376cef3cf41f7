import collections
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pilecall.llm import mixing as M
from pilecall.llm.common import table

from .edge import SF, docs_of, empty_docs, odd_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights, most):
    """One source after the other stops at its limit, the one that is furthest above it first."""
    fixed = {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = Fraction(sum(sizes)) - sum(fixed.values())
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if share[i] > most * sizes[i]]
        if not over:
            return [float(fixed.get(i, share.get(i))) for i in range(len(sizes))]
        worst = max(over, key=lambda i: share[i] / sizes[i] if sizes[i] else float("inf"))
        fixed[worst] = Fraction(most * sizes[worst])


def test_targets():
    rng = np.random.default_rng(1)
    for _ in range(200):
        sizes = (rng.integers(0, 2000, rng.integers(1, 12)) ** rng.integers(1, 3)).tolist()
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        got = [float(t) for t in M.targets(sizes, weights, 3)]
        assert got == pytest.approx(brute_targets(sizes, weights, 3))
        assert sum(got) == pytest.approx(sum(sizes))


def test_permutation_and_stretches_are_whole():
    for n in (1, 2, 3, 10, 1000, 4097):
        assert sorted(M.permuted(np.arange(n), n, n + 5).tolist()) == list(range(n))
    quotas = np.array([0, 7, 1000, 3, 4321, 0, 55])
    for shards in (1, 2, 7, 32):
        parts = [M.shard_stretches(s, shards, quotas, 3) for s in range(shards)]
        assert sum(h for _, h in parts).tolist() == quotas.tolist()
        assert {int(h.sum()) - quotas.sum() // shards for _, h in parts} <= {0, 1}
        for i in range(len(quotas)):  # disjoint and without gaps, in the order of the shards
            assert [int(b[i]) for b, _ in parts] == np.cumsum([0, *(int(h[i]) for _, h in parts)])[:-1].tolist()


def test_splits_follow_the_hypergeometric_law():
    """The first of two shards gets each source's share on average, with the variance of draws without replacement."""
    quotas = np.array([300, 100, 600])
    got = np.array([M.shard_stretches(0, 2, quotas, seed)[1] for seed in range(2000)])
    assert got.mean(axis=0) == pytest.approx(quotas / 2, rel=0.02)
    k, total = 500, 1000
    want = [k * q / total * (1 - q / total) * (total - k) / (total - 1) for q in quotas]
    assert got.var(axis=0) == pytest.approx(want, rel=0.15)


def check(docs, got, p=M.MixParams()):
    """Contract against the texts: sizes, targets, totals near targets, limits."""
    size = lambda t: len(WORD.findall(t or ""))
    assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((r.doc_id, size(r.text)) for r in docs)
    totals = collections.Counter()
    for r in docs:
        totals[r.source] += size(r.text)
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, brute_targets([totals[s] for s in order], [p.weights[i % 3] for i in range(len(order))], 3)))
    words = collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        assert r.source_size == totals[r.source] and r.target == pytest.approx(goal[r.source])
        words[r.source] += r.taken
    for s in order:  # one block of the source at most
        assert abs(words[s] - goal[s]) <= max(1, min(p.block_words, totals[s] // 1000))


def test_mix_of_the_table(spark):
    docs = table(spark, SF, "documents")
    got = M.taken(docs).collect()
    check(docs.select("doc_id", "text", "source").collect(), got)
    again = M.taken(docs.repartition(5, "n_chars")).collect()
    assert sorted(got, key=repr) == sorted(again, key=repr)


def test_blocks_are_disjoint_and_texts_come_out(spark):
    docs = spark.createDataFrame([(i, " ".join(f"{i}.{k}" for k in range(i % 37)), None, "abc"[i % 3] if i % 3 else None, 0) for i in range(200)], empty_docs(spark).schema)
    p = M.MixParams(block_words=4, shard_blocks=50)
    lines = M.lined_up(docs)
    sources = M.sources_of(lines, p)
    mix = M.mixed(lines, sources, p).collect()
    words = collections.Counter((r.number, r.epoch, r.at + r.start + k) for r in mix for k in range(r.length))
    assert max(words.values()) == 1  # a word comes once in an epoch
    per_shard = collections.Counter(r.shard for r in {(r.shard, r.place): r for r in mix}.values())
    assert max(per_shard.values()) - min(per_shard.values()) <= 1
    shards = collections.defaultdict(list)
    for r in mix:
        shards[r.shard].append((r.place, r.number))
    assert any(sorted(x, key=lambda y: y[1]) != sorted(x) for x in shards.values())  # shuffled, not source by source
    texts = M.mixed_texts(docs, p).collect()
    out = collections.Counter(w for r in texts for w in r.text.split())
    taken = collections.Counter()
    for r in M.taken(docs, p).collect():
        taken[r.doc_id] += r.taken
    back = collections.Counter()
    for w, n in out.items():
        back[int(w.split(".")[0])] += n
    assert back == +taken and max(out.values()) <= 3


def test_hot_source_and_ties(spark):
    """A third of all rows is one row, repeated; equal rows share what the mix takes of their source."""
    rows = [(7, "the same words again", None, "hot", 0)] * 300 + [(i, f"text {i} of a source", None, f"s{i % 40:02d}", 0) for i in range(600)]
    docs = spark.createDataFrame(rows, empty_docs(spark).schema)
    check(docs.collect(), M.taken(docs).collect())


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumn("size", F.col("text")).withColumn("at", F.lit(None).cast("string"))
    got = M.taken(docs).collect()
    check(docs.select("doc_id", "text", "source").collect(), got)
    assert M.taken(empty_docs(spark)).collect() == []
    only_empty = M.taken(docs_of(spark, {1: "", 2: None})).collect()
    assert [(r.size, r.target, r.taken) for r in only_empty] == [(0, 0.0, 0)] * 2

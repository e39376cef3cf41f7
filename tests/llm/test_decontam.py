import collections
import math
import random

import numpy as np
import pytest

from pilecall.llm import decontam as D
from pilecall.llm.common import table

from .edge import SF, docs_of, empty_docs, odd_docs


def bm25(items, k1=1.2, b=0.75):
    """Scores of (item, term) as shares of the item's own score, from the formula."""
    words = {i: D.words_of(t) for i, t in items}
    mean = sum(map(len, words.values())) / len(words)
    out = {}
    for i, ws in words.items():
        for t in set(ws):
            n, tf = sum(t in w for w in words.values()), ws.count(t)
            idf = math.log(1 + (len(words) - n + 0.5) / (n + 0.5))
            out[i, t] = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(ws) / mean))
    own = collections.Counter()
    for (i, _), s in out.items():
        own[i] += s
    return {(i, t): s / own[i] for (i, t), s in out.items()}


def test_retrieval_misses_no_item_above_the_threshold():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, [60 - k for k in range(60)], k=rng.randrange(4, 30)))) for i in range(40)]
    formula = bm25(items)
    p = D.DecontamParams(threshold=0.5, block=4)
    index = D.Index(items, p)
    found = 0
    for _ in range(30):
        passages = [set(rng.choices(vocabulary, k=rng.randrange(1, 30)) + D.words_of(rng.choice(items)[1])[: rng.randrange(30)]) for _ in range(rng.randrange(1, 5))]
        pairs = sorted((k, index.terms[w]) for k, words in enumerate(passages) for w in words if w in index.terms)
        got = {(k, index.ids[i]): s for k, i, s in index.retrieve(*(np.array(x) for x in zip(*pairs)))}
        want = {(k, i): s for k, words in enumerate(passages) for i, _ in items if (s := sum(formula.get((i, w), 0) for w in words)) >= p.threshold}
        assert got == pytest.approx(want)
        found += len(want)
    assert found > 30


def test_shards_share_the_statistics_of_the_whole(spark):
    """Scores are the same however many items a shard holds, and equal the formula over all items."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = {i: " ".join(rng.choices(vocabulary, k=rng.randrange(6, 40))) + "\n" + " ".join(rng.choices(vocabulary, k=4)) for i in range(7)}
    items = spark.createDataFrame(list(texts.items()) + [(100, "exactly this one"), (101, "x y")], "item_id bigint, text string")
    docs = docs_of(spark, {i: f"before {texts[i]} after" for i in range(0, 7, 3)} | {77: "so exactly THIS one it is", 78: "exactly one this", 79: "x y"})
    results = []
    for size in (1, 4, 1000):
        rows = D.leaked_items(docs, items, D.DecontamParams(shard_items=size)).collect()
        results.append(sorted((r.doc_id, r.item_id, r["at"], round(r.score, 9), r.question, r.answer) for r in rows))
    assert results[0] == results[1] == results[2]
    assert {(d, i) for d, i, *_ in results[0]} >= {(i, i) for i in range(0, 7, 3)} | {(77, 100), (79, 101)}
    assert not [x for x in results[0] if x[0] == 78]
    formula = bm25(list(texts.items()))
    for d, i, at, score, *_ in results[0]:
        if i < 100:
            whole = set(D.words_of(f"before {texts[d]} after"))
            assert score <= sum(s for (k, t), s in formula.items() if k == i and t in whole) + 1e-6


def test_whole_items_are_found_wherever_they_stand():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(8, 60))) + "\n" + " ".join(rng.choices(vocabulary, k=5))) for i in range(50)]
    index = D.Index(items, D.DecontamParams())
    for item, text in items:
        before, after = (" ".join(rng.choices(vocabulary, k=rng.randrange(200))) for _ in range(2))
        hits = index.leaks(f"{before} {text.upper()} {after}")
        assert item in [h[0] for h in hits]
        question_only = text.split("\n")[0]
        assert item not in [h[0] for h in index.leaks(f"{before} {question_only} {after}")]


def test_leaks_of_the_table(spark):
    """Every document that holds an item's whole text is found, and no document without half of its 5-grams."""
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    got = {(r.doc_id, r.item_id) for r in D.leaked_items(docs, items).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    sought = {r.item_id: r.text for r in items.collect()}
    assert got >= {(d, i) for d, t in texts.items() for i, s in sought.items() if s in t and len(D.words_of(s)) >= 4}
    for d, i in got:
        assert len(D.grams(D.words_of(sought[i]), 5) & D.grams(D.words_of(texts[d]), 5)) >= 0.5 * len(D.grams(D.words_of(sought[i]), 5))


def test_short_answers_and_shards(spark):
    items = spark.createDataFrame([(1, "who wrote the long book about whales and the sea\nMelville"), (2, None), (3, ""), (None, "alpha beta gamma delta epsilon zeta")], "item_id bigint, text string")
    docs = docs_of(spark, {1: "x y who wrote the long book about whales and the sea Melville z", 2: "alpha beta gamma delta epsilon zeta", 3: "nothing here"})
    for size in (1, 100):
        rows = D.leaked_items(docs, items, D.DecontamParams(shard_items=size)).collect()
        assert sorted((r.doc_id, r.item_id) for r in rows if r.item_id) == [(1, 1)]
        assert [r.doc_id for r in rows if r.item_id is None] == [2]


def test_odd_rows(spark):
    items = table(spark, SF, "benchmark")
    docs = odd_docs(spark)
    assert D.leaked_items(docs, items).count() == 0
    kept = D.keep_unleaked(docs, items)
    assert kept.columns == docs.columns and kept.count() == 8
    assert D.leaked_items(empty_docs(spark), items).count() == 0
    assert D.keep_unleaked(docs, items.limit(0)).count() == 8

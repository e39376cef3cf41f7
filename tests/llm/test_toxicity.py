import random

import numpy as np
import pytest

from pilecall.llm import toxicity as T
from pilecall.llm.common import table

from .edge import docs_of, empty_docs, odd_docs

SMALL = T.ToxicParams(window=6, buckets=64, width=3, hidden=2)


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = T.Network(SMALL)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x = rng.standard_normal((5, 4, 3))
    mask = np.arange(5)[:, None] < np.array([5, 3, 1, 4])
    y = np.array([1.0, 0.0, 1.0, 0.0])
    _, g, dx = net.gradients(x, mask, y)
    for name in g:
        for spot in list(np.ndindex(net.w[name].shape))[:12]:
            old, loss = net.w[name][spot], []
            for step in (1e-4, -1e-4):
                net.w[name][spot] = old + step
                loss.append(net.gradients(x, mask, y)[0])
            net.w[name][spot] = old
            assert g[name][spot] == pytest.approx((loss[0] - loss[1]) / 2e-4, abs=2e-4), name
    for spot in [(0, 0, 1), (4, 0, 2), (2, 1, 0)]:
        old, loss = x[spot], []
        for step in (1e-4, -1e-4):
            x[spot] = old + step
            loss.append(net.gradients(x, mask, y)[0])
        x[spot] = old
        assert dx[spot] == pytest.approx((loss[0] - loss[1]) / 2e-4, abs=2e-4)


def test_every_window_is_scored():
    """The score of a text is that of its largest window, taken one by one."""
    net, rng = T.Network(SMALL), random.Random(1)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyzuvw"]
    for n in (1, 2, 3, 5, 6, 7, 9, 12, 40):
        text = [rng.choice(words) for _ in range(n)]
        starts = T.windows_of(n, 6)
        covered = {i for s in starts for i in range(s, min(n, s + 6))}
        assert covered == set(range(n))
        logits = []
        for s in starts:
            x = net.inputs(text[s : s + 6])[0][:, None, :]
            logits.append(float(net.logits(net.projected(x), np.ones(x.shape[:2], bool))[0]))
        got = T.Scorer(net).scores([" ".join(text), None, "", "12 34"])
        assert got[0] == pytest.approx(T.sigmoid(max(logits)), abs=1e-5)
        assert got[1:].tolist() == [0.0, 0.0, 0.0]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = T.toxicity(docs.join(labels, "doc_id", "left_semi"), labels).join(labels, "doc_id").where("held_out").toPandas()
    found = got.predicted == 1
    assert (got.toxic[found] == 1).mean() > 0.8 and found[got.toxic == 1].mean() > 0.8
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == found).all()


def test_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1, 1), (6, 1, 0), (None, 1, 1), (7, None, None), (1, 1, 1), (5, 1, 1)], "doc_id bigint, quality int, toxic int")
    rows = T.toxicity(odd_docs(spark), labels).collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    assert [r.score for r in rows if r.doc_id in (1, 2, 3, 7)] == [0.0] * 4
    assert T.toxicity(empty_docs(spark), labels).count() == 0
    unlabelled = T.toxicity(docs_of(spark, {1: "some words"}), labels.limit(0)).collect()
    assert [(r.score, r.predicted) for r in unlabelled] == [(0.0, 0)]


def test_sampled_rows_are_whole(spark):
    """A passage at the end of a long row is part of the training and of the calibration."""
    texts = {i: "plain words " * 1500 + f"end{i}" for i in range(20)}
    labels = spark.createDataFrame([(i, 1, i % 2) for i in texts], "doc_id bigint, quality int, toxic int")
    rows, odds = T.training_sample(docs_of(spark, texts), labels, T.ToxicParams())
    assert rows and all(len(t) > 18_000 and t in texts.values() for t, _ in rows) and odds > 0

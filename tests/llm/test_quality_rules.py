import random
import re

import numpy as np
import pytest

from pilecall.llm import quality_rules as Q
from pilecall.llm.common import table

from .edge import SF, docs_of, empty_docs, odd_docs


def brute_force(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n, repeat = len(words), len(covered)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, repeat, n < 10 or 100 * repeat > 20 * n)


def check(docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = Q.verdicts(docs).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert tuple(r)[1:7] == brute_force(texts[r.doc_id]), r
        assert not (r.base_failed and r.kept)


def test_made_texts(spark):
    rng = random.Random(4)
    bits = ["a ", "b ", "c ", "d\n", "e\t", "  ", "é ", "|# ", "\x1c", " ", "\x85", "\r\n", "x y z w v "]
    check(docs_of(spark, {i: "".join(rng.choices(bits, k=rng.randrange(0, 40))) for i in range(300)}))


def test_table(spark):
    check(table(spark, SF, "documents").where("n_chars < 4000"))


def test_estimation_finds_the_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(40000) < 0.7
    accuracies = np.array([0.95, 0.9, 0.8, 0.7, 0.6])
    votes = np.where(rng.random((40000, 5)) < accuracies, 1, -1) * np.where(truth, 1, -1)[:, None]
    votes[rng.random((40000, 5)) < 0.2] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    found = Q.estimate(patterns.astype(float), counts.astype(float), Q.QualityParams())
    good, bad = found.weights()
    odds = np.log(accuracies / (1 - accuracies))
    assert found.prior == pytest.approx(0.7, abs=0.03)
    assert good == pytest.approx(odds, abs=0.25) and bad == pytest.approx(-odds, abs=0.25)


def test_verdicts_follow_the_labels(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    got = Q.verdicts(docs).join(labels.selectExpr("doc_id", "quality as label"), "doc_id").toPandas()
    assert got.kept[got.label == 1].mean() > 0.95
    assert got.kept[got.label == 0].mean() < 0.5


def test_odd_rows(spark):
    rows = Q.verdicts(odd_docs(spark)).collect()
    assert len(rows) == 8
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3, 7))
    assert Q.verdicts(empty_docs(spark)).count() == 0


def test_variety_has_no_length_switch(spark):
    """Few distinct words are no sign of quality at any length; many are one at any length."""
    few = {n: " ".join(f"word{k * 7 % 10}" for k in range(n)) for n in (300, 900, 1100, 5000)}
    many = {n + 1: " ".join(f"word{k}" for k in range(n)) for n in (300, 900, 1100, 5000)}
    rules = Q.default_rules()
    rows = Q.features(docs_of(spark, few | many)).withColumn("vote", rules["variety"]).select("doc_id", "vote").collect()
    assert {r.doc_id: r.vote for r in rows} == {n: -1 for n in few} | {n: 1 for n in many}

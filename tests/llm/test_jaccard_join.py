import random

import numpy as np
import pytest

from pilecall.llm import jaccard_join as J
from pilecall.llm.common import table

from .edge import SF, docs_of, empty_docs, odd_docs


def word_shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    # only ASCII white space separates words here; the fixtures hold no other kind
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_force(rows):
    """doc_id -> (set size, smallest identifier reachable), every pair compared."""
    sets = [(d, word_shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                inter = len(x & y)
                if 100 * inter >= 75 * (len(x) + len(y) - inter):
                    a2, b2 = root(a), root(b)
                    parent[max(a2, b2)] = min(a2, b2)
    return {d: (len(x), root(d)) for d, x in sets}


def got_of(docs, p=J.JoinParams()):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicates(docs, p).collect()}


@pytest.mark.parametrize("frequent", [3, 64])
def test_against_every_pair(spark, frequent):
    """Groups of edited copies around the threshold, with passages that many texts share."""
    rng = random.Random(frequent)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 20, 60, 150]))]
        if rng.random() < 0.5:
            base[len(base) // 2 : len(base) // 2] = passage
        for _ in range(rng.choice([1, 2, 5, 12])):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = words[: max(1, int(len(words) * rng.uniform(0.7, 1)))]
            rows.append((len(rows), " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    assert got_of(docs_of(spark, rows), J.JoinParams(frequent=frequent)) == brute_force(rows)


def test_against_every_pair_of_the_table(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got_of(docs) == brute_force(rows)


def test_prefixes_share_a_signature():
    """Any two sets over the threshold share a signature, whatever the frequencies."""
    rng = np.random.default_rng(5)
    p = J.JoinParams(frequent=10, class_size=3)
    for trial in range(150):
        n = int(rng.integers(1, 120))
        x = np.unique(rng.integers(-(2**62), 2**62, n))
        y = np.unique(np.concatenate([rng.permutation(x)[: -(-len(x) * int(rng.integers(75, 101)) // 100)], rng.integers(-(2**62), 2**62, int(rng.integers(0, 1 + n // 6)))]))
        inter = len(np.intersect1d(x, y))
        if 100 * inter < 75 * (len(x) + len(y) - inter):
            continue
        zx, zy = x[: J.zone_size(len(x))], y[: J.zone_size(len(y))]
        both = np.intersect1d(zx, zy)
        freq = {h: int(rng.integers(2, 30)) for h in both.tolist()}
        for h in np.concatenate([zx, zy]).tolist():
            freq.setdefault(h, int(rng.integers(1, 30)))
        sig = []
        for z, s in ((zx, x), (zy, y)):
            z = np.array([h for h in z.tolist() if freq[h] > 1], dtype=np.int64)
            sig.append(J.signatures_of(z, np.array([freq[h] for h in z.tolist()], dtype=np.int64), len(s), p))
        assert sig[0] & sig[1], (trial, len(x), len(y), inter)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = J.near_duplicates(docs).collect()
    assert len(rows) == 8
    by = {r.doc_id: r for r in rows}
    assert [(by[d].n_shingles, by[d].component_id) for d in (1, 2, 3)] == [(0, 1), (0, 2), (0, 3)]
    assert by[5].component_id == 5 and by[7].n_shingles == 1 and by[None].component_id is None
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == 7  # the repeated row once
    assert J.near_duplicates(empty_docs(spark)).count() == 0


def test_texts_without_an_identifier_meet_their_own_node_only(spark):
    """Null or equal identifiers don't pair every row of a group with every node."""
    texts = ["a common start of every text here " + " ".join(f"w{i % 9}x{j}" for j in range(12)) + f" end{i}" for i in range(60)]
    docs, p = docs_of(spark, [(None if i % 2 else 5, t) for i, t in enumerate(texts)]), J.JoinParams()
    zoned = J.zones(docs, p)
    assert J.own_texts(docs, zoned).count() == 60
    sets = J.full_sets(docs, zoned, zoned.select("node"), p)
    assert sets.count() == 60 and sets.select("node").distinct().count() == 60


def test_one_row_of_each_component_stays(spark):
    """Copies without identifiers are reduced to one; two texts under one identifier both stay."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(None, a), (None, a), (None, a + " more"), (4, b), (4, c), (4, c), (None, b), (6, d), (7, d), (None, ""), (None, None)]
    kept = [(r.doc_id, r.text) for r in J.keep_one(docs_of(spark, rows)).collect()]
    assert len(kept) == 6
    unnamed = [t for i, t in kept if i is None]
    assert sum(t in (a, a + " more") for t in unnamed) == 1 and unnamed.count("") == 1 and unnamed.count(None) == 1
    assert sorted((i, t) for i, t in kept if i is not None) == [(4, b), (4, c), (6, d)]

import hashlib
import random
import time

import pytest

from pilecall.llm import suffix_dedup as S
from pilecall.llm.common import table

from .edge import SF, docs_of, empty_docs, odd_docs


def brute_force(rows, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, digest), every window in a dictionary."""
    seen, out = {}, {}
    for doc, text in sorted((d, t or "") for d, t in rows):
        data = text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            w = hashlib.blake2b(data[i : i + length], digest_size=16).digest()
            if w in seen:
                gone[i : i + length] = b"\1" * length
            else:
                seen[w] = (doc, i)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = bytes(gone).replace(b"\0", b" ").split()
        out[doc] = (len(data), sum(gone), len(spans), hashlib.sha256(kept).hexdigest())
    return out


def got_of(docs, p=S.SuffixParams()):
    return {r.doc_id: tuple(r)[1:] for r in S.digest(docs, p).collect()}


@pytest.mark.parametrize("letters", [1, 2, 3, 20])
def test_suffix_array_against_sorting(letters):
    rng = random.Random(letters)
    for n in [0, 1, 2, 3, 5, 10, 40, 200] * 20:
        text = [rng.randrange(letters) for _ in range(n)]
        if n > 5 and rng.random() < 0.5:
            text = (text[: n // 3] * 4)[:n]
        order = S.suffix_array(text)
        assert order == sorted(range(len(text)), key=lambda i: text[i:])
        common = S.shared_prefixes(text, order)
        for k in range(1, len(order)):
            a, b = text[order[k - 1] :], text[order[k] :]
            want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[k] == want


def test_construction_is_linear():
    rng = random.Random(0)
    cost = []
    for n in (10_000, 80_000):
        text = [rng.randrange(4) for _ in range(n)]
        began = time.process_time()
        S.suffix_array(text)
        cost.append((time.process_time() - began) / n)
    assert cost[1] < 3 * cost[0]


@pytest.mark.parametrize("limit", [2000, 1])
def test_against_every_window(spark, limit):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcd é\n") for _ in range(rng.choice([90, 130, 400, 1500]))) for _ in range(12)]
    rows = []
    for _ in range(70):
        text = "".join(rng.choice(base)[rng.randrange(0, 60) :] for _ in range(rng.randrange(1, 4)))
        chars = list(text)
        for _ in range(rng.randrange(0, 1 + len(chars) // 150)):
            chars[rng.randrange(len(chars))] = rng.choice("abcdxyz")
        rows.append((len(rows), "".join(chars)))
    rows += [(200, "na" * 400), (201, "x" * 500), (202, "x" * 99), (203, "x" * 100), (204, base[0] + "tail"), (205, "head" + base[0])]
    assert got_of(docs_of(spark, rows), S.SuffixParams(group_limit=limit)) == brute_force(rows)


def test_against_every_window_of_the_table(spark):
    docs = table(spark, SF, "documents")
    assert got_of(docs) == brute_force([(r.doc_id, r.text) for r in docs.collect()])


def test_texts_longer_than_a_chunk():
    rng = random.Random(3)
    unit = bytes(rng.randrange(256) for _ in range(3000))
    data = bytes(rng.randrange(256) for _ in range(S.CHUNK - 1000)) + unit + bytes(rng.randrange(256) for _ in range(50_000))
    import numpy as np

    anchors = S.Anchors(S.SuffixParams())
    anchor, segment, start, size, place = anchors.segments(np.frombuffer(data, np.uint8))
    stops = start + size - 99  # windows are covered once each, in order
    assert start[0] == 0 and stops[-1] == len(data) - 99 and (start[1:] == stops[:-1]).all()
    again = anchors.segments(np.frombuffer(unit, np.uint8))
    assert len(set(again[1].tolist()) & set(segment.tolist())) >= len(again[1]) - 4


def test_odd_rows(spark):
    rows = S.digest(odd_docs(spark)).collect()
    assert len(rows) == 8
    assert [r.n_removed for r in rows if r.doc_id == 5] == [0, 0] and [r.n_bytes for r in rows if r.doc_id == 1] == [0]
    assert [r.n_removed for r in rows if r.doc_id is None] == [0]
    assert S.digest(empty_docs(spark)).count() == 0

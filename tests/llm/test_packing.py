import random
import zlib

import numpy as np
import pytest

from pilecall.llm import packing as P
from pilecall.llm.common import default_tokenizer, table, tokenizer_path
from pilecall.llm.tokens import Encoder

from .edge import SF, docs_of, empty_docs, odd_docs

PIECES = ["word", "Éa", "  ", " ", "\n", "\n\n", "\t ", "'s", " 'll", "123", "½²", "%%%", "<|endoftext|>", "日本", " ", "\x1c", "é", "…", "\r\n", "_x", "🙂"]


def plain(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    return [t.encode(x, add_special_tokens=False) for x in texts]


def texts(spark):
    rng = random.Random(8)
    made = ["".join(rng.choices(PIECES, k=rng.randrange(0, 12))) for _ in range(1500)]
    return made + [r.text for r in table(spark, SF, "documents").collect()]


def test_strings_of_added_tokens_follow_the_json_file():
    assert Encoder(*default_tokenizer()).ids("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]


def test_both_files_give_the_same_tokens(spark):
    encoder = Encoder(*default_tokenizer())
    given = [*texts(spark), " " * 300_000 + "x", "a" * 100_000, "\n" * 50_000]
    for text, e in zip(given, plain(given)):
        assert encoder.ids(text).tolist() == e.ids, text[:200]
        a, b = encoder.token_spans(text)
        assert list(zip(a.tolist(), b.tolist())) == e.offsets, text[:200]


def check(rows, capacity=1024):
    """Sequences without gap, overlap or overflow."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_of_the_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = P.pack(docs).collect()
    encoder = Encoder(*default_tokenizer())
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    given = docs.collect()
    assert set(pieces) == {r.doc_id for r in given}
    for r in given:
        ids = np.append(encoder.ids(r.text), 2).astype("<u4")
        parts = sorted(pieces[r.doc_id], key=lambda x: x.piece)
        at = 0
        for k, x in enumerate(parts):
            assert (x.piece, x.start) == (k, at)
            assert x.ids_crc32 == zlib.crc32(ids[at : at + x.length].tobytes())
            at += x.length
        assert at == len(ids) and all(x.length == 1024 for x in parts[1:])
        assert len(parts) == -(-len(ids) // 1024)
    least = -(-sum(r.length for r in rows) // 1024)
    assert check(rows) <= least * 1.01 + 1


@pytest.mark.parametrize("seed", range(6))
def test_configurations_cover_the_histogram(seed):
    rng = random.Random(seed)
    capacity = 100
    histogram = {rng.randrange(1, 101): rng.randrange(1, 400) for _ in range(rng.randrange(1, 60))}
    plan = P.configurations(histogram, P.PackParams(capacity=capacity))
    covered = {}
    for config, many in plan:
        assert sum(n * a for n, a in config.items()) <= capacity and many > 0
        for n, a in config.items():
            covered[n] = covered.get(n, 0) + a * many
    assert covered == histogram
    first_fit = []
    for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        for k, room in enumerate(first_fit):
            if n <= room:
                first_fit[k] -= n
                break
        else:
            first_fit.append(capacity - n)
    assert sum(m for _, m in plan) <= len(first_fit) * 1.003 + 1


def test_knapsack_against_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([2, 3, 5, 7])
    for _ in range(20):
        values = rng.random(4)
        most = rng.integers(1, 10, 4)
        for bound in (None, most):
            best = max(v @ values for v in np.ndindex(10, 7, 5, 3) if np.dot(v, lengths) <= 17 for v in [np.array(v)] if bound is None or (v <= bound).all())
            got = P.best_filling(lengths, values, 17, bound)
            assert sum(values[k] * a for k, a in got.items()) == pytest.approx(best)
            assert sum(lengths[k] * a for k, a in got.items()) <= 17 and (bound is None or all(a <= bound[k] for k, a in got.items()))


def best_fit(histogram, capacity):
    """Sequences of best fit, longest first."""
    rooms, n = {}, 0
    for x in sorted(histogram, reverse=True):
        for _ in range(histogram[x]):
            room = min((r for r, c in rooms.items() if r >= x and c), default=None)
            if room is None:
                n, room = n + 1, capacity
            else:
                rooms[room] -= 1
            rooms[room - x] = rooms.get(room - x, 0) + 1
    return n


def test_the_program_gives_the_plan(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    histogram = {r["length"]: r["count"] for r in P.pieces(docs).groupBy("length").count().collect()}
    plan = P.configurations(histogram)
    total = sum(many for _, many in plan)
    # no worse than longest-first best fit without any program
    assert total <= best_fit(histogram, 1024)
    # all but the tail come from the program, or hold a piece that nothing fits beside
    class Never(Exception):
        pass

    def never(*_):
        raise Never

    kept, P.fullest = P.fullest, never
    try:
        with pytest.raises(Never):
            P.configurations(histogram)
        priced = P.configurations({n: c for n, c in histogram.items() if n == 1024})
    finally:
        P.fullest = kept
    assert priced == [({1024: 1}, histogram[1024])]
    assert P.PackParams().tail + 2 < 0.05 * (total - histogram[1024])


def test_odd_rows(spark):
    rows = P.pack(odd_docs(spark)).collect()
    check(rows)
    assert [(r.length, r.ids_crc32) for r in rows if r.doc_id in (1, 2)] == [(1, zlib.crc32(b"\2\0\0\0"))] * 2
    assert len([r for r in rows if r.doc_id == 5]) == 2
    assert len([r for r in rows if r.doc_id is None]) == 1
    assert P.pack(empty_docs(spark)).count() == 0
    exact = docs_of(spark, {1: " a" * 1023, 2: " a" * 1024, 3: " a" * 2047})
    got = sorted((r.doc_id, r.piece, r.start, r.length) for r in P.pack(exact).collect())
    assert got == [(1, 0, 0, 1024), (2, 0, 0, 1), (2, 1, 1, 1024), (3, 0, 0, 1024), (3, 1, 1024, 1024)]

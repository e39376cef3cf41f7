import math

import numpy as np
import pytest

from pilecall.llm import whitening as W
from pilecall.llm.common import table

from .edge import SF

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in vectors], SCHEMA)


def check(rows, vectors, components=4):
    """Rows against numpy's symmetric eigensolver on the distinct whole-number vectors."""
    d = max((len(v) for _, v in vectors), default=0)
    x = {k: np.array([math.floor(256 * float(np.float32(c))) for c in v] + [0] * (d - len(v)), dtype=np.int64) for k, v in enumerate([v for _, v in vectors])}
    fit = np.unique(np.array(list(x.values())).reshape(-1, d), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > 1e-9 * max(1, e[0])).sum()))
    assert len(rows) == len(vectors) * k
    by = {}
    for r in rows:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, k + 1))
    for c, got in by.items():
        want = {}
        for (vid, _), v in zip(vectors, x.values()):
            want.setdefault(vid, []).append(((n * v - s) ** 2).sum())
        assert sorted((r.vec_id is None, r.vec_id or 0, r.deviation) for r in got) == sorted((i is None, i or 0, int(a)) for i, l in want.items() for a in l)
        assert {r.n for r in got} == {n} and len({r.explained for r in got}) == 1 and len({r.identity_error for r in got}) == 1
        assert got[0].explained == pytest.approx(e[c - 1] / e.sum(), rel=1e-9)
        assert got[0].identity_error < 1e-9
        gap = min(abs(e[c - 1] - e[i]) for i in range(d) if i != c - 1) if d > 1 else 1.0
        if gap > 1e-6 * e[0]:
            proj = {}
            for (vid, _), v in zip(vectors, x.values()):
                proj.setdefault(vid, []).append(float((v - s / n) @ u[:, c - 1] / np.sqrt(e[c - 1])))
            ours = {}
            for r in got:
                ours.setdefault(r.vec_id, []).append(r.whitened)
            near = [all(sorted(ours[i]) == pytest.approx(sorted(sign * a for a in proj[i]), abs=1e-7) for i in proj) for sign in (1, -1)]
            assert any(near)


def test_characteristic_polynomial(spark):
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 9):
        b = rng.integers(-50, 50, (d, d + 1))
        b[:, : d // 2] = 0  # pivots that vanish
        m = (b @ b.T).tolist()
        poly = W.charpoly(spark, m)
        assert poly[d] == 1 and len(poly) == d + 1
        for t in (-7, 0, 3, 1000):  # det(t - m), by fractions
            assert sum(c * t**i for i, c in enumerate(poly)) == det([[(t if i == j else 0) - m[i][j] for j in range(d)] for i in range(d)])


def det(a):
    from fractions import Fraction

    a, out = [[Fraction(x) for x in r] for r in a], Fraction(1)
    for k in range(len(a)):
        r = next((i for i in range(k, len(a)) if a[i][k]), None)
        if r is None:
            return 0
        if r != k:
            a[k], a[r], out = a[r], a[k], -out
        out *= a[k][k]
        for i in range(k + 1, len(a)):
            f = a[i][k] / a[k][k]
            a[i] = [x - f * y for x, y in zip(a[i], a[k])]
    return out


def test_roots_with_multiplicity():
    def product(roots):
        out = [1]
        for r in roots:
            out = [a - r * b for a, b in zip([0, *out], [*out, 0])]
        return out

    for roots in ([9, 9, 9, 4, 1], [1000003, 1000002, 5, 0, 0], [7], [0, 0], [12, 12, 3, 3, 3, 0]):
        got = W.largest_roots(product(roots), 10, 30)
        assert [(float(r), k) for r, k in got] == [(float(r), roots.count(r)) for r in sorted(set(roots), reverse=True) if r]
    r, k = W.largest_roots([-2, 0, 1][::1] and product([3, 1]), 1, 30)[0]
    assert (float(r), k) == (3.0, 1)
    # irrational, 1e-9 apart: t**2 - 2*10**9*t + 10**18 - 1 has roots 10**9 +- 1
    assert [float(x) for x, _ in W.largest_roots([10**18 - 2, -2 * 10**9, 1], 2, 30)] == [10**9 + math.sqrt(2), 10**9 - math.sqrt(2)]


def test_whitening_of_the_table(spark):
    t = table(spark, SF, "embeddings")
    check(W.whitened(t).collect(), [(r.vec_id, r.embedding) for r in t.collect()])


def test_small_and_degenerate_tables(spark):
    rng = np.random.default_rng(5)
    line = [(i, [i / 8, i / 4, 1.0]) for i in range(6)]  # rank 1
    square = [(0, [1, 1]), (1, [-1, 1]), (2, [1, -1]), (3, [-1, -1])]  # a double root
    copies = [(i % 3, v) for i, v in enumerate(rng.normal(size=(20, 5)).astype(np.float32).tolist())] * 3
    ragged = [(i, rng.normal(size=3 + i % 3).tolist()) for i in range(30)]
    for vectors in (line, square, copies, ragged):
        check(W.whitened(frame(spark, vectors)).collect(), vectors)
    for vectors in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])], [(1, None)]):
        got = W.whitened(frame(spark, vectors))
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and got.count() == 0


def test_odd_rows(spark):
    """Null vectors and entries, non-finite entries, null identifiers, clashing columns, entries beyond long."""
    rng = np.random.default_rng(6)
    good = [(None if i == 4 else i, rng.normal(size=4).tolist()) for i in range(12)]
    odd = [(50, None), (51, [1, None, 2, 3]), (52, [float("nan"), 0, 0, 0]), (53, [float("inf"), 0, 0, 0])]
    from pyspark.sql import functions as F

    t = frame(spark, good + odd).withColumn("n", F.lit("x")).withColumn("x", F.lit(1)).withColumn("key", F.lit(None).cast("string"))
    check(W.whitened(t).collect(), good)
    far = W.whitened(frame(spark, [(1, [3e38, 1.0]), (2, [0.0, 2.0]), (3, [-3e38, 5.0])])).collect()
    assert {r.deviation for r in far} == {None} or all(r.deviation is None for r in far if r.vec_id != 2)
    assert all(math.isfinite(r.whitened) for r in far)


def test_products_beyond_doubles():
    x = np.array([[2**40, -3], [2**41, 5], [-(2**62), 7]])
    assert W.products(x).tolist() == [[2**80 + 2**82 + 2**124, -3 * 2**40 + 5 * 2**41 - 7 * 2**62], [-3 * 2**40 + 5 * 2**41 - 7 * 2**62, 83]]

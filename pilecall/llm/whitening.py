"""Embedding whitening by the exact characteristic polynomial of the scatter matrix.

Every entry becomes a whole number x, so the scatter ``M = n * sum(x x') - S S'`` (n squared
times the covariance) is a matrix of whole numbers, added up exactly by Spark from the
partial sums of its partitions. Its characteristic polynomial is computed modulo many
primes, a Spark task per few primes: reduction to Hessenberg form by similarity, then the
recurrence of leading minors. Chinese remaindering gives the exact coefficients. All roots
are real and none is negative, so the sign changes of the polynomial shifted to ``a`` are
exactly the number of roots above ``a``; bisection on that number isolates the largest
roots to ``digits`` digits more than their size. Components are null vectors of
``M - root``, by inverse iteration in decimal arithmetic of that precision; a root that
occurs several times (or roots that agree to all those digits) gets as many orthonormal
vectors. Rows are then centred and projected.

The fit list holds each distinct whole-number vector once. Vectors of different lengths
are filled up with zeros to the longest one. The driver holds what depends on the
dimension only: sums, scatter, coefficients, components.

Edge cases: rows with a null vector, or with null or non-finite entries, are dropped; a
null identifier stays; repeated rows repeat their results; components with eigenvalue 0
do not exist (one distinct vector, or fewer dimensions than components), so such tables
give fewer or no rows; an entry beyond the range of long stops at its end; a deviation
beyond it is null. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import decimal
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import slices, written

LIMB = 40


@dataclass(frozen=True)
class WhitenParams:
    scale: float = 256.0
    components: int = 4
    digits: int = 40  # decimal digits that separate roots from each other


# --- exact sums -------------------------------------------------------------


def whole_numbers(rows: DataFrame, vector: str, p: WhitenParams) -> DataFrame:
    """Rows with finite vectors, the vector replaced by ``x`` (array of long, filled up to the longest)."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    kept = rows.where(F.col(vector).isNotNull() & ~bad)
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * p.scale).cast("bigint") + F.lit(0).cast("bigint"))
    kept = kept.withColumn("x", x).drop(vector)
    width = kept.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    fill = F.array_repeat(F.lit(0).cast("bigint"), F.greatest(F.lit(0), F.lit(width) - F.size("x")))
    return kept.withColumn("x", F.concat("x", fill))


def matrix_of(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def products(x: np.ndarray) -> np.ndarray:
    """x' x, exactly: by doubles where every sum stays below 2**53, else by whole numbers without bound."""
    top = max(1, int(np.abs(x.astype(np.float64)).max(initial=0)) + 1)
    if top * top * len(x) < 2**53:
        f = x.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    big = x.astype(object)
    return big.T.dot(big)


def sums(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """n, per-dimension sums and sums of products of the fit list, exact.

    A task adds up its rows and returns one row per entry of the upper triangle (the sums
    are the products with a leading 1), in limbs of 40 bits, so that adding tasks is exact.
    """
    pairs = [(i, j) for i in range(d + 1) for j in range(i, d + 1)]

    def run(batches):
        total = [[0] * (d + 1) for _ in range(d + 1)]
        for batch in batches:
            for part in slices([batch], 4096):
                x = matrix_of(part.column(0), d)
                g = products(np.hstack([np.ones((len(x), 1), np.int64), x]))
                total = [[a + int(b) for a, b in zip(row, new)] for row, new in zip(total, g.tolist())]
        values = [total[i][j] for i, j in pairs]
        limbs = [[(v >> (LIMB * k)) & ((1 << LIMB) - 1) for v in values] for k in range(3)] + [[v >> (LIMB * 3) for v in values]]
        yield pa.RecordBatch.from_arrays([pa.array(np.array(z, np.int32)) for z in zip(*pairs)] + [pa.array(z, pa.int64()) for z in limbs], ["i", "j", "l0", "l1", "l2", "l3"])

    parts = fit.select("x").mapInArrow(run, "i int, j int, l0 bigint, l1 bigint, l2 bigint, l3 bigint")
    rows = parts.groupBy("i", "j").agg(*(F.sum(F.col(f"l{k}").cast("decimal(38,0)")).alias(f"l{k}") for k in range(4))).collect()
    g = [[0] * (d + 1) for _ in range(d + 1)]
    for r in rows:
        g[r.i][r.j] = g[r.j][r.i] = sum(int(r[f"l{k}"]) << (LIMB * k) for k in range(4))
    return g[0][0], g[0][1:], [row[1:] for row in g[1:]]


# --- characteristic polynomial ----------------------------------------------


def charpoly_mod(m: np.ndarray, q: int) -> list[int]:
    """Coefficients of det(t - m) modulo the prime q (below 2**31), constant first."""
    h, d = m.copy(), len(m)
    for k in range(1, d - 1):
        pivots = np.flatnonzero(h[k:, k - 1])
        if not len(pivots):
            continue
        r = k + int(pivots[0])
        if r != k:
            h[[r, k]] = h[[k, r]]
            h[:, [r, k]] = h[:, [k, r]]
        f = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, q) % q
        h[k + 1 :] = (h[k + 1 :] - f[:, None] * h[k]) % q
        # the inverse operation on columns: column k gets f times the others, term by term below 2**62
        add = h[:, k + 1 :] * f % q
        h[:, k] = (h[:, k] + add.sum(axis=1)) % q
    minors = [np.zeros(d + 1, np.int64) for _ in range(d + 1)]
    minors[0][0] = 1
    for k in range(1, d + 1):
        new = -h[k - 1, k - 1] % q * minors[k - 1] % q
        new[1:] += minors[k - 1][:-1]
        below = 1
        for i in range(1, k):
            below = below * int(h[k - i, k - i - 1]) % q
            if not below:
                break
            new = (new - int(h[k - i - 1, k - 1]) * below % q * minors[k - i - 1]) % q
        minors[k] = new % q
    return minors[d].tolist()


def primes(least_bits: int) -> list[int]:
    """Primes below 2**31, falling, whose product has more than ``least_bits`` bits."""
    out, q, bits = [], 2**31, 0.0
    while bits <= least_bits:
        q -= 1
        if q % 2 and all(pow(a, q - 1, q) == 1 and probable(q, a) for a in (2, 3, 5, 7)):
            out.append(q)
            bits += math.log2(q)
    return out


def probable(q: int, a: int) -> bool:
    """One strong probable-prime test; bases 2, 3, 5 and 7 decide every number below 3 * 10**9."""
    s = ((q - 1) & -(q - 1)).bit_length() - 1
    x = pow(a, (q - 1) >> s, q)
    return x in (1, q - 1) or any((x := x * x % q) == q - 1 for _ in range(s - 1))


def charpoly(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """det(t - m) for a positive semidefinite matrix of whole numbers, exact, constant first."""
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    # the k-th coefficient is at most C(d, k) (trace / d)**k: the mean of the roots bounds their products
    bits = max((math.log2(math.comb(d, k)) + k * max(0.0, math.log2(trace / d)) for k in range(1, d + 1)), default=0.0) if trace else 0.0
    moduli = primes(int(bits) + 8)
    packed = [[str(v) for v in row] for row in m]

    def run(batches):
        whole = np.array([[int(v) for v in row] for row in packed], dtype=object)
        for batch in batches:
            qs = batch.column(0).to_pylist()
            got = [charpoly_mod((whole % q).astype(np.int64), q) for q in qs]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.int64()))], ["q", "c"])

    tasks = spark.createDataFrame([(q,) for q in moduli], "q bigint").repartition(max(1, len(moduli) // 8))
    got = tasks.mapInArrow(run, "q bigint, c array<bigint>").collect()
    product = math.prod(r.q for r in got)
    out = [0] * (d + 1)
    for r in got:
        unit = product // r.q
        unit *= pow(unit, -1, r.q)
        out = [(a + unit * c) % product for a, c in zip(out, r.c)]
    return [c - product if c > product // 2 else c for c in out]


def roots_above(poly: list[int], at: int) -> int:
    """How many roots (with multiplicity) of a real-rooted polynomial lie above ``at``: sign changes after shifting."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += at * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value_sign(poly: list[int], at: int) -> int:
    v = 0
    for c in reversed(poly):
        v = v * at + c
    return (v > 0) - (v < 0)


def largest_roots(poly: list[int], k: int, digits: int) -> list[tuple[decimal.Decimal, int]]:
    """The largest positive roots with their multiplicities, until k are found: [(root, how often)]."""
    d = len(poly) - 1
    zeros = next((i for i, c in enumerate(poly) if c), d)
    positive = d - zeros
    if not positive:
        return []
    bound = -poly[d - 1] + 1  # the sum of roots, none of them negative
    # how fine: roots are told apart to ``digits`` digits below one, and below the smallest root of interest
    fine = int(digits * math.log2(10)) + 8
    scaled = [c << (fine * (d - i)) for i, c in enumerate(poly)]
    out: list[tuple[decimal.Decimal, int]] = []
    found, high = 0, bound << fine
    with decimal.localcontext(prec=digits + len(str(high)) + 10):
        while found < min(k, positive):
            lo, hi = 0, high  # the next root lies in (lo, hi]: fewer than or as many as ``found`` above hi
            while hi - lo > 1:
                mid = (lo + hi) // 2
                above = roots_above(scaled, mid)
                if above > found:
                    lo = mid
                else:
                    hi = mid
                if above == found + 1 and (sign := value_sign(scaled, hi)) and value_sign(scaled, lo) == -sign:
                    break  # a simple root: from here on its sign change is enough
            while hi - lo > 1:
                mid = (lo + hi) // 2
                if value_sign(scaled, mid) in (sign, 0):
                    hi = mid
                else:
                    lo = mid
                if value_sign(scaled, hi) == 0:
                    lo = hi - 1
            many = roots_above(scaled, lo) - found
            out.append((decimal.Decimal(hi) / (1 << fine), many))
            found, high = found + many, lo
    return out


def null_vectors(m: list[list[int]], root: decimal.Decimal, many: int, prec: int) -> list[list[float]]:
    """``many`` orthonormal vectors v with m v = root v: inverse iteration in decimals."""
    d = len(m)
    with decimal.localcontext(prec=prec):
        D = decimal.Decimal
        a = [[D(v) - (root if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(m)]
        tiny = D(10) ** -(prec - 5) * max(D(1), max(abs(D(m[i][i])) for i in range(d)))
        order = list(range(d))
        for k in range(d):
            r = max(range(k, d), key=lambda i: abs(a[i][k]))
            a[k], a[r], order[k], order[r] = a[r], a[k], order[r], order[k]
            if abs(a[k][k]) < tiny:
                a[k][k] = tiny
            for i in range(k + 1, d):
                f = a[i][k] / a[k][k]
                a[i] = [*a[i][:k], f, *(x - f * y for x, y in zip(a[i][k + 1 :], a[k][k + 1 :]))]

        def solve(b):
            y = []
            for i in range(d):
                y.append(b[order[i]] - sum((f * v for f, v in zip(a[i][:i], y)), D(0)))
            x = [D(0)] * d
            for i in reversed(range(d)):
                x[i] = (y[i] - sum((f * v for f, v in zip(a[i][i + 1 :], x[i + 1 :])), D(0))) / a[i][i]
            return x

        def orthonormal(vs):
            done: list[list[decimal.Decimal]] = []
            for v in vs:
                for _ in range(2):
                    for u in done:
                        dot = sum(x * y for x, y in zip(u, v))
                        v = [x - dot * y for x, y in zip(v, u)]
                    norm = sum(x * x for x in v).sqrt()
                    v = [x / norm for x in v]
                done.append(v)
            return done

        rng = np.random.default_rng(13)
        vs = orthonormal([[D(int(x)) for x in rng.integers(1, 1000, d)] for _ in range(many)])
        for _ in range(4):
            vs = orthonormal([solve(v) for v in vs])
        lead = [max(v, key=abs) for v in vs]
        return [[float(x if top > 0 else -x) for x in v] for v, top in zip(vs, lead)]


def components(spark: SparkSession, n: int, s: list[int], g: list[list[int]], p: WhitenParams) -> tuple[list[list[float]], list[float], list[float]]:
    """(unit vectors, eigenvalues of the covariance, shares of its trace), largest first."""
    d = len(s)
    m = [[n * g[i][j] - s[i] * s[j] for j in range(d)] for i in range(d)]
    trace = sum(m[i][i] for i in range(d))
    if not trace:
        return [], [], []
    roots = largest_roots(charpoly(spark, m), p.components, p.digits)
    prec = 2 * p.digits + len(str(trace))
    packed = [[str(v) for v in row] for row in m]

    def run(batches):
        whole = [[int(v) for v in row] for row in packed]
        for batch in batches:
            got = [null_vectors(whole, decimal.Decimal(r), k, prec) for r, k in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.list_(pa.float64())))], ["k", "v"])

    tasks = spark.createDataFrame([(i, str(r), k) for i, (r, k) in enumerate(roots)], "k bigint, root string, many bigint").repartition(len(roots), "k")
    vectors = {r.k: r.v for r in tasks.mapInArrow(run, "k bigint, v array<array<double>>").collect()}
    with decimal.localcontext(prec=prec):
        flat = [(list(v), float(r / n / n), float(r / trace)) for i, (r, _) in enumerate(roots) for v in vectors[i]][: p.components]
    return [v for v, _, _ in flat], [e for _, e, _ in flat], [share for _, _, share in flat]


# --- rows -------------------------------------------------------------------


def projected(rows: DataFrame, n: int, s: list[int], vectors: list[list[float]], values: list[float]) -> DataFrame:
    """``rows`` with ``deviation`` (exact) and ``w``, the whitened coordinates, instead of ``x``."""
    keep = [c for c in rows.columns if c != "x"]
    schema = rows.select(keep).schema.add("deviation", "long").add("w", ArrayType(DoubleType()))
    d = len(s)
    ints = [int(v) for v in s]

    def run(batches):
        to = np.array(vectors).T / (n * np.sqrt(values))
        big_s, near = np.array(ints, dtype=object), max(map(abs, ints), default=0) < 2**62
        for batch in slices(batches, 4096):
            x = matrix_of(batch.column(batch.schema.get_field_index("x")), d)
            top = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
            most = n * top + max(map(abs, ints), default=0)
            if near and most * most * max(1, d) < 2**63:
                y = n * x - np.array(ints, np.int64)
                far = (y * y).sum(axis=1).tolist()
            else:
                y = n * x.astype(object) - big_s
                far = [v if v < 2**63 else None for v in (int(sum(e * e for e in row)) for row in y)]
            w = y.astype(np.float64) @ to
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + [pa.array(far, pa.int64()), pa.array(list(w), pa.list_(pa.float64()))], schema=pa.schema([*(batch.schema.field(c) for c in keep), ("deviation", pa.int64()), ("w", pa.list_(pa.float64()))]))

    return rows.mapInArrow(run, schema)


def identity_error(fit: DataFrame, n: int, s: list[int], vectors: list[list[float]], values: list[float]) -> float:
    """Largest entry, without sign, of (covariance of the whitened fit list - identity): means first, then centred products."""
    k = range(len(vectors))
    w = projected(fit.select("x"), n, s, vectors, values)
    mean = w.agg(*(F.avg(F.col("w")[i]).alias(f"m{i}") for i in k)).first()
    centred = [F.col("w")[i] - F.lit(float(mean[i])) for i in k]
    cov = w.agg(*(F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i in k for j in k if i <= j)).first()
    return max(abs(cov[f"c{i}_{j}"] - (i == j)) for i in k for j in k if i <= j)


def whitened(table: DataFrame, p: WhitenParams = WhitenParams(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error: one row per kept row and component."""
    spark = table.sparkSession
    rows = written(whole_numbers(table.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("embedding")), "embedding", p), "whole")
    fit = written(rows.select("x").distinct(), "fit")
    first = fit.select(F.size("x")).first()
    d = first[0] if first else 0
    n, s, g = sums(fit, d) if d else (0, [], [])
    vectors, values, shares = components(spark, n, s, g, p) if n else ([], [], [])
    if not vectors:
        empty = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return table.select(F.col(key)).limit(0).select(key, *(F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in empty.split(", ")))
    error = identity_error(fit, n, s, vectors, values)
    w = projected(rows, n, s, vectors, values).select(F.col("key").alias(key), "deviation", F.posexplode("w").alias("at", "whitened"))
    return w.select(
        key,
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*(F.lit(x) for x in shares)), F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )

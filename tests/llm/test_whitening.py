from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest
from helpers import MIDDLE

from wardbook.llm import queries
from wardbook.llm.exact_roots import RealRoots, combined, null_vectors, polynomials_modulo, primes, primes_needed
from wardbook.llm.whitening import characteristic_polynomial, whiten

ROWS = "vec_id long, embedding array<float>, label int"


def plain_polynomial(matrix: list[list[int]]) -> list[int]:
    """Faddeev and LeVerrier, in whole numbers."""
    a = np.array(matrix, object)
    n, m, c = len(a), np.zeros((len(a), len(a)), object), [1]
    for k in range(1, n + 1):
        m = a @ m + c[-1] * np.array([[int(i == j) for j in range(n)] for i in range(n)], object)
        c.append(-(a @ m).trace() // k)
    return c[::-1]


def times(a: list[int], b: list[int]) -> list[int]:
    out = [0] * (len(a) + len(b) - 1)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            out[i + j] += x * y
    return out


def scatter_like(seed: int, n: int, rank: int) -> np.ndarray:
    rng = random.Random(seed)
    b = np.array([[rng.randint(-(10**6), 10**6) if rng.random() < 0.7 else 0 for _ in range(n)] for _ in range(rank)], object)
    return b.T @ b


@pytest.mark.parametrize(("n", "rank"), [(1, 1), (2, 1), (5, 5), (9, 4), (12, 12)])
def test_polynomial_is_exact(spark, n, rank):
    matrix = scatter_like(n, n, rank)
    want = plain_polynomial(matrix.tolist())
    moduli = primes_needed(matrix)
    assert combined(moduli, polynomials_modulo(matrix, moduli).tolist()) == want
    assert characteristic_polynomial(spark, matrix) == want


def test_primes():
    first = [p for p, _ in zip(primes(), range(30), strict=False)]
    assert first[0] == 2**31 - 1 and all(all(p % d for d in range(2, 47_000)) for p in first)


def test_roots_are_isolated_with_their_multiplicity():
    coefficients = [1]
    for root, n in ((0, 2), (3, 1), (7, 3), (2**40, 1), (2**40 + 1, 1), (5, 1), (16, 1)):
        for _ in range(n):
            coefficients = times(coefficients, [-root, 1])
    found = RealRoots(coefficients).largest(100)
    assert [r.times for r in found] == [1, 1, 1, 3, 1, 1]
    for r, want in zip(found, (2**40 + 1, 2**40, 16, 7, 5, 3), strict=True):
        assert r.low <= want <= r.high and r.high - r.low <= Fraction(want, 2**199)
    assert sum(r.times for r in RealRoots(coefficients).largest(2)) == 2


def test_close_roots_have_exact_vectors():
    """Two eigenvalues 1 and 1 + 10^-17 apart in relation: doubles cannot tell them apart."""
    matrix = np.array([[10**17, 0, 0], [0, 10**17 + 1, 0], [0, 0, 5]], object)
    turned = np.array([[1, 2, 2], [2, 1, -2], [2, -2, 1]], object)  # three times a rotation
    matrix = turned @ matrix @ turned.T
    roots = RealRoots(plain_polynomial(matrix.tolist())).largest(3)
    for root, column in zip(roots, (1, 0, 2), strict=True):
        (v,) = null_vectors(matrix, root)
        assert abs(abs(np.dot(v, turned[:, column].astype(float))) - 3) < 1e-15 * 3


def check(rows, got, factor=64, components=16):
    """Against numpy and Python's whole numbers."""
    kept = [(i, v) for i, v, _ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array([[int(np.floor(float(np.float32(c)) * factor)) + 1_000_000 for c in v] for _, v in kept], object)
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), object)
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.astype(float).T, bias=True).reshape(x.shape[1], -1))
    rank = np.linalg.matrix_rank((fit - fit[0]).astype(float)) if n > 1 else 0
    k = min(components, rank)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    assert len(got) == len(kept) * k
    deviation = [int(((n * r - sums) ** 2).sum()) for r in x]
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component, r.n, int(r.deviation)) for r in got) == sorted(
        (i is None, i or 0, c, n, d) for (i, _), d in zip(kept, deviation, strict=True) for c in range(1, k + 1)
    )
    if not k:
        return
    want = ((x * n - sums) / n).astype(float) @ vectors / np.sqrt(values)
    for c in range(k):
        have = sorted((r.vec_id is None, r.vec_id or 0, r.whitened) for r in got if r.component == c + 1)
        both = [sorted((i is None, i or 0, sign * v) for (i, _), v in zip(kept, want[:, c], strict=True)) for sign in (1, -1)]
        assert min(max(abs(h[2] - w[2]) for h, w in zip(have, expected, strict=True)) for expected in both) < 1e-6
    assert all(abs(r.explained - values[r.component - 1] / np.trace(np.cov(fit.astype(float).T, bias=True).reshape(x.shape[1], -1))) < 1e-9 for r in got)
    assert all(r.identity_error < 1e-9 for r in got)


def test_query_equals_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MIDDLE}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    check(rows, queries.op11_whitening(spark, MIDDLE).collect())


@pytest.mark.parametrize(("n", "dims"), [(60, 5), (4, 9), (200, 20)])
def test_small_tables_copies_and_odd_rows(spark, n, dims):
    rng = random.Random(n)
    rows = [(i, [rng.gauss(3, 2 + d) for d in range(dims)], 0) for i in range(n)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(2 * n)] + [(3, rows[3][1], 1), (None, rows[2][1], None)]
    odd = [(2000, None, 0), (2001, [None] * dims, 0), (2002, [float("nan")] * dims, 0), (2003, [float("-inf")] + [0.0] * (dims - 1), 0)]
    frame = spark.createDataFrame(rows + odd, ROWS).selectExpr("*", "'x' AS x", "'x' AS n", "'x' AS component")
    check(rows, whiten(frame).collect())


def test_no_components(spark):
    assert whiten(spark.createDataFrame([], ROWS)).collect() == []
    assert whiten(spark.createDataFrame([(1, [], 0), (2, None, 0)], ROWS)).collect() == []
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], ROWS)).collect() == []


def test_lengths_and_huge_entries(spark):
    """The most frequent length counts; huge entries are exact or cut to 2^50."""
    rows = [(1, [1.0, 2.0], 0), (2, [3.0, 1.0], 0), (3, [2.0**45, -(2.0**46)], 0), (4, [1.0], 0), (5, [3e38, 1.0], 0)]
    got = whiten(spark.createDataFrame(rows, ROWS), components=2).collect()
    assert {(r.vec_id, r.component) for r in got} == {(i, c) for i in (1, 2, 3, 5) for c in (1, 2)}
    x = [[int(np.clip(c * 64, -(2**50), 2**50)) + 1_000_000 for c in v] for _, v, _ in rows if len(v) == 2]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = [sum((4 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    assert sorted({int(r.deviation) for r in got}) == sorted(set(want))

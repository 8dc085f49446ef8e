from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import ordered
from pyspark.sql import functions as F

from wardbook.llm import hard_negatives as module
from wardbook.llm.hard_negatives import Best, Index, Vectors, hard_negatives, scaled

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows: list[tuple], factor: int, every: int, positives: int = 5, negatives: int = 10) -> list[tuple]:
    """Every anchor against every row."""
    usable = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(v is None or not np.isfinite(v) for v in vector):
            continue
        usable.append((vec_id, label, tuple(int(np.floor(float(np.float32(v)) * factor)) for v in vector)))
    out = []
    for a, label, x in sorted({r for r in usable if r[0] % every == 0}):
        scores = [(-sum(p * q for p, q in zip(x, y, strict=False)), i, other) for i, other, y in usable if i != a]
        for rank, (score, i, _) in enumerate(sorted(s for s in scores if s[2] == label)[:positives], 1):
            fits = sorted(s for s in scores if s[2] != label and 30 * -score <= 100 * -s[0] <= 90 * -score)
            out += [(a, i, n, j, -score, -s, rank) for n, (s, j, _) in enumerate(fits[:negatives], 1)]
    return out


def found(spark, rows: list[tuple], factor: int = 8, every: int = 3, **settings) -> list[tuple]:
    frame = scaled(spark.createDataFrame(rows, ROWS).selectExpr("*", "'x' AS x", "1 AS rank", "2 AS anchor"), factor)
    return ordered(hard_negatives(frame, F.col("vec_id") % every == 0, **settings).collect())


def some_rows(seed: int, n: int, dims: int, labels: int) -> list[tuple]:
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    out = []
    for i in range(n):
        k, far = rng.randrange(labels), rng.choice((0.2, 1))
        out.append((i - 5, [far * v + rng.gauss(0, 0.7) for v in centre[k]], k if rng.random() < 0.8 else rng.randrange(labels)))
    return out


@pytest.mark.parametrize(("n", "dims", "labels", "at_once"), [(120, 20, 3, 16_384), (90, 3, 2, 7), (12, 9, 4, 2), (40, 5, 1, 16_384)])
def test_equals_brute_force(spark, n, dims, labels, at_once):
    rows = some_rows(n, n, dims, labels)
    assert found(spark, rows, anchors_at_once=at_once) == ordered(brute(rows, 8, 3))


def test_ties_repeats_and_odd_rows(spark):
    """Ties by id, repeated rows and anchors, zero and negative scores, nulls, lengths, hot copies."""
    rng = random.Random(1)
    rows = [(i, [float(rng.randint(-1, 1)) for _ in range(4)], rng.randrange(2)) for i in range(60)]
    rows += [(3, [1.0, 0.0, 0.0, 0.0], 0)] * 2 + [(200 + i, [1.0, 1.0, 1.0, 1.0], i % 2) for i in range(40)] + [(70, [1.0, 1.0], 1), (72, [], 0)]
    odd = [(None, [1.0] * 4, 0), (81, None, 0), (84, [1.0, None, 0.0, 0.0], 0), (87, [float("nan")] * 4, 0), (90, [float("inf")] * 4, 1), (93, [1.0] * 4, None)]
    assert found(spark, rows + odd) == ordered(brute(rows, 8, 3)) != []


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 0)]) == []
    assert found(spark, [(3, [1.0], 0)]) == []


def test_levels_change_nothing(spark, monkeypatch):
    rows = some_rows(7, 80, 24, 2)
    monkeypatch.setattr(module, "POSITIVE_LEVELS", (None,))
    monkeypatch.setattr(module, "NEGATIVE_LEVELS", (None,))
    assert found(spark, rows) == ordered(brute(rows, 8, 3))


@pytest.mark.parametrize("size", [100, 2.0**27])
def test_index_returns_every_pair_over_the_threshold(size):
    rng = np.random.default_rng(3)
    x, a = (np.floor(rng.normal(0, size, (n, 37)) * np.linspace(0.1, 1, 37)) for n in (300, 20))
    exact = np.array([[int(sum(int(p) * int(q) for p, q in zip(u, v, strict=True))) for v in x] for u in a], object)
    for share in (0.0, 0.2, 0.5):
        least = share * np.sqrt((a**2).sum(1)) * np.sqrt((x**2).sum(1).max())
        index = Index(Vectors(x, np.arange(300), np.zeros(300, np.int64)), share * np.sqrt((x**2).sum(1).max()) * 0.999 if share else -np.inf)
        if share == 0.5:
            assert len(index.rows) < 300 or index.first.max() > 0  # some dimensions are left out
        i, j, score = index.search(a, least)
        got = {(p, int(index.rows.ids[q])): s for p, q, s in zip(i.tolist(), j.tolist(), score.tolist(), strict=True)}
        assert got == {(p, q): exact[p, q] for p in range(20) for q in range(300) if exact[p, q] >= int(np.ceil(least[p]))}


def test_best_keeps_the_first_and_raises_the_threshold():
    best = Best(2, 2)
    best.add(np.array([0, 0, 1]), np.array([5, 7, 1]), np.array([1, 2, 3]))
    best.add(np.array([0, 0]), np.array([7, 6]), np.array([0, 9]))
    assert list(zip(best.query, best.score, best.row, strict=True)) == [(0, 7, 0), (0, 7, 2), (1, 1, 3)]
    assert best.lowest.tolist() == [7, -np.inf]

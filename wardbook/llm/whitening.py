"""Embedding whitening by the exact characteristic polynomial of the covariance.

The vectors become vectors x of whole numbers, each different one stands once in the fit list, and everything up to the eigenvalues is
whole-number arithmetic of any size, so no order of adding and no cancellation shows in it:

1. Sums of each dimension; then, with x less the rounded-down mean, the scatter n * sum(x x') - S S' (n * n times the covariance).
   Tasks send partial sums as digits, which Spark adds.
2. Its characteristic polynomial: by reduction to Hessenberg form modulo as many primes below 2^31 as a bound on the coefficients asks for,
   blocks of primes being Spark tasks, and Chinese remaindering.
3. The largest real roots: all roots are real, so the sign changes of the polynomial moved to a point count the roots above it; intervals are
   halved until each holds one root, then narrowed to 200 bits.
4. Components: inverse iteration in 110-digit decimals towards the null space of scatter less root, a Spark task per root.
5. Whitened values in doubles, and their covariance over the fit list in two more passes.

What moves: each different vector once (copies are put together before they move); per task d * (d + 1) / 2 sums, for d dimensions.
The driver gets d * d numbers and (d + 1) residues per prime, whatever the number of rows. Work on the polynomial
grows with d to the fourth power: hundreds of dimensions are meant, not tens of thousands.

Defined results. Rows with a null vector, or with a null or non-finite entry, are dropped. If lengths differ, the most frequent one counts (of equally
frequent ones the larger), other rows are dropped. Entries beyond 2^50 in size count as 2^50. Components with eigenvalue 0 do not exist
(x / sqrt(0)), so fewer than `components` may be returned, and none for one different vector or an empty table. A root that stands several times has
that many components, any orthonormal basis of their space, numbered together; the sign is such that the first of the largest entries is
positive. Repeated rows, and rows with the same id or none, are each returned. deviation is NULL beyond 38 digits. Other columns
play no part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.llm.common import spark_schema
from wardbook.llm.exact_roots import RealRoots, Root, combined, null_vectors, polynomials_modulo, primes_needed
from wardbook.operators.keep import keep_table

#: Primes of one task.
PRIMES_AT_A_TIME = 16
#: Rows worked at once in a task.
ROWS = 4_096
_LARGEST = float(1 << 50)
_DIGIT = 30

_PARTS = {"i": pa.int64(), "j": pa.int64(), "place": pa.int64(), "digit": pa.int64()}
_PARTIAL = {"i": pa.int64(), "j": pa.int64(), "value": pa.float64()}
_RESIDUES = {"prime": pa.int64(), "residues": pa.list_(pa.int64())}
_VECTORS = "root int, vectors array<array<double>>"
_OUT = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whole(vector: Column, factor: int, offset: int) -> Column:
    """Each entry times `factor`, rounded down, plus `offset`, as long."""
    inside = lambda v: F.least(F.greatest(v * factor, F.lit(-_LARGEST)), F.lit(_LARGEST))
    return F.transform(vector.cast("array<double>"), lambda v: F.floor(inside(v)) + offset)


def usable(rows: DataFrame, factor: int, offset: int, vec_id: str, vector: str) -> DataFrame:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = rows.where(F.col(vector).isNotNull() & finite)
    return kept.select(F.col(vec_id).cast("long").alias("vec_id"), whole(F.col(vector), factor, offset).alias("x"))


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _pieces(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield _matrix(batch.column(0).slice(at, ROWS), dims)


def _products(c: np.ndarray) -> np.ndarray:
    """The sum of c_i c_j over rows, exactly, as Python numbers."""
    if float(np.abs(c).max(initial=0)) ** 2 * max(1, len(c)) < 2.0**53:
        f = c.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    f = c.astype(object)
    return f.T @ f


def _exact_sums(fit: DataFrame, dims: int, part: Callable[[np.ndarray], dict]) -> dict[tuple[int, int], int]:
    """Whole numbers by (i, j) summed over all rows: each task sends its own as digits, Spark adds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for x in _pieces(batches, dims):
            for key, value in part(x).items():
                total[key] = total.get(key, 0) + value
        rows = []
        for (i, j), value in total.items():
            rest, place = abs(value), 0
            while rest:
                rows.append((i, j, place, (rest & ((1 << _DIGIT) - 1)) * (1 if value > 0 else -1)))
                rest, place = rest >> _DIGIT, place + 1
        for at in range(0, len(rows), 8192):
            columns = zip(*rows[at : at + 8192], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _PARTS.values(), strict=True)], names=list(_PARTS))

    summed = fit.select("x").mapInArrow(run, spark_schema(_PARTS)).groupBy("i", "j", "place").agg(F.sum("digit").alias("digit"))
    out: dict[tuple[int, int], int] = {}
    for i, j, place, digit in summed.collect():
        out[i, j] = out.get((i, j), 0) + (digit << (_DIGIT * place))
    return out


@dataclass(frozen=True)
class Fit:
    """What the fit list says. x = base + c; the mean is base + rest / n."""

    n: int
    base: list[int]
    rest: list[int]
    scatter: np.ndarray
    roots: list[Root]
    common: int
    vectors: np.ndarray

    @property
    def values(self) -> np.ndarray:
        """Eigenvalues of the covariance, one per component."""
        return np.array([float(r.value * self.common / self.n**2) for r in self.roots for _ in range(r.times)][: len(self.vectors)])

    @property
    def explained(self) -> np.ndarray:
        trace = int(np.trace(self.scatter))
        return np.array([float(r.value / trace) for r in self.roots for _ in range(r.times)][: len(self.vectors)])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        c = (x - np.array(self.base, np.int64)).astype(float) - np.array([float(Fraction(r, self.n)) for r in self.rest])
        return c @ self.vectors.T / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S)^2."""
        c = x - np.array(self.base, np.int64)
        if (self.n * float(np.abs(c).max(initial=0)) + self.n) ** 2 * x.shape[1] < 2.0**62:
            return pa.array(np.square(c * self.n - np.array(self.rest, np.int64)).sum(axis=1)).cast(pa.decimal128(38, 0), safe=False)
        c = c.astype(object) * self.n - np.array(self.rest, object)
        return pa.array([Decimal(int(v)) if v < 10**38 else None for v in (c * c).sum(axis=1)], pa.decimal128(38, 0))


def scatter(fit: DataFrame, dims: int) -> tuple[int, list[int], list[int], np.ndarray]:
    """n, the rounded-down means, what they leave of the sums, and n * n times the covariance."""
    first = _exact_sums(fit, dims, lambda x: {(-1, -1): len(x), **{(i, -1): int(s) for i, s in enumerate(x.sum(axis=0, dtype=object))}})
    n = first.get((-1, -1), 0)
    sums = [first.get((i, -1), 0) for i in range(dims)]
    base = [s // n for s in sums]
    centre = np.array(base, np.int64)

    def part(x: np.ndarray) -> dict:
        products = _products(x - centre)
        return {(i, j): int(products[i, j]) for i in range(dims) for j in range(i, dims)}

    second = _exact_sums(fit, dims, part)
    rest = [s - n * b for s, b in zip(sums, base, strict=True)]
    out = np.empty((dims, dims), object)
    for i in range(dims):
        for j in range(i, dims):
            out[i, j] = out[j, i] = n * second.get((i, j), 0) - rest[i] * rest[j]
    return n, base, rest, out


def characteristic_polynomial(spark, matrix: np.ndarray) -> list[int]:
    """Coefficients of det(x - matrix), the constant first, for a matrix without negative eigenvalues; blocks of primes are tasks."""
    moduli = primes_needed(matrix)
    blocks = [(moduli[at : at + PRIMES_AT_A_TIME],) for at in range(0, len(moduli), PRIMES_AT_A_TIME)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                found = polynomials_modulo(matrix, block)
                yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))], names=list(_RESIDUES))

    work = spark.createDataFrame(blocks, "primes array<bigint>").repartition(len(blocks))
    residues = dict(tuple(r) for r in work.mapInArrow(run, spark_schema(_RESIDUES)).collect())
    return combined(moduli, [residues[q] for q in moduli])


def _components(spark, matrix: np.ndarray, roots: list[Root]) -> list[list[float]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column(0).to_pylist():
                kinds = [pa.int32(), pa.list_(pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip([at, null_vectors(matrix, roots[at])], kinds, strict=True)], names=["root", "vectors"])

    work = spark.createDataFrame([(i,) for i in range(len(roots))], "root int").repartition(len(roots))
    return [v for r in sorted(work.mapInArrow(run, _VECTORS).collect()) for v in r["vectors"]]


def fitted(fit: DataFrame, dims: int, components: int) -> Fit | None:
    """None if no component has an eigenvalue above 0."""
    n, base, rest, found = scatter(fit, dims)
    common = math.gcd(*[int(v) for v in found.ravel()])
    if common == 0:
        return None
    reduced = found // common
    roots = RealRoots(characteristic_polynomial(fit.sparkSession, reduced)).largest(components)
    vectors = np.array(_components(fit.sparkSession, reduced, roots)[:components])
    return Fit(n, base, rest, found, roots, common, vectors)


def identity_error(fit: DataFrame, dims: int, model: Fit) -> float:
    """The largest entry of the whitened fit list's covariance less the identity; values are centred before they are multiplied."""

    def summed(part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((0, 0))
            for x in _pieces(batches, dims):
                found = part(model.whitened(x))
                total = found if not total.size else total + found
            i, j = (v.ravel() for v in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip((i, j, total.ravel()), _PARTIAL.values(), strict=True)], names=list(_PARTIAL))

        rows = fit.select("x").mapInArrow(run, spark_schema(_PARTIAL)).groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
        out = np.zeros((max(r["i"] for r in rows) + 1, max(r["j"] for r in rows) + 1))
        for i, j, value in rows:
            out[i, j] = value
        return out / model.n

    mean = summed(lambda w: w.sum(axis=0, keepdims=True))
    covariance = summed(lambda w: (w - mean).T @ (w - mean))
    return float(np.abs(covariance - np.eye(len(covariance))).max())


def whiten(rows: DataFrame, factor: int = 64, offset: int = 1_000_000, components: int = 16, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each row that takes part and each component."""
    spark = rows.sparkSession
    kept = usable(rows, factor, offset, vec_id, vector)
    length = kept.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    dims = length["size"] if length else 0
    kept = kept.where(F.size("x") == dims)
    model = None
    if dims:
        fit = keep_table(kept.select("x").distinct())
        model = fitted(fit, dims, components)
    if model is None:
        return spark.createDataFrame([], _OUT)
    error, explained = identity_error(fit, dims, model), model.explained

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(explained)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = _matrix(part.column(1), dims)
                each = pa.array(np.repeat(np.arange(len(x)), k))
                columns = [
                    part.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(x) * k, model.n), pa.int64()),
                    model.deviation(x).take(each),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(x) * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return kept.mapInArrow(run, _OUT)

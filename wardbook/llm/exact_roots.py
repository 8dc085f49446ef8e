"""Helpers of the whitening on whole numbers of any size: characteristic polynomials modulo primes, real roots, null vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext
from fractions import Fraction

import numpy as np

#: A root is known when its interval is this much narrower than its value (a power of two).
ROOT_BITS = 200
#: Decimal digits of the elimination.
DIGITS = 110


def primes() -> Iterator[int]:
    """The primes below 2^31, from the largest."""

    def is_prime(n: int) -> bool:
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):  # enough below 3.2 * 10^9
            x = pow(base, odd, n)
            if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
                return False
        return True

    return (n for n in range(2**31 - 1, 3, -2) if is_prime(n))


def polynomials_modulo(matrix: np.ndarray, moduli: Sequence[int]) -> np.ndarray:
    """Coefficients, the constant first, of det(x - matrix) modulo each prime: one row per prime."""
    p = np.array(moduli, np.int64)
    h = np.stack([(matrix % int(q)).astype(np.int64) for q in moduli])
    _hessenberg(h, p)
    n, at = h.shape[1], p[:, None]
    # One polynomial per leading block, each from all before it.
    found = [np.zeros((len(p), n + 1), np.int64)]
    found[0][:, 0] = 1
    for k in range(n):
        now = np.roll(found[k], 1, axis=1)
        now[:, 0] = 0
        now = (now - h[:, k, k, None] * found[k]) % at
        chain = np.ones(len(p), np.int64)
        for i in range(1, k + 1):
            chain = chain * h[:, k - i + 1, k - i] % p
            now = (now - (chain * h[:, k - i, k] % p)[:, None] * found[k - i]) % at
        found.append(now)
    return found[n]


def _hessenberg(h: np.ndarray, p: np.ndarray) -> None:
    """Similar matrices that are zero below the first subdiagonal, all primes at once."""
    each, at = np.arange(len(p)), p[:, None, None]
    for k in range(h.shape[1] - 2):
        pivot = k + 1 + (h[:, k + 1 :, k] != 0).argmax(axis=1)
        h[each, pivot], h[:, k + 1] = h[:, k + 1].copy(), h[each, pivot].copy()
        h[each, :, pivot], h[:, :, k + 1] = h[:, :, k + 1].copy(), h[each, :, pivot].copy()
        factor = h[:, k + 2 :, k] * _inverse(h[:, k + 1, k], p)[:, None] % p[:, None]
        h[:, k + 2 :] = (h[:, k + 2 :] - factor[:, :, None] * h[:, None, k + 1]) % at
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2 :] * factor[:, None, :] % at).sum(axis=2)) % p[:, None]


def _inverse(values: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.array([pow(int(v), -1, int(q)) if v else 0 for v, q in zip(values, p, strict=True)], np.int64)


def primes_needed(matrix: np.ndarray) -> list[int]:
    """Primes whose product exceeds twice any coefficient: for roots >= 0 none is above (1 + trace / n) ** n."""
    n = len(matrix)
    bits = n * (math.log2(int(np.trace(matrix)) + n) - math.log2(n)) * (1 + 1e-9) + 3 if n else 1
    out, have = [], 0.0
    for q in primes():
        if have > bits:
            return out
        out.append(q)
        have += math.log2(q)
    raise OverflowError("the matrix needs more primes than there are below 2^31")


def combined(moduli: Sequence[int], residues: Sequence[Sequence[int]]) -> list[int]:
    """The coefficients from their residues, by Chinese remainders; of either sign."""
    out, product = [0] * len(residues[0]), 1
    for q, row in zip(moduli, residues, strict=True):
        inverse = pow(product, -1, q)
        out = [c + product * ((int(r) - c) * inverse % q) for c, r in zip(out, row, strict=True)]
        product *= q
    return [c - product if 2 * c > product else c for c in out]


@dataclass(frozen=True)
class Root:
    """`times` roots in (low, high] (one point if equal)."""

    low: Fraction
    high: Fraction
    times: int

    @property
    def value(self) -> Fraction:
        return (self.low + self.high) / 2


class RealRoots:
    """The positive roots of a polynomial whose roots are all real, the largest first.

    Such a polynomial, moved so that a becomes 0, has exactly as many roots above a as its coefficients change sign, so intervals
    are halved by that count until one root is left in each; a single root is then narrowed by the polynomial's sign.
    """

    def __init__(self, coefficients: Sequence[int]):
        self.c = list(coefficients)
        self.degree = len(self.c) - 1

    def above(self, m: int, e: int) -> int:
        """How many roots are above m * 2^e."""
        c = self._scaled(e)
        m = m if e < 0 else m << e
        for i in range(self.degree):
            for j in range(self.degree - 1, i - 1, -1):
                c[j] += m * c[j + 1]
        signs = [v > 0 for v in c if v]
        return sum(a != b for a, b in zip(signs, signs[1:], strict=False))

    def _scaled(self, e: int) -> list[int]:
        return [v << (-e * (self.degree - i)) for i, v in enumerate(self.c)] if e < 0 else list(self.c)

    def _sign(self, m: int, e: int) -> int:
        value, m = 0, m if e < 0 else m << e
        for v in reversed(self._scaled(e)):
            value = value * m + v
        return (value > 0) - (value < 0)

    def largest(self, wanted: int) -> list[Root]:
        """Roots until `wanted` are listed, each as often as it stands."""
        top = sum(abs(v) for v in self.c[:-1]).bit_length() + 1
        if self.degree:  # the sum of the roots bounds each of them
            top = min(top, abs(self.c[-2]).bit_length() + 1)
        found, listed = [], 0
        todo = [(0, top, self.above(0, 0), 0)]
        while todo and listed < wanted:
            m, e, at_low, at_high = todo.pop()
            n = at_low - at_high
            if n == 0:
                continue
            if n == 1 or (m and m.bit_length() > ROOT_BITS):
                found.append(self._narrowed(m, e) if n == 1 else _root(m, e, n))
                listed += n
                continue
            middle = self.above(2 * m + 1, e - 1)
            todo += [(2 * m, e - 1, at_low, middle), (2 * m + 1, e - 1, middle, at_high)]
        return found

    def _narrowed(self, m: int, e: int) -> Root:
        low = self._sign(m, e)
        base = None if low else self.above(m, e)
        while m.bit_length() <= ROOT_BITS:
            m, e = 2 * m, e - 1
            sign = self._sign(m + 1, e)
            if sign == 0 and (base is None or self.above(m + 1, e) < base):
                return Root(*[Fraction(m + 1) * Fraction(2) ** e] * 2, 1)
            # The root is above the middle if the sign has not changed there.
            if sign == low if base is None else self.above(m + 1, e) == base:
                m += 1
                low, base = (sign, None) if base is not None and sign else (low, base)
        return _root(m, e, 1)


def _root(m: int, e: int, times: int) -> Root:
    step = Fraction(2) ** e
    return Root(m * step, (m + 1) * step, times)


def null_vectors(matrix: np.ndarray, root: Root, rounds: int = 4) -> list[list[float]]:
    """Orthonormal vectors that the matrix multiplies by the root, by inverse iteration in decimals of `DIGITS` digits."""
    n = len(matrix)
    with localcontext(Context(prec=DIGITS, Emax=10**9, Emin=-(10**9))):
        shift = Decimal(root.value.numerator) / Decimal(root.value.denominator)
        a = np.array([[Decimal(int(v)) for v in row] for row in matrix], object).reshape(n, n)
        a[np.arange(n), np.arange(n)] -= shift
        tiny = (abs(shift) + 1) * Decimal(10) ** -(DIGITS - 5)
        order = np.arange(n)
        for k in range(n):
            best = max(range(k, n), key=lambda i: abs(a[i, k]))
            if best != k:
                a[[k, best]], order[[k, best]] = a[[best, k]], order[[best, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < n:
                a[k + 1 :, k] /= a[k, k]
                a[k + 1 :, k + 1 :] -= a[k + 1 :, k, None] * a[None, k, k + 1 :]
        # Start vectors without a pattern of their own; the same in every run.
        vectors = [np.array([Decimal((i * i * 7919 + i * 104729 * (t + 1) + 31 * t) % 1009 + 1) for i in range(n)], object) for t in range(root.times)]
        for _ in range(rounds):
            vectors = _orthonormal([_solved(a, v[order]) for v in vectors])
        return [[float(x) for x in _signed(v)] for v in vectors]


def _solved(lu: np.ndarray, b: np.ndarray) -> np.ndarray:
    b, n = b.copy(), len(b)
    for k in range(n):
        b[k + 1 :] -= lu[k + 1 :, k] * b[k]
    for k in range(n - 1, -1, -1):
        b[k] /= lu[k, k]
        b[:k] -= lu[:k, k] * b[k]
    return b


def _orthonormal(vectors: list[np.ndarray]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for v in vectors:
        v = v / max(abs(x) for x in v)
        for _ in range(2):
            for u in out:
                v = v - u * sum(u * v)
        out.append(v / sum(v * v).sqrt())
    return out


def _signed(v: np.ndarray) -> np.ndarray:
    """The first of the largest entries is positive."""
    largest = max(abs(x) for x in v)
    first = next(x for x in v if abs(x) > largest * Decimal("0.999999"))
    return v if first > 0 else -v

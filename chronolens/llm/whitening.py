"""Embedding whitening with the exact characteristic polynomial of the integer scatter.

Components become integers y = floor(64 * c); adding the 1,000,000 that the result's x has
moves no covariance. Over the fit list (each distinct vector once, n of them) the sums S of
y and of its products are exact integers, so n * sum(y y') - S S', which is n**2 times the
covariance, is the matrix of the centred vectors without any rounding. Then:

1. Its characteristic polynomial: modulo each of enough 31-bit primes the matrix is reduced
   to Hessenberg form and the polynomial read off it (a task for some primes); Chinese
   remaindering gives the integer coefficients. Enough is more than the largest coefficient,
   which the trace bounds, as the matrix has no negative eigenvalue. The number of zero
   roots, and so the rank, is exact.
2. Its largest roots to ``BITS`` binary digits: all roots are real, so the sign changes
   among the coefficients of p(z + m) are the number of roots above m, with multiplicity;
   integers m of the scaled variable separate the roots, the sign of p halves the rest.
3. A component is the null space of the matrix less its root: solved in ``DIGITS`` decimal
   digits by elimination and inverse iteration, a task for some roots. Roots that ``BITS``
   digits don't tell apart share a space, of which an orthonormal basis is taken.

Rows are then whitened with the components as doubles: n * y - S, an exact integer, over n,
projected, over the root of the eigenvalue. The covariance of the whitened fit list is
measured in one more pass.

The driver holds dim**2 sums, dim coefficients a prime and the components: bounded by the
dimension, not by the rows. Its part grows with the dimension's fourth power or so: a
second or two at 64, too long far beyond some hundreds.

Defined results: vectors null, empty, or with null or non-finite entries are left out; rows
with a null or repeated vec_id give their own rows; equal vectors are fitted once;
components with eigenvalue zero are not returned, so constant or single vectors, and an
empty table, give no rows; vectors of several lengths, and entries that do not fit a long,
are errors. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction
from itertools import combinations_with_replacement
from math import comb, prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow, written
from .vectors import dimension, integers, matrix

SCALE = 64
BITS, DIGITS = 200, 120
_EXACT = 1 << 53


def products(y: np.ndarray) -> np.ndarray:
    """y' y of integers, exact: in doubles by blocks whose sums stay below 2**53, else in Python's integers."""
    top = max(1, int(np.abs(y).max(initial=0)))
    rows = _EXACT // (top * top)
    if rows < 1:
        big = y.astype(object)
        return big.T @ big
    out = np.zeros((y.shape[1], y.shape[1]), object)
    for a in range(0, len(y), rows):
        part = y[a:a + rows].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def moments(fit: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, sums of products) over the rows of ``fit``; tasks add up their rows, Spark the tasks."""
    pairs = list(combinations_with_replacement(range(dim), 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for batch in batches:
            y = matrix(batch.column("x"), dim)
            n += len(y)
            total += y.astype(object).sum(0) if len(y) else 0
            square += products(y)
        if n:
            values = [n, *total, *[square[i, j] for i, j in pairs]]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array([str(int(v)) for v in values], pa.string())], names=["at", "v"])

    sums = arrow(fit.select("x"), run, "at int, v string").groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    found = {r["at"]: int(r.v) for r in sums.collect()}  # dim squared values at most
    if not found:
        return 0, [0] * dim, np.zeros((dim, dim), object)
    square = np.zeros((dim, dim), object)
    for k, (i, j) in enumerate(pairs):
        square[i, j] = square[j, i] = found[1 + dim + k]
    return found[0], [found[1 + d] for d in range(dim)], square


def primes(count: int) -> list[int]:
    """The largest primes below 2**31."""
    def is_prime(p: int) -> bool:
        d, s = p - 1, 0
        while d % 2 == 0:
            d, s = d // 2, s + 1
        for a in (2, 3, 5, 7):  # enough below 3.2 * 10**9
            x = pow(a, d, p)
            if x not in (1, p - 1) and all((x := x * x % p) != p - 1 for _ in range(s - 1)):
                return False
        return True

    out, p = [], (1 << 31) - 1
    while len(out) < count:
        if is_prime(p):
            out.append(p)
        p -= 2
    return out


def polynomial_modulo(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(z - a) modulo ``p``, the constant first: by Hessenberg form."""
    h = np.array([[int(v) % p for v in row] for row in a], np.int64)
    n = len(h)
    for m in range(1, n - 1):
        found = np.flatnonzero(h[m:, m - 1])
        if not len(found):
            continue
        if found[0]:
            i = m + found[0]
            h[[m, i]] = h[[i, m]]
            h[:, [m, i]] = h[:, [i, m]]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * u % p).sum(1)) % p
    poly = np.zeros((n + 1, n + 1), np.int64)
    poly[0, 0] = 1
    for k in range(1, n + 1):
        factor, t = [], 1
        for i in range(k - 1, 0, -1):
            t = t * int(h[i, i - 1]) % p
            factor.append(t * int(h[i - 1, k - 1]) % p)
        new = np.roll(poly[k - 1], 1) - int(h[k - 1, k - 1]) * poly[k - 1] % p
        if factor:
            new -= (np.array(factor[::-1], np.int64)[:, None] * poly[:k - 1] % p).sum(0) % p
        poly[k] = new % p
    return poly[n]


def symmetric_functions(spark: SparkSession, a: np.ndarray) -> list[int]:
    """e_0, e_1, ... of the eigenvalues of a matrix without negative ones: det(z - a) is the sum of (-1)**k e_k z**(n - k)."""
    n, trace = len(a), int(sum(a[i, i] for i in range(len(a))))
    # with a given sum, e_k is largest where all are equal
    bits = max(comb(n, k) * (-(-trace // n) ** k) for k in range(n + 1)).bit_length() + 1
    moduli = primes(-(-bits // 30))
    held = spark.sparkContext.broadcast(([[int(v) for v in row] for row in a], moduli))  # bounded by the dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, moduli = held.value
            own = [moduli[i] for i in batch.column("id").to_pylist()]
            rests = [polynomial_modulo(np.array(a, object), p).tolist() for p in own]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(rests, pa.list_(pa.int64()))], names=["p", "rests"])

    tasks = min(len(moduli), 4 * spark.sparkContext.defaultParallelism)
    rows = arrow(spark.range(0, len(moduli), 1, tasks), run, "p long, rests array<long>").collect()  # dim + 1 numbers a prime
    whole = prod(moduli)
    parts = [(r.rests, (whole // r.p) * pow(whole // r.p, -1, r.p)) for r in rows]
    return [sum((-1) ** k * rests[n - k] * unit for rests, unit in parts) % whole for k in range(n + 1)]


def above(poly: list[int], m: int) -> int:
    """How many roots of a polynomial (highest first) with real roots alone lie above ``m``: the sign changes of p(z + m)."""
    c = list(poly)
    for end in range(len(c), 1, -1):
        for i in range(1, end):
            c[i] += m * c[i - 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def value(poly: list[int], m: int) -> int:
    out = 0
    for c in poly:
        out = out * m + c
    return out


def largest_roots(e: list[int], most: int, bits: int = BITS) -> list[tuple[Fraction, int]]:
    """(root, multiplicity) of the largest roots, ``most`` with multiplicity or more, but none that is zero."""
    rank = max(k for k, v in enumerate(e) if v)
    if not rank:
        return []
    most = min(most, rank)
    shift = max(0, bits - e[1].bit_length())
    poly = [(-1) ** k * (v << shift * k) for k, v in enumerate(e[:rank + 1])]  # of z = root * 2**shift, zero roots divided out
    # (low, high, roots above low, roots above high): the roots of an interval lie in (low, high]
    open_, out = [(0, (e[1] << shift) + 1, rank, 0)], []
    while open_ and sum(n for _, _, n in out) < most:
        low, high, over_low, over_high = open_.pop()  # the highest interval
        if over_low - over_high == 1 or high - low == 1:
            if over_low - over_high == 1:
                sign = value(poly, high) > 0  # p keeps its sign from the root on to ``high``, unless the root is there
                while high - low > 1 and value(poly, high):
                    mid = (low + high) // 2
                    v = value(poly, mid)
                    if not v:
                        low, high = mid, mid
                    elif (v > 0) == sign:
                        high = mid
                    else:
                        low = mid
                    if low == high:
                        break
            exact = not value(poly, high)
            out.append((low, high, over_low - over_high) if not exact else (high, high, over_low - over_high))
            continue
        mid = (low + high) // 2
        over = above(poly, mid)
        if over_low > over:
            open_.append((low, mid, over_low, over))
        if over > over_high:
            open_.append((mid, high, over, over_high))
    return [(Fraction(low + high, 2 << shift), n) for low, high, n in out]


def null_space(a: list[list[int]], root: Fraction, size: int, digits: int = DIGITS) -> list[list[float]]:
    """``size`` orthonormal vectors that (a - root) nearly sends to zero: elimination once, then inverse iteration."""
    with localcontext() as context:
        context.prec = digits
        n = len(a)
        shift = Decimal(root.numerator) / Decimal(root.denominator)
        u = [[Decimal(v) for v in row] for row in a]
        for i in range(n):
            u[i][i] -= shift
        tiny = max(max(map(abs, row)) for row in u).scaleb(-digits + 5) or Decimal(1).scaleb(-digits)
        moves = []
        for k in range(n):
            best = max(range(k, n), key=lambda i: abs(u[i][k]))
            u[k], u[best] = u[best], u[k]
            if abs(u[k][k]) < tiny:
                u[k][k] = tiny
            top = u[k]
            factors = []
            for i in range(k + 1, n):
                f = u[i][k] / top[k]
                factors.append(f)
                if f:
                    row = u[i]
                    for j in range(k + 1, n):
                        row[j] -= f * top[j]
            moves.append((best, factors))

        def solve(b: list[Decimal]) -> list[Decimal]:
            for k, (best, factors) in enumerate(moves):
                b[k], b[best] = b[best], b[k]
                for i, f in enumerate(factors, k + 1):
                    if f:
                        b[i] -= f * b[k]
            for k in range(n - 1, -1, -1):
                b[k] = (b[k] - sum(x * y for x, y in zip(u[k][k + 1:], b[k + 1:]))) / u[k][k]
            return b

        found: list[list[Decimal]] = []
        for c in range(size):
            v = [Decimal((7919 * i + 104729 * c + 31 * i * i) % 1009 - 504) for i in range(n)]
            for _ in range(3):
                v = solve(v)
                for _ in range(2):
                    for w in found:
                        s = sum(x * y for x, y in zip(v, w))
                        v = [x - s * y for x, y in zip(v, w)]
                length = sum(x * x for x in v).sqrt()
                v = [x / length for x in v]
            found.append(v)
        out = []
        for v in found:
            lead = max(v, key=abs)
            out.append([float(x if lead > 0 else -x) for x in v])
        return out


def components(spark: SparkSession, a: np.ndarray, most: int) -> tuple[np.ndarray, list[Fraction]]:
    """(dim, m) unit eigenvectors of the m <= ``most`` largest positive eigenvalues, and these."""
    e = symmetric_functions(spark, a)
    roots = largest_roots(e, most)
    held = spark.sparkContext.broadcast(([[int(v) for v in row] for row in a], [(r, min(n, most)) for r, n in roots]))  # bounded by the dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, roots = held.value
            for i in batch.column("id").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([null_space(a, *roots[i])], pa.list_(pa.list_(pa.float64())))], names=["at", "vectors"])

    if not roots:
        return np.zeros((len(a), 0)), []
    rows = sorted(arrow(spark.range(0, len(roots), 1, len(roots)), run, "at long, vectors array<array<double>>").collect())
    flat = [(v, roots[r["at"]][0]) for r in rows for v in r.vectors][:most]
    return np.array([v for v, _ in flat]).T, [r for _, r in flat]


def whitened(vectors: DataFrame, most: int = 16) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error); see the module's text.

    ``vectors`` has vec_id and embedding. ``deviation`` is decimal(38,0), the sum over
    dimensions of (n * x - S)**2."""
    spark = vectors.sparkSession
    names = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = integers(vectors, SCALE)
    _, dim = dimension(rows)
    fit, _ = written(rows.select("x").distinct(), "whitening-fit")
    n, total, square = moments(fit, dim)
    scatter = n * square - np.outer(np.array(total, object), np.array(total, object)) if n else square
    basis, roots = components(spark, scatter, most) if n > 1 else (np.zeros((dim, 0)), [])
    if not roots:
        return spark.createDataFrame([], names)
    trace = int(sum(scatter[d, d] for d in range(dim)))
    spread = np.array([float(r / (n * n)) for r in roots])
    explained = np.array([float(r / trace) for r in roots])
    model = spark.sparkContext.broadcast((total, basis / np.sqrt(spread), explained))  # bounded by the dimension

    def centred(column: pa.Array) -> np.ndarray:
        """n * y - S, exact."""
        y = matrix(column, dim)
        if n * (int(np.abs(y).max(initial=0)) + 1) + max(map(abs, total)) < 1 << 62:
            return n * y - np.array(total, np.int64)
        return n * y.astype(object) - np.array(total, object)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(roots) + 1, len(roots)))
        for batch in batches:
            w = (centred(batch.column("x")).astype(np.float64) / n) @ model.value[1]
            out[0] += w.sum(0)
            out[1:] += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(out.size), pa.int32()), pa.array(out.ravel())], names=["at", "v"])

    m = len(roots)
    found = {r["at"]: r.v for r in arrow(fit, measure, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()}
    sums = np.array([found[i] for i in range((m + 1) * m)]).reshape(m + 1, m) / n
    error = float(np.abs(sums[1:] - np.outer(sums[0], sums[0]) - np.eye(m)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, basis, explained = model.value
        for batch in batches:
            z = centred(batch.column("x"))
            if z.dtype != object and dim * int(np.abs(z).max(initial=0)) ** 2 < 1 << 62:
                deviation = pa.array((z * z).sum(1)).cast(pa.decimal128(38, 0))
            else:
                deviation = pa.array([Decimal(int(v)) for v in (z.astype(object) ** 2).sum(1)], pa.decimal128(38, 0))
            w = (z.astype(np.float64) / n) @ basis
            k = len(z)
            at = pa.array(np.repeat(np.arange(k), m))
            yield pa.RecordBatch.from_arrays(
                [pc.take(batch.column("vec_id"), at), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), k)), pa.array(np.full(k * m, n)), pc.take(deviation, at),
                 pa.array(w.ravel()), pa.array(np.tile(explained, k)), pa.array(np.full(k * m, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return arrow(rows, run, names)

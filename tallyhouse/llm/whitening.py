"""Embedding whitening by the exact characteristic polynomial of the integer scatter matrix.

Entries become whole numbers x = floor(1024 c) + 100000. Spark sums x and the
products of x exactly, which gives the scatter matrix M = n sum(x x') - S S', a
matrix of whole numbers, n^2 times the covariance. Its characteristic polynomial is computed
modulo many primes, one row of a Spark job each: reduction to Hessenberg form, then
the polynomial's recurrence. Chinese remaindering joins the residues; Maclaurin's
inequality bounds the coefficients and so the number of primes. All roots are
real, so the sign changes of the polynomial shifted to a count the roots above a
exactly; bisection isolates the largest roots and refines them to 2^-PRECISION of
the trace. Each component is an approximate null vector of M - root, by inverse
iteration in fixed-point whole numbers, with equal roots kept orthogonal.

The driver holds the d x d matrix and the polynomial only; the work there is of order
d^3 for each component and grows with d, not with rows. Rows are read once for the sums and
once for the whitened values, which are written to the shared folder; their covariance is then
measured from what was written, means first.

Defined cases: rows with a null vector, an empty one, or a null or non-finite entry take no part;
so do rows whose entries reach 2^33, as their products do not fit exact sums. Vectors of another length than the
most common one (the longer of equally common ones) take no part. Rows that repeat, share an id or
have none are rows like any other. A component with no variance cannot be whitened and is left out,
so fewer than `components` come back when the rank is lower; no rows, or rows that are all
equal, give no rows. `deviation` is null where it does not fit 64 bits. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import scaled_vectors, usable_vectors, written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LARGEST = float(1 << 33)  # entries below it keep exact sums of 2^36 rows within 38 digits
PRECISION = 160  # bits of a root below the trace
WORK = 256  # fraction bits of the inverse iteration


@dataclass(frozen=True)
class Fit:
    """The fit list's size, sums of x, trace of M, components as rows, and their eigenvalues of the covariance."""

    n: int
    sums: list[int]
    trace: int
    vectors: np.ndarray
    values: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.values / (self.trace / self.n**2)


def _exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a' b of whole numbers as Python integers; partial products that doubles hold exactly go through BLAS."""
    most = max(int(np.abs(a).max(initial=0)), 1) * max(int(np.abs(b).max(initial=0)), 1)
    step = max((1 << 53) // most, 1)
    total = np.zeros((a.shape[1], b.shape[1]), dtype=object)
    for at in range(0, len(a), step):
        total += (a[at : at + step].astype(np.float64).T @ b[at : at + step].astype(np.float64)).astype(np.int64)
    return total


def products(y: np.ndarray) -> np.ndarray:
    """y' y in Python integers; large numbers are cut into three limbs first."""
    if int(np.abs(y).max(initial=0)) < 1 << 26:
        return _exact_product(y, y)
    limbs = [y & 0xFFFF, (y >> 16) & 0xFFFF, y >> 32]
    return sum((_exact_product(a, b) << (16 * (i + j)) for i, a in enumerate(limbs) for j, b in enumerate(limbs)), np.zeros((y.shape[1],) * 2, dtype=object))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each pair of dimensions (i, j) of a task: sum of products; j = -1: sum; i = j = -1: rows."""
    import decimal

    n, sums, total = 0, 0, 0
    for batch in batches:
        if batch.num_rows:
            y = scaled_vectors(batch, SCALE)
            n, sums, total = n + len(y), sums + y.astype(object).sum(axis=0), total + products(y)
    if n:
        d = len(sums)
        i, j = np.tril_indices(d)
        wide = decimal.Context(prec=38)
        amounts = [n, *sums.tolist(), *total[i, j].tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([-1, *range(d), *i.tolist()], type=pa.int32()), pa.array([-1, *[-1] * d, *j.tolist()], type=pa.int32()),
                pa.array([wide.create_decimal(a) for a in amounts], type=pa.decimal128(38, 0)),
            ],
            names=["i", "j", "amount"],
        )


def moments(rows: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums and products of x - SHIFT over the fit list; d^2 numbers come to the driver."""
    parts = rows.select("embedding").mapInArrow(_moments, "i int, j int, amount decimal(38,0)")
    found = {(r.i, r.j): int(r.amount) for r in parts.groupBy("i", "j").agg(F.sum("amount").alias("amount")).collect()}
    if not found:
        return 0, [], []
    d = max(i for i, _ in found) + 1
    return found[-1, -1], [found[i, -1] for i in range(d)], [[found[max(i, j), min(i, j)] for j in range(d)] for i in range(d)]


def scatter(n: int, sums: list[int], total: list[list[int]]) -> list[list[int]]:
    return [[n * t - a * b for b, t in zip(sums, row)] for a, row in zip(sums, total)]


# The polynomial modulo a prime.


def _is_prime(n: int) -> bool:
    """Miller's test; these bases decide all numbers below 2^32."""
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """The largest primes below 2^31 whose product passes 2^bits; products of two residues fit 64 bits."""
    out, have, p = [], 0.0, (1 << 31) - 1
    while have <= bits:
        if _is_prime(p):
            out.append(p)
            have += math.log2(p)
        p -= 2
    return out


def hessenberg(m: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix modulo p without entries below the first subdiagonal."""
    h = m % p
    for k in range(len(h) - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1]) % p
        # The inverse step on the columns; each product is reduced before the sum, which then fits 64 bits.
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(axis=1)) % p
    return h


def characteristic(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - m) modulo p, constant first."""
    h, d = hessenberg(m, p), len(m)
    polynomials = np.zeros((d + 1, d + 1), dtype=np.int64)
    polynomials[0, 0] = 1
    for k in range(d):
        row = -h[k, k] * polynomials[k] % p
        row[1:] += polynomials[k, :-1]
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            row = (row - int(h[i, k]) * chain % p * polynomials[i]) % p
        polynomials[k + 1] = row % p
    return polynomials[d]


def _bits(trace: int, d: int) -> int:
    """Bits that hold every coefficient: the k-th symmetric function of d numbers from 0 with this sum is at most C(d, k) (sum / d)^k."""
    mean = max(trace, 1) / d if trace < 1 << 1000 else trace // d
    return int(max(math.log2(math.comb(d, k)) + k * max(math.log2(mean), 0) for k in range(d + 1))) + 3


def polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Coefficients of det(x - m), constant first, for a positive semidefinite matrix of whole numbers."""
    d = len(m)
    chosen = primes(_bits(sum(m[i][i] for i in range(d)), d))

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("p").to_pylist():
                reduced = np.array([[v % p for v in row] for row in m], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([p], type=pa.int64()), pa.array([characteristic(reduced, p).tolist()], type=pa.list_(pa.int64()))], names=["p", "c"])

    numbered = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(min(len(chosen), spark.sparkContext.defaultParallelism))
    found = {r.p: r.c for r in numbered.mapInArrow(residues, "p long, c array<long>").collect()}
    product = math.prod(chosen)
    shares = [(product // p) * pow(product // p, -1, p) for p in chosen]
    joined = [sum(s * found[p][k] for s, p in zip(shares, chosen)) % product for k in range(d + 1)]
    return [c - product if c > product // 2 else c for c in joined]


# Roots.


def _shifted(c: list[int], a: int) -> list[int]:
    """Coefficients of p(x + a)."""
    out = list(c)
    for i in range(len(out) - 1):
        for k in range(len(out) - 2, i - 1, -1):
            out[k] += a * out[k + 1]
    return out


def _scaled(c: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2^bits times those of c."""
    return [v << (bits * (len(c) - 1 - k)) for k, v in enumerate(c)]


def roots_above(c: list[int], a: int) -> int:
    """Roots larger than a of a polynomial with real roots only: the sign changes of p(x + a), by Descartes' rule."""
    signs = [v > 0 for v in _shifted(c, a) if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _value(c: list[int], a: int) -> int:
    out = 0
    for v in reversed(c):
        out = out * a + v
    return out


def largest_roots(c: list[int], count: int, trace: int, precision: int = PRECISION) -> tuple[list[int], int]:
    """The `count` largest roots that are not zero, falling and as often as they occur, as multiples of 2^-bits; and bits.

    A root is isolated by counts; alone in its interval, it is refined by signs.
    """
    bits = max(precision - trace.bit_length(), 0) + 8
    while c and not c[0]:  # roots that are zero
        c = c[1:]
    fine, top = _scaled(c, bits), (trace + 1) << bits
    counts = {0: len(c) - 1, top: 0}
    out: list[int] = []
    for k in range(1, min(count, len(c) - 1) + 1):
        low = max(a for a, n in counts.items() if n >= k)
        high = min(a for a, n in counts.items() if n < k and a > low)
        while high - low > 1 and counts[low] - counts[high] > 1:
            middle = (low + high) // 2
            counts[middle] = roots_above(fine, middle)
            low, high = (middle, high) if counts[middle] >= k else (low, middle)
        if counts[low] - counts[high] == 1 and high - low > 1:
            at_high = _value(fine, high) > 0
            if not _value(fine, high):  # a root that is exactly the end, which the count does not hold as above it
                low = high - 1
            while high - low > 1:
                middle = (low + high) // 2
                value = _value(fine, middle)
                if not value:
                    low, high = middle - 1, middle
                elif (value > 0) == at_high:
                    high = middle
                else:
                    low = middle
        out.append(high)
    return out, bits


# Components.


def _solve(m: np.ndarray, b: np.ndarray) -> np.ndarray:
    """m v = b in fixed point (WORK fraction bits), with row pivots; a pivot of zero becomes the smallest step."""
    a = np.concatenate([m, b[:, None]], axis=1)
    d = len(m)
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
        if not a[k, k]:
            a[k, k] = 1
        if k + 1 < d:
            factor = np.array([(v << WORK) // a[k, k] for v in a[k + 1 :, k]], dtype=object)
            a[k + 1 :, k:] -= (factor[:, None] * a[k, k:]) >> WORK
    v = np.zeros(d, dtype=object)
    for k in range(d - 1, -1, -1):
        rest = a[k, d] - (int((a[k, k + 1 : d] * v[k + 1 :]).sum()) >> WORK)
        v[k] = (rest << WORK) // a[k, k]
    return v


def _unit(v: np.ndarray) -> np.ndarray:
    """A vector of length 2^WORK."""
    drop = max(max(abs(int(x)).bit_length() for x in v) - 2 * WORK, 0)
    v = np.array([int(x) >> drop for x in v], dtype=object)
    length = math.isqrt(int((v * v).sum()))
    return np.array([(int(x) << WORK) // length for x in v], dtype=object)


def null_vectors(m: list[list[int]], roots: list[int], bits: int, trace: int) -> list[np.ndarray]:
    """A unit vector (2^WORK) for each root by inverse iteration; vectors of roots that lie close are kept orthogonal."""
    d, out = len(m), []
    shift = WORK - trace.bit_length()  # the matrix is scaled to a trace of about one

    def at_work(v: int, have: int) -> int:
        by = shift - have
        return v << by if by >= 0 else v >> -by

    scaled = np.array([[at_work(v, 0) for v in row] for row in m], dtype=object)
    for k, root in enumerate(roots):
        near = [j for j in range(k) if abs(roots[j] - root) << 40 < root]
        moved = scaled.copy()
        moved[range(d), range(d)] -= at_work(root, bits)
        v = np.array([((k * d + i) * 2654435761 % 1009 + 1) << (WORK - 10) for i in range(d)], dtype=object)
        for _ in range(3):
            for j in near:
                v = v - ((int((v * out[j]).sum()) >> WORK) * out[j] >> WORK)
            v = _unit(_solve(moved, v))
        for j in near:
            v = v - ((int((v * out[j]).sum()) >> WORK) * out[j] >> WORK)
        out.append(_unit(v))
    return out


def fitted(rows: DataFrame, components: int = COMPONENTS) -> Fit:
    """The components of usable rows."""
    n, sums, total = moments(rows)
    m = scatter(n, sums, total)
    trace = sum(m[i][i] for i in range(len(m)))
    if not trace:
        return Fit(n, [s + n * SHIFT for s in sums], 0, np.zeros((0, len(m))), np.zeros(0))
    roots, bits = largest_roots(polynomial(rows.sparkSession, m), components, trace)
    vectors = null_vectors(m, roots, bits, trace)
    return Fit(
        n, [s + n * SHIFT for s in sums], trace, np.array([[int(x) / (1 << WORK) for x in v] for v in vectors]),
        np.array([root / (n * n << bits) for root in roots]),
    )


def _projected(rows: DataFrame, fit: Fit) -> DataFrame:
    """vec_id, deviation and the whitened values of each row."""
    shifted = [s - fit.n * SHIFT for s in fit.sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = scaled_vectors(batch, SCALE)
            most = fit.n * int(np.abs(y).max()) + max(map(abs, shifted))
            kind = np.int64 if most**2 * y.shape[1] < 1 << 63 else object
            apart = y.astype(kind) * fit.n - np.array(shifted, dtype=kind)
            deviation = [v if v < 1 << 63 else None for v in (apart * apart).sum(axis=1).tolist()]
            values = (apart.astype(np.float64) / fit.n) @ fit.vectors.T / np.sqrt(fit.values)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(deviation, type=pa.int64()), pa.array(values.tolist(), type=pa.list_(pa.float64()))], names=["vec_id", "deviation", "whitened"]
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(projected: DataFrame, k: int) -> float:
    """Largest absolute entry of the whitened values' covariance minus the identity; means first."""
    at = [F.get("whitened", i) for i in range(k)]
    means = projected.agg(*[F.avg(c) for c in at]).first()
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    centred = [c - F.lit(float(m)) for c, m in zip(at, means)]
    found = projected.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, found))


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """rows (vec_id, embedding) whitened: a row for each vector and component."""
    kept = usable_vectors(rows.select("vec_id", "embedding"), LARGEST)
    fit = fitted(kept, components)
    kind = rows.schema["vec_id"].dataType.simpleString()
    if not len(fit.values):
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    projected = written(_projected(kept, fit), "whitened")
    error = identity_error(projected, len(fit.values))
    explained = F.array(*[F.lit(float(e)) for e in fit.explained])
    each = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )

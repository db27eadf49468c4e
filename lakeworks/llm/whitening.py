"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become integers, so the scatter ``n * sum(x x') - S S'`` (n squared times the covariance) is an integer
matrix, summed exactly whatever the number of rows. Its characteristic polynomial is found modulo many primes, by
Hessenberg reduction, and put together by Chinese remaindering; the primes are dealt over tasks. As the matrix is
symmetric, all roots are real, so the sign changes of the polynomial shifted to a point count the roots beyond it:
bisection isolates them, and Newton steps within exact brackets refine them to ``BITS`` bits. Each eigenvector is
found by inverse iteration on the null space in fixed-point numbers of ``FIXED`` bits, again one task a component.
Rounding to doubles comes last.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.llm.textops import limit_batches, release

#: entries are ``floor(SCALE * c) + SHIFT``; ``SCALE * c`` beyond ``LARGEST`` in size counts as that
SCALE, SHIFT, LARGEST = 64, 1_000_000, 1 << 62
#: relative precision of a root, and the bits behind the point in the elimination, both beyond any double
BITS, FIXED = 120, 320
#: rows and bits of a digit whose products a double sums exactly: 2 * 20 + 12 < 53
_ROWS, _DIGIT = 4096, 20
#: bits of the pieces in which sums are shuffled, and residues per row of primes
_LIMB, _PRIMES = 32, 8


# ------------------------------------------------------------------ exact sums


def integers(vectors: np.ndarray) -> np.ndarray:
    """``floor(64 * c)`` as int64 (the shift cancels out of all centred values)."""
    return np.clip(np.floor(vectors * float(SCALE)), -float(LARGEST), float(LARGEST)).astype(np.int64)


def _digits(y: np.ndarray) -> list[np.ndarray]:
    """Signed digits of ``_DIGIT`` bits, lowest first, as doubles; as few as the largest entry takes."""
    out = []
    while True:
        low = y & ((1 << _DIGIT) - 1)
        top = y >> _DIGIT
        if not len(y) or (-(1 << _DIGIT) <= int(y.min()) and int(y.max()) < 1 << _DIGIT):
            return [*out, y.astype(np.float64)]
        out.append(low.astype(np.float64))
        y = top


def scatter_sums(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``sum(y y')`` and ``sum(y)`` as exact integers (object arrays)."""
    d = y.shape[1]
    cross, total = np.zeros((d, d), object), np.zeros(d, object)
    for at in range(0, len(y), _ROWS):
        digits = _digits(y[at : at + _ROWS])
        for a, left in enumerate(digits):
            total += left.sum(axis=0).astype(np.int64).astype(object) << (_DIGIT * a)
            for b, right in enumerate(digits):
                cross += (left.T @ right).astype(np.int64).astype(object) << (_DIGIT * (a + b))
    return cross, total


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """``(place, piece)`` of a number, the sign in every piece: sums of pieces stay within a long."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        piece = value & ((1 << _LIMB) - 1)
        if piece:
            yield place, sign * piece
        value, place = value >> _LIMB, place + 1


def usable(column: Column) -> Column:
    """Vectors without null, NaN or infinite entries."""
    v = F.transform(column, lambda c: c.cast("double"))
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return column.isNotNull() & ~F.coalesce(bad, F.lit(False)) & (F.size(column) > 0)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


class Scatter(NamedTuple):
    """Exact sums over the fit list, of the entries before the shift."""

    n: int
    sums: list[int]
    #: ``n * sum(y y') - sum(y) sum(y)'``
    centred: list[list[int]]


def scatter(vectors: DataFrame, d: int) -> Scatter:
    """The sums over ``vectors(v array<double>)`` of ``d`` entries each. A task passes on one row per entry of the upper
    triangle and piece of its value; the driver gets as many."""
    upper = [(i, j) for i in range(d) for j in range(i, d)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cross, total = 0, np.zeros((d, d), object), np.zeros(d, object)
        for batch in batches:
            y = integers(_matrix(batch.column(0), d))
            more = scatter_sums(y)
            n, cross, total = n + len(y), cross + more[0], total + more[1]
        values = [n, *total, *(cross[i, j] for i, j in upper)]
        rows = [(k, place, piece) for k, value in enumerate(values) for place, piece in _limbs(int(value))]
        if rows:
            k, place, piece = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int32()), pa.array(place, pa.int32()), pa.array(piece, pa.int64())], names=["k", "place", "piece"]
            )
        release()

    pieces = vectors.select("v").mapInArrow(run, "k int, place int, piece long").groupBy("k", "place").agg(F.sum("piece").alias("piece"))
    values = [0] * (1 + d + len(upper))
    for r in pieces.collect():
        values[r["k"]] += r["piece"] << (_LIMB * r["place"])
    n, sums = values[0], values[1 : d + 1]
    centred = [[0] * d for _ in range(d)]
    for (i, j), value in zip(upper, values[d + 1 :]):
        centred[i][j] = centred[j][i] = n * value - sums[i] * sums[j]
    return Scatter(n, sums, centred)


# ------------------------------------------------------------------ polynomial


def primes_below(start: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``start`` (at most 2**31: a product of two residues fits a long)."""
    small, out, at = _sieve(math.isqrt(start) + 1), [], start - 1
    while len(out) < count and at > 1:
        if all(at % p for p in small if p * p <= at):
            out.append(at)
        at -= 1
    return out


def _sieve(limit: int) -> list[int]:
    flags = np.ones(limit, bool)
    flags[:2] = False
    for p in range(2, math.isqrt(limit) + 1):
        if flags[p]:
            flags[p * p :: p] = False
    return np.flatnonzero(flags).tolist()


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, lowest first, of ``det(x - matrix)`` modulo the prime ``p``; ``matrix`` holds residues."""
    h, d = matrix.astype(np.int64) % p, len(matrix)
    for k in range(d - 2):  # to Hessenberg form by similar matrices
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[pivot, k + 1]] = h[[k + 1, pivot]]
            h[:, [pivot, k + 1]] = h[:, [k + 1, pivot]]
        factors = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factors[:, None] * h[k + 1][None, :]) % p
        # the inverse step on the columns, a product at a time below p
        gained = np.zeros(d, np.int64)
        for f, column in zip(factors, h[:, k + 2 :].T):
            gained = (gained + f * column) % p
        h[:, k + 1] = (h[:, k + 1] + gained) % p
    polys = [np.zeros(d + 1, np.int64)]
    polys[0][0] = 1
    for k in range(d):  # characteristic polynomials of the leading blocks
        new = np.roll(polys[k], 1)
        new[0] = 0
        new = (new - h[k, k] * polys[k]) % p
        below = 1
        for i in range(k - 1, -1, -1):
            below = below * int(h[i + 1, i]) % p
            if not below:
                break
            new = (new - int(h[i, k]) * below % p * polys[i]) % p
        polys.append(new)
    return polys[d]


def _needed_primes(matrix: list[list[int]]) -> list[int]:
    """Primes whose product exceeds twice any coefficient: the k-th symmetric sum of roots that are not negative is at
    most C(d, k) * (trace / d) ** k."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    mean = -(-trace // d)
    bits = max((math.comb(d, k) * max(1, mean) ** k).bit_length() for k in range(d + 1)) + 2
    return primes_below(1 << 31, -(-bits // 30))


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients, lowest first, of the monic ``det(x - matrix)`` of a symmetric integer matrix without negative
    roots. Tasks take some primes each; the residues (primes x dimensions) reach the driver."""
    primes, d = _needed_primes(matrix), len(matrix)
    shared = spark.sparkContext.broadcast([[str(x) for x in row] for row in matrix])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array([[int(x) for x in row] for row in shared.value], object)
        for batch in batches:
            for p in batch.column(0).to_pylist():
                found = polynomial_modulo((exact % p).astype(np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([found.tolist()], pa.list_(pa.int64()))], names=["p", "c"])

    parts = -(-len(primes) // _PRIMES)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(parts)
    residues = {r["p"]: r["c"] for r in rows.mapInArrow(run, "p long, c array<long>").collect()}
    shared.unpersist()
    values, modulus = [0] * (d + 1), 1
    for p in primes:  # Garner's step: the value so far plus a multiple of the primes so far
        inverse = pow(modulus, -1, p)
        values = [v + modulus * ((c - v) * inverse % p) for v, c in zip(values, residues[p])]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values]


# ------------------------------------------------------------------ roots


def _sign_changes(values: list[int]) -> int:
    signs = [v > 0 for v in values if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _scaled(poly: list[int], bits: int) -> list[int]:
    """``2**(bits*d) * poly(x / 2**bits)``, with integer coefficients."""
    d = len(poly) - 1
    return [c << (bits * (d - k)) for k, c in enumerate(poly)]


def roots_above(poly: list[int], at: int, bits: int = 0) -> int:
    """Roots above ``at / 2**bits``, counted as often as they are roots. All roots must be real: then the sign changes of
    the polynomial shifted there are exactly their number."""
    c = _scaled(poly, bits) if bits else list(poly)
    d = len(c) - 1
    for k in range(d):
        for i in range(d - 1, k - 1, -1):
            c[i] += at * c[i + 1]
    return _sign_changes(c)


def _value(poly: list[int], at: int, bits: int) -> tuple[int, int]:
    """The polynomial and its derivative at ``at / 2**bits``, times ``2**(bits*d)`` and ``2**(bits*(d-1))``."""
    value = slope = 0
    for k, c in enumerate(reversed(poly)):
        slope = slope * at + value
        value = value * at + (c << (bits * k))
    return value, slope


def _refined(poly: list[int], low: int, high: int, bits: int, above: int) -> Fraction:
    """The one simple root in ``(low, high] / 2**bits``, to ``BITS`` bits. ``above``: roots above ``high``; the sign of the
    polynomial on either side follows from it."""
    goal = bits + max(0, BITS + 8 - max(1, high).bit_length())
    low, high, bits = low << (goal - bits), high << (goal - bits), goal
    right = above % 2 == 0  # positive just right of the root
    at = (low + high) >> 1
    while high - low > 1:
        value, slope = _value(poly, at, bits)
        if value == 0:
            return Fraction(at, 1 << bits)
        if (value > 0) == right:
            high = at
        else:
            low = at
        if high - low <= 1:
            break
        # Newton's point, and next to it on the root's other side, so that both ends close in
        guess = at - value // slope if slope else (low + high) >> 1
        width = max(1, (high - low) >> 40)
        guess = guess + width if low == at else guess - width
        at = guess if low < guess < high and abs(guess - at) * 4 < high - low else (low + high) >> 1
    return Fraction(2 * low + 1, 2 << bits)


class Root(NamedTuple):
    value: Fraction
    times: int


def real_roots(poly: list[int]) -> list[Root]:
    """The roots of a polynomial whose roots are all real and not negative, largest first, each to ``BITS`` bits
    (relative); roots that do not differ in these bits are one of that multiplicity. 0 is exact."""
    zeros = next(k for k, c in enumerate(poly) if c)
    rest = poly[zeros:]
    out: list[Root] = []
    if len(rest) > 1:
        top = 1
        while roots_above(rest, top):
            top <<= 1
        # (low, high, bits, roots above low, roots above high), all roots in (0, top]
        stack = [(0, top, 0, len(rest) - 1, 0)]
        while stack:
            low, high, bits, more, above = stack.pop()
            n = more - above
            if not n:
                continue
            if n == 1 and low:
                out.append(Root(_refined(rest, low, high, bits, above), 1))
            elif low and (high - low) << BITS <= low:
                out.append(Root(Fraction(low + high, 2 << bits), n))
            else:
                low, high, bits = low * 2, high * 2, bits + 1
                middle = (low + high) // 2
                between = roots_above(rest, middle, bits)
                stack.append((low, middle, bits, more, between))
                stack.append((middle, high, bits, between, above))
    out.sort(key=lambda r: -r.value)
    return [*out, *([Root(Fraction(0), zeros)] if zeros else [])]


# ------------------------------------------------------------------ components


def null_vectors(matrix: list[list[int]], root: Fraction, times: int) -> list[list[float]]:
    """``times`` orthogonal unit vectors of the null space of ``matrix - root``, by inverse iteration in fixed point. The
    largest entry of each is positive."""
    d, one = len(matrix), 1 << FIXED
    size = max(1, max(abs(x) for row in matrix for x in row)).bit_length()
    shift = (root.numerator << FIXED) // root.denominator
    rows = np.array([[(x << FIXED) for x in row] for row in matrix], object)
    for i in range(d):
        rows[i, i] -= shift
    rows = np.array([[x >> size for x in row] for row in rows], object)  # entries of about 1
    order = list(range(d))
    for k in range(d):  # elimination with partial pivoting; the factors stay below the diagonal
        pivot = max(range(k, d), key=lambda i: abs(rows[i, k]))
        if pivot != k:
            rows[[k, pivot]] = rows[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if rows[k, k] == 0:
            rows[k, k] = 1  # the least number there is: a null direction
        if k + 1 < d:
            factors = np.array([(x << FIXED) // rows[k, k] for x in rows[k + 1 :, k]], object)
            rows[k + 1 :, k + 1 :] -= (factors[:, None] * rows[k, k + 1 :][None, :]) >> FIXED
            rows[k + 1 :, k] = factors

    def unit(v):
        norm = math.isqrt(int((v * v).sum()))
        return np.array([(int(x) << FIXED) // max(1, norm) for x in v], object)

    found: list[np.ndarray] = []
    for t in range(times):
        # any start will do that is not orthogonal to what is left of the null space
        v = unit(np.array([one * (1 + (7 * i * (t + 1) + t) % 11) for i in range(d)], object))
        for _ in range(3):
            x = v[order]
            for k in range(d):
                x[k + 1 :] -= (rows[k + 1 :, k] * x[k]) >> FIXED
            for k in range(d - 1, -1, -1):
                x[k] = ((int(x[k]) - (int((rows[k, k + 1 :] * x[k + 1 :]).sum()) >> FIXED)) << FIXED) // rows[k, k]
            big = max(1, max(abs(int(c)) for c in x).bit_length() - FIXED)
            x = unit(np.array([int(c) >> big if big > 1 else int(c) for c in x], object))
            for _ in range(2):
                for other in found:
                    x = x - ((other * (int((x * other).sum()) >> FIXED)) >> FIXED)
            v = unit(x)
        found.append(v)
    out = []
    for v in found:
        sign = 1 if max(v, key=abs) > 0 else -1
        out.append([sign * int(c) / one for c in v])
    return out


class Whitening(NamedTuple):
    """A fitted whitening. Eigenvalues are those of the covariance; ``vectors`` has a row per component."""

    n: int
    sums: list[int]
    eigenvalues: list[float]
    explained: list[float]
    vectors: list[list[float]]


def fit(vectors: DataFrame, d: int, components: int) -> Whitening:
    """The leading components of ``vectors(v array<double>)`` of ``d`` entries each; a table without rows gives none."""
    spark = vectors.sparkSession
    exact = scatter(vectors, d)
    n, matrix = exact.n, exact.centred
    if not n:
        return Whitening(0, exact.sums, [], [], [])
    roots, wanted, at = real_roots(characteristic_polynomial(spark, matrix)), [], 0
    for root in roots:
        take = min(root.times, components - at)
        if take > 0:
            wanted.append((at, str(root.value.numerator), str(root.value.denominator), take))
            at += take
    shared = spark.sparkContext.broadcast([[str(x) for x in row] for row in matrix])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [[int(x) for x in row] for row in shared.value]
        for batch in batches:
            for first, top, bottom, times in zip(*(c.to_pylist() for c in batch.columns)):
                found = null_vectors(whole, Fraction(int(top), int(bottom)), times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(first, first + times), pa.int32()), pa.array(found, pa.list_(pa.float64()))], names=["k", "v"]
                )

    rows = spark.createDataFrame(wanted, "k int, top string, bottom string, times int").repartition(len(wanted))
    found = {r["k"]: list(r["v"]) for r in rows.mapInArrow(run, "k int, v array<double>").collect()}
    shared.unpersist()
    trace = sum(matrix[i][i] for i in range(d))
    each = [root.value for root in roots for _ in range(root.times)][: len(found)]
    return Whitening(
        n,
        exact.sums,
        [float(r / (n * n)) for r in each],
        [float(r / trace) if trace else 0.0 for r in each],
        [found[k] for k in range(len(found))],
    )


# ------------------------------------------------------------------ use


def _projector(model: Whitening):
    """``y -> (n * y - S, whitened)``: exact centred integers (times n) and whitened doubles, NaN where there is no
    variance."""
    n, sums = model.n, model.sums
    vectors = np.array(model.vectors).T
    scale = np.array([1 / math.sqrt(e) if e > 0 else math.nan for e in model.eigenvalues])
    small = max((abs(s) for s in sums), default=0) < 1 << 61

    def project(y: np.ndarray):
        if small and len(y) and n * int(np.abs(y).max()) < 1 << 61:
            z = n * y - np.array(sums, np.int64)
        else:
            z = n * y.astype(object) - np.array(sums, object)
        return z, (z / n).astype(np.float64) @ vectors * scale

    return project


def _deviation(z: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; null beyond a long."""
    if z.dtype != object and (not len(z) or int(np.abs(z).max()) ** 2 * z.shape[1] < 1 << 63):
        return (z * z).sum(axis=1).tolist()
    exact = [sum(int(x) ** 2 for x in row) for row in z]
    return [x if x < 1 << 63 else None for x in exact]


def identity_error(vectors: DataFrame, model: Whitening, d: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, summed over all rows, over the
    components that have variance."""
    live = [k for k, e in enumerate(model.eigenvalues) if e > 0]
    if not live:
        return 0.0
    c = len(live)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project = _projector(model)
        total, cross = np.zeros(c), np.zeros((c, c))
        for batch in batches:
            w = project(integers(_matrix(batch.column(0), d)))[1][:, live]
            total, cross = total + w.sum(axis=0), cross + w.T @ w
        values = np.concatenate([total, cross.reshape(-1)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], names=["k", "x"])
        release()

    sums = vectors.select("v").mapInArrow(run, "k int, x double").groupBy("k").agg(F.sum("x").alias("x")).collect()
    values = np.zeros(c + c * c)
    for r in sums:
        values[r["k"]] = r["x"]
    mean = values[:c] / model.n
    return float(np.abs(values[c:].reshape(c, c) / model.n - np.outer(mean, mean) - np.eye(c)).max())


def dimension(vectors: DataFrame) -> int:
    """The commonest length of ``vectors(v)``, the larger one in a tie; 0 without rows."""
    n = vectors.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    found = n.orderBy(F.desc("n"), F.desc("d")).first()
    return found["d"] if found else 0


def whiten(
    table: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per vector and component: ``vec_id, component`` (from 1, by falling eigenvalue), ``n, deviation, whitened,
    explained, identity_error``.

    Rows whose vector is null or empty or holds null, NaN or infinite entries are no part of the fit list and of the
    result, nor are those of another length than the commonest (of two, the larger). ``deviation``: sum over the
    dimensions of ``(n*x - S)**2``, exact, null beyond a long. A component without variance (of equal or linearly
    dependent vectors) has explained 0 and null ``whitened``, and is left out of ``identity_error``. Equal eigenvalues
    have orthogonal components. Ids may be null or repeat, rows too; other columns are ignored; an empty table gives no
    rows. Sums of any size are exact; the driver gets sums (dimensions squared) and residues, never vectors.
    """
    limit_batches(table.sparkSession)
    column = F.col(vector_col)
    rows = table.where(usable(column)).select(F.col(id_col).alias("vec_id"), F.transform(column, lambda c: c.cast("double")).alias("v"))
    d = dimension(rows)
    rows = rows.where(F.size("v") == d)
    model = fit(rows, d, min(components, d)) if d else Whitening(0, [], [], [], [])
    error = identity_error(rows, model, d) if model.n else 0.0
    kind = rows.schema["vec_id"].dataType.simpleString()
    k = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project = _projector(model)
        for batch in batches:
            z, w = project(integers(_matrix(batch.column(1), d)))
            offsets = pa.array(np.arange(len(w) + 1) * k, pa.int32())
            flat = pa.array(w.reshape(-1), pa.float64(), mask=np.isnan(w.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_deviation(z), pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
                names=["vec_id", "deviation", "w"],
            )
        release()

    out = rows.mapInArrow(run, f"vec_id {kind}, deviation long, w array<double>")
    explained = F.array(*[F.lit(x) for x in model.explained]) if k else F.array().cast("array<double>")
    return out.select("vec_id", "deviation", F.posexplode("w").alias("_k", "whitened")).select(
        "vec_id",
        (F.col("_k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("_k")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )

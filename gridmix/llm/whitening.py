"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

The entries of a vector become whole numbers x. Over the fit list (each distinct
x vector once: n vectors with sums S) Spark adds up the products of all pairs of
dimensions, exactly; the scatter A = n * sum(x x') - S S' is n^2 times the
covariance, in whole numbers. Its characteristic polynomial is found modulo many
primes by Hessenberg reduction, one Spark task a few primes, and put together by
Chinese remaindering. A symmetric matrix has real roots only, so the number of
roots above a point is exactly the number of sign changes of the polynomial
shifted there (Descartes' rule): bisection isolates the largest roots and
refines them to ``BITS`` bits. The unit eigenvector of a root is the null vector
of A minus the root, by inverse iteration with ``DIGITS`` decimal digits.

What reaches the driver is bounded by the number of dimensions d: the scatter
(d^2 whole numbers), d + 1 remainders a prime, and the components. Time of the
polynomial is d^3 for each of about d / 31 * (bits of an entry) primes.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm.common import pick, stored

#: The grid of the entries: x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Relative width to which a root is refined; roots nearer than that count as one of their number.
BITS = 128
#: Working digits of inverse iteration, well beyond BITS.
DIGITS = 110
#: Inverse iteration ends when the square of what a turn moves a vector by is below.
SETTLED = Decimal(10) ** -50
COMPONENTS = 16
#: Entries beyond have no x of type long.
LARGEST = float(1 << 62)

ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double"


@dataclass
class Model:
    """Of the fit list: its size, sums of x - OFFSET, and by falling eigenvalue the unit
    components (rows), eigenvalues and their shares of the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: list[float]
    explained: list[float]


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, y) with y = x - OFFSET = floor(SCALE * c), of the rows that take part.

    Rows go whose vector is null or empty, holds null or non-finite entries or
    entries whose x is no long, or has another length than most of the vectors
    that are left (ties: the longer length).
    """
    entries = pick(vectors, id_col, vector_col).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("c"))
    sound = F.forall("c", lambda c: F.coalesce(F.abs(c * SCALE) <= LARGEST, F.lit(False)))
    entries = entries.where(F.col("c").isNotNull() & (F.size("c") > 0)).where(sound)
    length = entries.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return entries.where(F.size("c") == (length["d"] if length else 0)).select(
        "vec_id", F.transform("c", lambda c: F.floor(c * SCALE)).alias("y"))


def matrix(batch: pa.RecordBatch, column: str = "y") -> np.ndarray:
    """The equally long arrays of a column, as rows of whole numbers."""
    values = batch.column(batch.schema.get_field_index(column))
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def cross(y: np.ndarray) -> np.ndarray:
    """y' y in exact whole numbers: in doubles while all sums fit 53 bits, else in Python's."""
    if int(np.abs(y).max(initial=0)) ** 2 * len(y) < 1 << 53:
        return (y.T.astype(float) @ y.astype(float)).astype(np.int64).astype(object)
    return y.T.astype(object) @ y.astype(object)


def sums_of_products(fit: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, sum of y y') over the rows of ``fit``, exact; tasks add up their rows first.

    Sums beyond 38 digits raise an error.
    """
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            y = matrix(batch)
            n += len(y)
            small = int(np.abs(y).max(initial=0)) * len(y) < 1 << 62
            sums = sums + (y if small else y.astype(object)).sum(axis=0).astype(object)
            products = products + cross(y)
        if n:
            values = [n, *sums.tolist(), *products[upper].tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(values)), pa.int32()), pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))],
                ["place", "total"])

    totals = fit.select("y").mapInArrow(run, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total"))
    found = {r["place"]: int(r["total"]) for r in totals.collect()}  # 1 + d + d (d + 1) / 2 rows
    products = np.zeros((d, d), object)
    for at, (i, j) in enumerate(zip(*upper)):
        products[i, j] = products[j, i] = found.get(1 + d + at, 0)
    return found.get(0, 0), [found.get(1 + i, 0) for i in range(d)], products


def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top``, by sieving spans downwards."""
    root = math.isqrt(top) + 1
    sieve = np.ones(root + 1, bool)
    sieve[:2] = False
    for i in range(2, math.isqrt(root) + 1):
        if sieve[i]:
            sieve[i * i::i] = False
    small, out, span = np.flatnonzero(sieve).tolist(), [], 1 << 16
    while len(out) < count:
        low = top - span
        own = np.ones(span, bool)
        for p in small:
            own[-low % p::p] = False
        out += [low + int(i) for i in np.flatnonzero(own)[::-1]]
        top = low
    return out[:count]


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``a`` modulo the prime ``p`` (below 2^31), zero under the subdiagonal."""
    a = a % p
    for k in range(len(a) - 2):
        below = np.flatnonzero(a[k + 1:, k])
        if not len(below):
            continue
        pivot, r = k + 1, k + 1 + int(below[0])
        if r != pivot:
            a[[pivot, r]] = a[[r, pivot]]
            a[:, [pivot, r]] = a[:, [r, pivot]]
        factors = a[k + 2:, k] * pow(int(a[pivot, k]), -1, p) % p
        a[k + 2:] = (a[k + 2:] - factors[:, None] * a[pivot] % p) % p
        a[:, pivot] = (a[:, pivot] + (a[:, k + 2:] * factors % p).sum(axis=1)) % p
    return a


def polynomial_modulo(a: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - a) modulo ``p``, the constant first."""
    h, d = hessenberg(a, p), len(a)
    leading = np.zeros((d + 1, d + 1), np.int64)  # row m: the polynomial of the first m rows and columns
    leading[0, 0] = 1
    for m in range(1, d + 1):
        own = np.roll(leading[m - 1], 1) - h[m - 1, m - 1] * leading[m - 1] % p
        weights, chain = np.zeros(m - 1, np.int64), 1
        for i in range(m - 2, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            weights[i] = chain * int(h[i, m - 1]) % p
        leading[m] = (own - (weights[:, None] * leading[:m - 1] % p).sum(axis=0)) % p
    return leading[d].tolist()


def over_tasks(spark: SparkSession, count: int, work: Callable[[int], dict], schema: str, arrow: pa.Schema) -> list:
    """``work(i)`` for i from 0 to ``count`` - 1, each in some task; the rows ordered by i."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"at": i, **work(i)} for i in batch.column(0).to_pylist()], schema=arrow)

    parts = max(1, min(count, 4 * spark.sparkContext.defaultParallelism))
    return sorted(spark.range(0, count, 1, parts).mapInArrow(run, schema).collect(), key=lambda r: r["at"])


def characteristic_polynomial(spark: SparkSession, a: np.ndarray) -> list[int]:
    """Coefficients of det(x - a), the constant first, of a symmetric ``a`` without negative
    eigenvalues, in whole numbers."""
    d, trace = len(a), int(sum(a.diagonal()))
    # By Maclaurin's inequality the coefficients' sizes add up to (1 + trace / d)^d at most.
    bound = 2 * (1 + -(-trace // d)) ** d + 1
    primes = primes_below(1 << 31, bound.bit_length() // 30 + 1)
    rows = a.tolist()

    def work(i: int) -> dict:
        p = primes[i]
        return {"coefficients": polynomial_modulo(np.array([[v % p for v in row] for row in rows], np.int64), p)}

    found = over_tasks(spark, len(primes), work, "at long, coefficients array<long>",
                       pa.schema([("at", pa.int64()), ("coefficients", pa.list_(pa.int64()))]))
    product = math.prod(primes)
    shares = [product // p * pow(product // p, -1, p) for p in primes]
    whole = [sum(s * r for s, r in zip(shares, column)) % product
             for column in zip(*[r["coefficients"] for r in found])]
    return [c - product if 2 * c > product else c for c in whole]


def roots_above(coefficients: list[int], at: int, bits: int) -> int:
    """Number of roots above ``at`` / 2^``bits`` of a polynomial whose roots are all real."""
    top = len(coefficients) - 1
    shifted = [c << bits * (top - i) for i, c in enumerate(coefficients)]  # roots times 2^bits
    for i in range(top):
        for j in range(top - 1, i - 1, -1):
            shifted[j] += at * shifted[j + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def sign_at(coefficients: list[int], at: int, bits: int) -> int:
    value, top = 0, len(coefficients) - 1
    for i in range(top, -1, -1):
        value = value * at + (coefficients[i] << bits * (top - i))
    return (value > 0) - (value < 0)


def largest_roots(coefficients: list[int], most: int) -> list[tuple[Fraction, int]]:
    """(root, multiplicity), falling, of the largest positive roots, until ``most`` are counted.

    All roots are real and none is negative. A root is within 2^-BITS of its size.
    """
    zeros = next(i for i, c in enumerate(coefficients) if c)
    own = coefficients[zeros:]  # without the roots that are zero
    degree = len(own) - 1
    if not degree:
        return []
    top = 1 << (-own[-2]).bit_length()  # the sum of the roots is minus the second coefficient
    # (low, high, bits, roots above low, roots above high): roots in (low, high] / 2^bits; the highest last.
    todo, out, counted = [(0, top, 0, degree, 0)], [], 0
    while todo and counted < most:
        low, high, bits, above_low, above_high = todo.pop()
        many = above_low - above_high
        if not many:
            continue
        narrow = (high - low) << BITS <= low
        if many == 1 and not narrow:
            root = refined(own, low, high, bits)
        elif narrow:
            root = Fraction(low + high, 1 << bits + 1)
        else:
            low, high, bits = 2 * low, 2 * high, bits + 1
            middle = (low + high) // 2
            above = roots_above(own, middle, bits)
            todo += [(low, middle, bits, above_low, above), (middle, high, bits, above, above_high)]
            continue
        out.append((root, many))
        counted += many
    return out


def refined(coefficients: list[int], low: int, high: int, bits: int) -> Fraction:
    """The single root in (low, high] / 2^bits, by bisection on the sign."""
    end = sign_at(coefficients, high, bits)
    if not end:
        return Fraction(high, 1 << bits)
    while (high - low) << BITS > low:
        low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        sign = sign_at(coefficients, middle, bits)
        if not sign:
            return Fraction(middle, 1 << bits)
        low, high = (low, middle) if sign == end else (middle, high)
    return Fraction(low + high, 1 << bits + 1)


def null_space(a: list[list[int]], root: Fraction, count: int) -> list[list[float]]:
    """``count`` orthogonal unit vectors that a - root takes to zero, by inverse iteration."""
    d = len(a)
    with decimal.localcontext(decimal.Context(prec=DIGITS, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)):
        m = np.array([[Decimal(v) for v in row] for row in a], object)
        value = Decimal(root.numerator) / Decimal(root.denominator)
        scale = value * Decimal(10) ** -(DIGITS - 5)  # stands in for a pivot that is zero
        for i in range(d):
            m[i, i] -= value
        order = list(range(d))
        for k in range(d):
            r = max(range(k, d), key=lambda i: abs(m[i, k]))
            if r != k:
                m[[k, r]] = m[[r, k]]
                order[k], order[r] = order[r], order[k]
            if not m[k, k]:
                m[k, k] = scale
            if k + 1 < d:
                m[k + 1:, k] = m[k + 1:, k] / m[k, k]
                m[k + 1:, k + 1:] = m[k + 1:, k + 1:] - np.outer(m[k + 1:, k], m[k, k + 1:])

        def solve(b: np.ndarray) -> np.ndarray:
            x = b[order].copy()
            for k in range(d):
                x[k + 1:] = x[k + 1:] - m[k + 1:, k] * x[k]
            for k in range(d - 1, -1, -1):
                x[k] = x[k] / m[k, k]
                x[:k] = x[:k] - m[:k, k] * x[k]
            return x

        start = np.random.default_rng(d).integers(1, 1 << 30, (count, d))
        found = [np.array([Decimal(int(v)) for v in row], object) for row in start]
        for turn in range(40):
            before, found = found, [solve(v) for v in found]
            for i in range(count):
                for _ in range(2):  # a second pass removes what rounding of the first left
                    for u in found[:i]:
                        found[i] = found[i] - u * (u @ found[i])
                    found[i] = found[i] / (found[i] @ found[i]).sqrt()
            if turn and all(abs(1 - sum((u @ v) ** 2 for u in before)) < SETTLED for v in found):
                break
        return [[float(c) for c in v] for v in found]


def fitted(fit: DataFrame, components: int = COMPONENTS) -> Model | None:
    """The model of a fit list (``y``: distinct vectors); None if it is empty or never varies."""
    first = fit.first()
    if first is None:
        return None
    d = len(first["y"])
    n, sums, products = sums_of_products(fit, d)
    a = n * products - np.outer(np.array(sums, object), np.array(sums, object))
    trace = int(sum(a.diagonal()))
    if not trace:
        return None
    common = math.gcd(*[int(v) for v in a.ravel()])
    a = a // common
    spark = fit.sparkSession
    roots = largest_roots(characteristic_polynomial(spark, a), components)
    rows = a.tolist()
    found = over_tasks(spark, len(roots), lambda i: {"vectors": null_space(rows, *roots[i])},
                       "at long, vectors array<array<double>>",
                       pa.schema([("at", pa.int64()), ("vectors", pa.list_(pa.list_(pa.float64())))]))
    pairs = [(v, root) for r, (root, _) in zip(found, roots) for v in r["vectors"]][:components]
    units = np.array([v for v, _ in pairs])
    units *= np.sign(units[np.arange(len(units)), np.abs(units).argmax(axis=1)])[:, None]  # the largest entry is positive
    return Model(n, sums, units, [float(root * common / n ** 2) for _, root in pairs],
                 [float(root * common / trace) for _, root in pairs])


def centred(y: np.ndarray, model: Model) -> np.ndarray:
    """n * x - S, in exact whole numbers."""
    if int(np.abs(y).max(initial=0)) * model.n + max(map(abs, model.sums)) < 1 << 62:
        return y * np.int64(model.n) - np.array(model.sums, np.int64)
    return y.astype(object) * model.n - np.array(model.sums, object)


def projected(own: np.ndarray, model: Model) -> np.ndarray:
    """Whitened values of rows n * x - S, a column for each component."""
    return (own.astype(float) / model.n) @ (model.components / np.sqrt(model.eigenvalues)[:, None]).T


def identity_error(fit: DataFrame, model: Model) -> float:
    """Largest absolute entry of the covariance of the fit list's whitened values, minus the identity.

    Batches centre their own rows; the differences of their means are added in a second term.
    """
    k = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(k + k * k)
        for batch in batches:
            w = projected(centred(matrix(batch), model), model)
            if len(w):
                mean = w.mean(axis=0)
                spread = (w - mean).T @ (w - mean) + len(w) * np.outer(mean, mean)
                totals += np.concatenate((len(w) * mean, spread.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(totals)), pa.int32()), pa.array(totals)], ["place", "total"])

    totals = fit.select("y").mapInArrow(run, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    found = {r["place"]: r["total"] for r in totals.collect()}  # k + k^2 rows
    mean = np.array([found[i] for i in range(k)]) / model.n
    spread = np.array([found[k + i] for i in range(k * k)]).reshape(k, k) / model.n - np.outer(mean, mean)
    return float(np.abs(spread - np.eye(k)).max())


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row that
    takes part (see :func:`quantised`) and every component up to ``components``.

    Components are numbered from 1 by falling eigenvalue. Those with eigenvalue
    zero are left out, as nothing can be divided by its root: fewer dimensions,
    or vectors within a plane, give fewer components; one distinct vector, an
    empty table or one without sound vectors give no rows. Of equal eigenvalues
    the vectors are some orthonormal base. Rows that repeat count once in the fit
    and are all returned; rows with a null id too; extra columns are left out. A
    deviation beyond the range of a long is null.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col)
    fit = stored(rows.select("y").distinct(), "whitening-fit")
    model = fitted(fit, components)
    if model is None:
        return spark.createDataFrame([], ROWS + ", identity_error double")
    error = identity_error(fit, model)
    k = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = centred(matrix(batch), model)
            values = projected(own, model)
            if int(np.abs(own).max(initial=0)) ** 2 * own.shape[1] < 1 << 63:
                deviations = (own * own).sum(axis=1).tolist()
            else:
                deviations = [v if v < 1 << 63 else None for v in (own.astype(object) ** 2).sum(axis=1).tolist()]
            at, each = np.repeat(np.arange(len(own)), k), np.tile(np.arange(k), len(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(each + 1, pa.int32()), pa.array(np.full(len(at), model.n), pa.int64()),
                 pa.array(deviations, pa.int64()).take(pa.array(at)), pa.array(values.ravel(), pa.float64()),
                 pa.array(np.array(model.explained)[each], pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return rows.mapInArrow(run, ROWS).withColumn("identity_error", F.lit(error))

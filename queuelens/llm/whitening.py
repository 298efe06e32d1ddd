"""Whitening of vectors along exact principal components.

Entries are rounded down to whole numbers of a fixed scale. The scatter matrix of the different
vectors is then a matrix of integers and is added up exactly, in parts, by Spark. Its
characteristic polynomial is found modulo many primes, by reduction to Hessenberg form, as
Spark tasks over blocks of primes; Chinese remaindering gives the integer coefficients. All
roots are real, so by Descartes' rule the sign changes of the polynomial shifted to a point
count the roots above it: that isolates the largest roots, and exact signs narrow them down.
Inverse iteration in long fixed-point numbers gives each root's null vector.

What the driver holds depends on the number of columns alone: the matrix, one polynomial per
prime, and the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelens.session import materialise

SCALE = 256
COMPONENTS = 4
PRIMES_AT_ONCE = 16
APART = 100  # bits: roots that agree to so many are taken for one with several null vectors
DEPTH = 240  # bits to which a root is narrowed down, beside its size
LIMB = 62


def usable(vector: Column) -> Column:
    """True if a vector and all its entries are there and finite."""
    big = F.lit(float("inf"))
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == big))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of every entry, as longs; entries beyond a long become the nearest one."""
    low, high = F.lit(-(2.0**63)), F.lit(2.0**63 - 1024)
    return F.transform(vector, lambda c: F.floor(F.greatest(low, F.least(high, c.cast("double") * scale))))


def exact(x: np.ndarray, most: int) -> np.ndarray:
    """The integers as they are if results up to ``most`` fit in a long, else as Python's own."""
    return x if most < 1 << LIMB else x.astype(object)


def stacked(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), width)


@dataclass(frozen=True)
class Fit:
    """n, the per-column sums, and n * n times the covariance, of the different vectors."""

    n: int
    sums: list[int]
    matrix: list[list[int]]  # n * sum(x x') - sum(x) sum(x)'

    @property
    def width(self) -> int:
        return len(self.sums)


def _added(rows: DataFrame, run) -> dict[int, int]:
    """Integers by place: ``run`` gives batches of (place, limb, value) a task, Spark adds them up."""
    parts = rows.mapInArrow(run, "place bigint, limb int, value bigint")
    total: dict[int, int] = {}
    for r in parts.groupBy("place", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        total[r["place"]] = total.get(r["place"], 0) + (int(r["value"]) << LIMB * r["limb"])
    return total


def _places(values: np.ndarray) -> pa.RecordBatch:
    """Whole numbers by place, cut into as many limbs as each needs; the last has the sign."""
    places, limbs, parts = [], [], []
    for place, v in enumerate(map(int, values.ravel())):
        limb = 0
        while True:
            low = v & ((1 << LIMB) - 1)
            last = -(1 << LIMB) <= v < 1 << LIMB
            places.append(place)
            limbs.append(limb)
            parts.append(v if last else low)
            if last:
                break
            v, limb = v >> LIMB, limb + 1
    return pa.record_batch({"place": pa.array(places, pa.int64()), "limb": pa.array(limbs, pa.int32()), "value": pa.array(parts, pa.int64())})


def scatter(different: DataFrame, n: int, width: int) -> Fit:
    """Sums and scatter of the column ``x`` of ``n`` rows, exact.

    Vectors are centred on the rounded mean before they are multiplied; what the rounding leaves
    is taken off afterwards, in integers.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for batch in batches:
            x = stacked(batch.column(0), width)
            if len(x):
                total = total + exact(x, (int(np.abs(x.astype(float)).max()) + 1) * len(x)).sum(axis=0).astype(object)
        yield _places(total)

    total = _added(different.select("x"), sums)
    centre = [(2 * total[i] + n) // (2 * n) for i in range(width)]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, square = np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            x = stacked(batch.column(0), width)
            if not len(x):
                continue
            far = int(np.abs(x.astype(float)).max()) + max(map(abs, centre)) + 2
            z = exact(x, far) - np.array(centre, dtype=object if far >= 1 << LIMB else np.int64)
            most = max(abs(int(z.min())), abs(int(z.max()))) + 1
            if most * most * len(z) < 1 << 53:  # whole numbers below 2**53 are exact as doubles
                f = z.astype(float)
                square = square + (f.T @ f).astype(np.int64).astype(object)
            else:
                z = exact(z, most * most * len(z))
                square = square + z.T.dot(z).astype(object)
            rest = rest + exact(z, most * len(z)).sum(axis=0).astype(object)
        yield _places(np.concatenate([rest, square.ravel()]))

    found = _added(different.select("x"), products)
    rest = [found[i] for i in range(width)]
    square = [[found[width + i * width + j] for j in range(width)] for i in range(width)]
    matrix = [[n * square[i][j] - rest[i] * rest[j] for j in range(width)] for i in range(width)]
    return Fit(n, [total[i] for i in range(width)], matrix)


def primes(count: int) -> list[int]:
    """The largest ``count`` primes below 2**31, by sieving windows downwards."""
    top, window = 1 << 31, 1 << 16
    small = np.ones(1 << 16, bool)
    small[:2] = False
    for p in range(2, 256):
        if small[p]:
            small[p * p :: p] = False
    divisors = np.flatnonzero(small).tolist()
    out: list[int] = []
    while len(out) < count:
        low = top - window
        free = np.ones(window, bool)
        for p in divisors:
            free[-low % p :: p] = False
        out += (np.flatnonzero(free)[::-1] + low).tolist()
        top = low
    return out[:count]


def hessenberg(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Matrices (k, d, d) modulo primes (k,), made upper Hessenberg by similarity."""
    d = a.shape[1]
    every = np.arange(len(a))
    q = p[:, None, None]
    for j in range(d - 2):
        pivot = j + 1 + np.argmax(a[:, j + 1 :, j] != 0, axis=1)  # per prime; none: all are zero
        rows, row = a[every, pivot].copy(), a[:, j + 1].copy()
        a[every, pivot], a[:, j + 1] = row, rows
        columns, column = a[every, :, pivot].copy(), a[:, :, j + 1].copy()
        a[every, :, pivot], a[:, :, j + 1] = column, columns
        inverse = np.array([pow(int(x), -1, int(m)) if x else 0 for x, m in zip(a[:, j + 1, j], p)], np.int64)
        u = a[:, j + 2 :, j] * inverse[:, None] % p[:, None]
        a[:, j + 2 :] = (a[:, j + 2 :] - u[:, :, None] * a[:, j + 1 : j + 2]) % q
        a[:, :, j + 1] = (a[:, :, j + 1] + (a[:, :, j + 2 :] * u[:, None, :] % q).sum(axis=2)) % p[:, None]
    return a


def characteristic_modulo(matrix: list[list[int]], moduli: list[int]) -> np.ndarray:
    """Coefficients of det(t - matrix) modulo each prime, the constant first: (primes, d + 1)."""
    d = len(matrix)
    p = np.array(moduli, np.int64)
    h = hessenberg(np.array([[[v % m for v in row] for row in matrix] for m in moduli], np.int64).reshape(len(p), d, d), p)
    m = p[:, None]
    poly = np.zeros((d + 1, len(p), d + 1), np.int64)  # of the leading blocks
    poly[0, :, 0] = 1
    for k in range(1, d + 1):
        poly[k, :, 1:] = poly[k - 1, :, :-1]
        new = (poly[k] - h[:, k - 1, k - 1][:, None] * poly[k - 1]) % m
        below = np.ones(len(p), np.int64)
        for i in range(k - 1, 0, -1):
            below = below * h[:, i, i - 1] % p
            factor = below * h[:, i - 1, k - 1] % p
            new = (new - factor[:, None] * poly[i - 1]) % m
        poly[k] = new
    return poly[d]


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(t - matrix), the constant first, of a matrix without negative
    roots. Blocks of primes are tasks."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # the sums of products of k roots are largest if all roots are equal
    bits = max(math.comb(d, k).bit_length() + k * (trace // d + 1).bit_length() for k in range(d + 1)) + 2
    moduli = primes(bits // 30 + 1)
    blocks = [moduli[i : i + PRIMES_AT_ONCE] for i in range(0, len(moduli), PRIMES_AT_ONCE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.column(0).to_pylist():
                found = characteristic_modulo(matrix, blocks[b])
                yield pa.record_batch({
                    "prime": pa.array(blocks[b], pa.int64()), "rest": pa.array(found.tolist(), pa.list_(pa.int64())),
                })

    rows = spark.range(0, len(blocks), 1, len(blocks)).mapInArrow(run, "prime bigint, rest array<bigint>").collect()
    product, values = 1, [0] * (d + 1)
    for row in rows:
        p, inverse = row["prime"], pow(product, -1, row["prime"])
        values = [v + product * ((r - v) * inverse % p) for v, r in zip(values, row["rest"])]
        product *= p
    return [v - product if 2 * v > product else v for v in values]


def roots_above(poly: list[int], at: int, bits: int) -> int:
    """How many roots lie above ``at`` / 2**bits, each as often as it counts. All roots are real, so
    this is the number of sign changes of the polynomial shifted there."""
    d = len(poly) - 1
    c = [v << bits * (d - i) for i, v in enumerate(poly)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += at * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def sign_at(poly: list[int], at: int, bits: int) -> int:
    """The sign of the polynomial at ``at`` / 2**bits."""
    value = 0
    for i, v in enumerate(reversed(poly)):
        value = value * at + (v << bits * i)
    return (value > 0) - (value < 0)


@dataclass(frozen=True)
class Root:
    value: int  # times 2**bits
    bits: int
    times: int  # how many of the wanted roots it stands for


def largest_roots(poly: list[int], count: int) -> list[Root]:
    """The ``count`` largest positive roots, the largest first, to ``DEPTH`` bits."""
    above = roots_above(poly, 0, 0)
    top = 1 << max(1, max((abs(v).bit_length() + len(poly) - 2 - i) // (len(poly) - 1 - i) for i, v in enumerate(poly[:-1])) + 1)
    out: list[Root] = []
    found = 0
    while found < min(count, above):
        low, high, bits = 0, top, 0  # the root number ``found`` + 1 lies above low, not above high
        n_low, n_high = above, 0
        while n_low - n_high > 1 or n_high < found:
            if low and (high - low) << APART <= high:
                break
            if high - low == 1:
                low, high, bits = 2 * low, 2 * high, bits + 1
            middle = (low + high) // 2
            n = roots_above(poly, middle, bits)
            if n > found:
                low, n_low = middle, n
            else:
                high, n_high = middle, n
        times = n_low - n_high
        while times == 1 and (not low or (high - low) << DEPTH > high):
            if high - low == 1:
                low, high, bits = 2 * low, 2 * high, bits + 1
            middle = (low + high) // 2
            # the sign above the root is that of an even or odd number of roots still above
            s = sign_at(poly, middle, bits)
            if s == 0:
                low = high = middle
                break
            if (s > 0) == (n_high % 2 == 0):
                high = middle
            else:
                low = middle
        shift = 2 if times == 1 else DEPTH - APART + 2
        value = ((low + high) << shift) // 2
        out.append(Root(value, bits + shift, min(times, count - found)))
        found += times
    return out


def null_vectors(matrix: list[list[int]], root: Root) -> list[list[float]]:
    """Unit vectors that span what the matrix multiplies by the root, by inverse iteration.

    All numbers are integers times 2**-bits; a pivot of zero is replaced by the least number.
    """
    d, bits = len(matrix), root.bits + 64
    one = 1 << bits
    a = np.array([[v << bits for v in row] for row in matrix], dtype=object).reshape(d, d)
    for i in range(d):
        a[i, i] -= root.value << (bits - root.bits)
    order = list(range(d))
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(a[i, k]))
        a[[k, pivot]] = a[[pivot, k]]
        order[k], order[pivot] = order[pivot], order[k]
        if not a[k, k]:
            a[k, k] = 1
        if k + 1 < d:
            a[k + 1 :, k] = (a[k + 1 :, k] << bits) // a[k, k]
            a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k, k + 1 :]) >> bits

    def solved(v: list[int]) -> list[int]:
        y = [v[i] for i in order]
        for i in range(d):
            y[i] -= sum(int(a[i, j]) * y[j] for j in range(i)) >> bits
        for i in range(d - 1, -1, -1):
            y[i] = ((y[i] - (sum(int(a[i, j]) * y[j] for j in range(i + 1, d)) >> bits)) << bits) // a[i, i]
        return y

    def unit(v: list[int], others: list[list[int]]) -> list[int]:
        most = max(abs(x) for x in v)
        v = [(x << bits) // most for x in v] if most else v
        for other in others:
            along = sum(x * y for x, y in zip(v, other)) >> bits
            v = [x - (along * y >> bits) for x, y in zip(v, other)]
        length = math.isqrt(sum(x * x for x in v))
        return [(x << bits) // length for x in v] if length else v

    rng = np.random.default_rng(1)
    basis = [[int(x) << (bits - 32) for x in rng.integers(-(1 << 31), 1 << 31, d)] for _ in range(root.times)]
    for _ in range(3):
        made: list[list[int]] = []
        for v in basis:
            made.append(unit(solved(unit(v, [])), made))
        basis = made
    out = []
    for v in basis:
        most = max(range(d), key=lambda i: abs(v[i]))
        out.append([(x if v[most] > 0 else -x) / one for x in v])
    return out


@dataclass(frozen=True)
class Components:
    fit: Fit
    vectors: list[list[float]]
    values: list[float]  # eigenvalues of the covariance
    explained: list[float]


def components(spark: SparkSession, fit: Fit, count: int = COMPONENTS) -> Components:
    """Up to ``count`` unit eigenvectors of the covariance by falling eigenvalue, without those of zero."""
    trace = sum(fit.matrix[i][i] for i in range(fit.width))
    if not trace:
        return Components(fit, [], [], [])
    found = largest_roots(characteristic(spark, fit.matrix), count)
    matrix = fit.matrix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                vectors = null_vectors(matrix, found[i])
                yield pa.record_batch({"root": pa.array([i] * len(vectors), pa.int64()), "vector": pa.array(vectors, pa.list_(pa.float64()))})

    rows = spark.range(0, len(found), 1, max(1, len(found))).mapInArrow(run, "root bigint, vector array<double>").collect()
    rows.sort(key=lambda r: r["root"])
    values = [found[r["root"]].value / (fit.n * fit.n << found[r["root"]].bits) for r in rows]
    explained = [found[r["root"]].value / (trace << found[r["root"]].bits) for r in rows]
    return Components(fit, [list(r["vector"]) for r in rows], values, explained)


def whitened(rows: DataFrame, found: Components, column: str = "x") -> DataFrame:
    """Adds ``deviation`` (exact sum of (n * x - S)**2, null if beyond a long) and ``whitened`` (array) to rows of whole vectors."""
    n, width = found.fit.n, found.fit.width
    sums = found.fit.sums
    axes = np.array([[v / math.sqrt(e) for v in vector] for vector, e in zip(found.vectors, found.values)]).reshape(len(found.values), width)
    at = rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = stacked(batch.column(at), width)
            if not len(x):
                continue
            far = n * (int(np.abs(x.astype(float)).max()) + 1) + max(map(abs, sums)) + 1 if width else 1
            y = exact(x, far) * n - np.array(sums, dtype=object if far >= 1 << LIMB else np.int64)
            most = max(abs(int(y.min())), abs(int(y.max()))) if y.size else 0
            square = (exact(y, most * most * max(1, width)) ** 2).sum(axis=1)
            square = [v if v < 1 << 63 else None for v in map(int, square)]
            made = (y / n).astype(float) @ axes.T
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(square, pa.int64()), pa.array(made.tolist(), pa.list_(pa.float64()))],
                [*batch.schema.names, "deviation", "whitened"],
            )

    more = [T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([*rows.schema.fields, *more])
    return rows.mapInArrow(run, schema)


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row per vector and component.

    Vectors that are null or hold a null or a number that is not finite are left out, and so are those whose
    length is not the most frequent one (of equally frequent ones the largest). The fit is over
    the different rounded vectors, whatever rows repeat them. Components of variance zero are not
    given; a table of no or only equal vectors has none and gives no rows. A null key stays null.
    Only the key and the vector are read, so other columns, whatever their names, do not matter.
    """
    spark = table.sparkSession
    given = table.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(usable(F.col("v"))).select("id", whole_numbers(F.col("v"), scale).alias("x"))
    different = materialise(given.groupBy("x").agg(F.count("*").alias("rows")), "whole-vectors")
    lengths = different.groupBy(F.size("x").alias("width")).agg(F.sum("rows").alias("rows"), F.count("*").alias("n"))
    first = lengths.where("width > 0").orderBy(F.desc("rows"), F.desc("width")).first()
    width, n = (first["width"], first["n"]) if first else (0, 0)
    fit_rows = different.where(F.size("x") == width).select("x")
    found = components(spark, scatter(fit_rows, n, width) if n else Fit(0, [], []), count)
    k = len(found.values)
    error = 0.0
    if k:
        made = whitened(fit_rows, found)
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        near = [F.abs(F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) - float(i == j)) for i, j in pairs]
        error = made.agg(F.greatest(*near, F.lit(0.0)).alias("e")).first()["e"]
    rows = whitened(given.where(F.size("x") == width), found) if k else given.select("id", "x", F.lit(0).cast("bigint").alias("deviation"), F.array().cast("array<double>").alias("whitened")).limit(0)
    parts = rows.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.element_at(F.array(*[F.lit(e) for e in found.explained or [0.0]]), F.col("at") + 1)
    return parts.select(
        F.col("id").alias(key), (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
        "whitened", share.alias("explained"), F.lit(error).alias("identity_error"),
    )

"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Entries become whole numbers, so sums and products over all rows are exact:
``M = n sum(x x^T) - S S^T`` is ``n^2`` times the covariance.  Its
characteristic polynomial is computed modulo many primes, by reduction to
Hessenberg form, in Spark tasks, and put together by Chinese remaindering.
All its roots are real, so Descartes' rule counts those beyond any point
exactly; bisection isolates each root and sign changes refine it.  Components
are null vectors of ``M - root``, by inverse iteration in long fixed-point
numbers, so roots that lie close together do no harm.

Only matrices of the vectors' length squared go through the driver, none that
grows with the rows.

Defined cases: null vectors and such with null or non-finite entries are left
out; entries beyond a long stay at its ends; vectors of each length are
whitened apart, as a table of their own; empty vectors and components without
variance give no rows; equal eigenvalues get some orthonormal basis; equal rows
count once per row; a null id stays null; a deviation beyond a long is null,
and its digits are text in ``deviation_digits``; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import ship_package

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
LIMB = 40  # bits of a part of a long number that Spark sums
BLOCK = 4096
PRIMES_PER_TASK = 16


# whole numbers from vectors


def whole(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places of the rows, floor(scale * entry)) of the usable vectors, by length."""
    lists = batch.column("v")
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    for d in sorted(set(lengths.tolist()) - {0}):
        places = np.flatnonzero(lengths == d)
        some = lists.take(pa.array(places))
        flat = pc.cast(some.flatten(), pa.float64())
        ok = pc.fill_null(pc.is_finite(flat), False).to_numpy(zero_copy_only=False).reshape(-1, d).all(axis=1)
        values = flat.to_numpy(zero_copy_only=False).reshape(-1, d)[ok]
        if len(values):
            with np.errstate(over="ignore"):
                y = np.floor(scale * values)
            # the least and the largest double that a long holds stand for what is beyond
            yield d, places[ok], np.clip(y, -(2.0**63), 2.0**63 - 1024).astype(np.int64)


def exact_product(y: np.ndarray) -> list[list[int]]:
    """y^T y in whole numbers: parts of few bits are multiplied as doubles without rounding."""
    most = max(int(y.max()), -int(y.min()), 1)
    bits = 20  # products of two parts, BLOCK of them summed, stay below 2^53
    parts, rest = [], y
    for _ in range(-(-(most.bit_length() + 1) // bits)):
        parts.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    parts[-1] += rest.astype(np.float64) * (1 << bits)  # the sign: 0 or -1
    d = y.shape[1]
    total = np.zeros((d, d), dtype=object)
    for i, p in enumerate(parts):
        for j, q in enumerate(parts):
            total = total + (p.T @ q).astype(np.int64).astype(object) * (1 << bits * (i + j))
    return total


def limbs(value: int, count: int) -> list[int]:
    """``value`` in parts of LIMB bits, the last one signed."""
    return [(value >> LIMB * i) & ((1 << LIMB) - 1) for i in range(count - 1)] + [value >> LIMB * (count - 1)]


@dataclass(frozen=True)
class Moments:
    n: int
    sums: list[int]
    scatter: list[list[int]]  # n sum(y y^T) - sums sums^T


def moments(vectors: DataFrame, scale: int) -> dict[int, Moments]:
    """Exact first and second moments of the whole numbers, for each length of vectors."""
    schema = "d int, i int, j int, limb int, value long"

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for d, _, y in whole(batch, scale):
                n, sums, products = held.get(d, (0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)))
                for a in range(0, len(y), BLOCK):
                    part = y[a : a + BLOCK]
                    high, low = (part >> 32).sum(axis=0).astype(object), (part & 0xFFFFFFFF).sum(axis=0).astype(object)
                    sums, products = sums + high * (1 << 32) + low, products + exact_product(part)
                held[d] = [n + len(y), sums, products]
        for d, (n, sums, products) in held.items():
            rows = [(-1, -1, n), *((-1, i, s) for i, s in enumerate(sums)), *((i, j, products[i][j]) for i in range(d) for j in range(i, d))]
            out = [(i, j, k, part) for i, j, v in rows for k, part in enumerate(limbs(int(v), 5))]
            columns = list(zip(*[(i, j, k, part) for i, j, k, part in out if part]))
            if columns:
                arrays = [pa.array([d] * len(columns[0]), pa.int32()), *[pa.array(c, pa.int32()) for c in columns[:3]], pa.array(columns[3], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["d", "i", "j", "limb", "value"])

    found: dict[int, dict] = {}
    for r in vectors.mapInArrow(run, schema).groupBy("d", "i", "j", "limb").agg(F.sum("value").alias("value")).toLocalIterator():
        cells = found.setdefault(r.d, {})
        cells[(r.i, r.j)] = cells.get((r.i, r.j), 0) + (r.value << LIMB * r.limb)
    result = {}
    for d, cells in found.items():
        n, sums = cells[(-1, -1)], [cells.get((-1, i), 0) for i in range(d)]
        scatter = [[n * cells.get((min(i, j), max(i, j)), 0) - sums[i] * sums[j] for j in range(d)] for i in range(d)]
        result[d] = Moments(n, sums, scatter)
    return result


# the characteristic polynomial, coefficients from the constant one up


def primes_below(start: int) -> Iterator[int]:
    """Odd primes below ``start`` (below 2^31), falling."""
    small = [p for p in range(3, 46350, 2) if all(p % q for q in range(3, isqrt(p) + 1, 2))]
    n = start - 1 - start % 2
    while True:
        if all(n % p for p in small if p * p <= n):
            yield n
        n -= 2


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Characteristic polynomial modulo a prime below 2^31, by similarity to Hessenberg form."""
    a, d = matrix.copy(), len(matrix)
    for m in range(1, d - 1):
        found = np.flatnonzero(a[m:, m - 1])
        if not len(found):
            continue
        i = m + int(found[0])
        if i != m:
            a[[i, m]] = a[[m, i]]
            a[:, [i, m]] = a[:, [m, i]]
        u = a[m + 1 :, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1 :] = (a[m + 1 :] - u[:, None] * a[m]) % p
        # one addend at a time stays below 2^63
        a[:, m] = (a[:, m] + (a[:, m + 1 :] * u % p).sum(axis=1)) % p
    chain = [np.array([1], dtype=np.int64)]
    for k in range(d):
        new = np.zeros(k + 2, dtype=np.int64)
        new[1:] = chain[k]
        new[:-1] = (new[:-1] - a[k, k] * chain[k]) % p
        below = 1
        for i in range(k - 1, -1, -1):
            below = below * int(a[i + 1, i]) % p
            factor = below * int(a[i, k]) % p
            new[: i + 1] = (new[: i + 1] - factor * chain[i]) % p
        chain.append(new % p)
    return chain[d].tolist()


def combined(residues: list[tuple[int, list[int]]]) -> list[int]:
    """Coefficients between minus and plus half the product of the primes."""
    modulus = reduce(lambda x, r: x * r[0], residues, 1)
    total = [0] * len(residues[0][1])
    for p, values in residues:
        rest = modulus // p
        weight = rest * pow(rest % p, -1, p)
        total = [t + weight * v for t, v in zip(total, values)]
    return [(t + modulus // 2) % modulus - modulus // 2 for t in total]


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(t - matrix) for a symmetric positive semidefinite whole-number matrix."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # coefficients are elementary symmetric functions of roots that add up to the trace: below (1 + trace / d)^d
    bits = d * (trace // d + 2).bit_length() + 2
    wanted = -(-bits // 30) + 1
    primes = [p for p, _ in zip(primes_below((1 << 31) - 1), range(wanted))]

    def run(batches):
        for batch in batches:
            for p in batch.column("p").to_pylist():
                small = np.array([[v % p for v in row] for row in matrix], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([polynomial_modulo(small, p)], pa.list_(pa.int64()))], names=["p", "c"])

    dealt = spark.createDataFrame([(p,) for p in primes], "p long").repartition(-(-wanted // PRIMES_PER_TASK))
    residues = [(r.p, r.c) for r in dealt.mapInArrow(run, "p long, c array<long>").collect()]
    return combined(sorted(residues))


# roots of polynomials with real roots only


def shifted(c: list[int], x: int) -> list[int]:
    """Coefficients of c(t + x)."""
    c = list(c)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += x * c[j + 1]
    return c


def beyond(c: list[int], x: int) -> int:
    """How many roots, with multiplicity, are larger than x: exact by Descartes' rule, as all are real."""
    signs = [v > 0 for v in shifted(c, x) if v]
    return sum(s != t for s, t in zip(signs, signs[1:]))


def value(c: list[int], x: int, scale: int) -> int:
    """c(x / scale) times scale^degree: its sign is the value's."""
    total, power = 0, 1
    for v in reversed(c):
        total, power = total * x + v * power, power * scale
    return total


def divided(a: list[int], b: list[int], p: int | None = None) -> tuple[list[int], list[int]]:
    """Quotient and remainder by a monic polynomial, modulo a prime if one is given."""
    a, out = list(a), [0] * max(0, len(a) - len(b) + 1)
    for i in range(len(out) - 1, -1, -1):
        f = a[i + len(b) - 1]
        out[i] = f
        if f:
            for j, v in enumerate(b):
                a[i + j] -= f * v
                if p:
                    a[i + j] %= p
    rest = a[: len(b) - 1]
    while rest and not rest[-1]:
        rest.pop()
    return out, rest


def common_divisor(a: list[int], b: list[int], p: int) -> list[int]:
    """Monic greatest common divisor modulo a prime."""
    a, b = [v % p for v in a], [v % p for v in b]
    while b and not b[-1]:
        b.pop()
    while b:
        inverse = pow(b[-1], -1, p)
        b = [v * inverse % p for v in b]
        a, b = b, divided(a, b, p)[1]
    return a


def squarefree(c: list[int]) -> list[int]:
    """The monic polynomial with each root of ``c`` once: c / gcd(c, c'), the divisor by remaindering."""
    slope = [i * v for i, v in enumerate(c)][1:]
    kept: list[tuple[int, list[int]]] = []
    for p in primes_below((1 << 31) - 1):
        g = common_divisor(c, slope, p)
        if len(g) == 1:
            return c
        if kept and len(g) > len(kept[0][1]):
            continue  # an unlucky prime
        kept = [k for k in kept if len(k[1]) == len(g)] + [(p, g)]
        quotient, rest = divided(c, combined(kept))
        if not rest and not divided(slope, combined(kept))[1]:
            return quotient


def isolated(c: list[int], bound: int) -> list[tuple[int, int, int, int]]:
    """(low, high, scale, multiplicity), roots falling, each alone in (low / scale, high / scale]; roots lie in [0, bound)."""
    distinct = squarefree(c)
    found, scale = [], 1
    waiting = [(-1, bound, len(distinct) - 1, 0)]
    while waiting:
        following = []
        for low, high, above_low, above_high in waiting:
            if above_low - above_high == 1:
                found.append((low, high, scale))
            elif above_low > above_high:
                following.append((low, high, above_low, above_high))
        scaled = []
        if any(high - low < 2 for low, high, *_ in following):  # go on in halves
            following = [(2 * low, 2 * high, x, y) for low, high, x, y in following]
            distinct = [v << (len(distinct) - 1 - i) for i, v in enumerate(distinct)]
            scale *= 2
        for low, high, x, y in following:
            middle = (low + high) // 2
            z = beyond(distinct, middle)
            scaled += [(low, middle, x, z), (middle, high, z, y)]
        waiting = scaled

    def multiplicity(low, high, s):
        stretched = [v * s ** (len(c) - 1 - i) for i, v in enumerate(c)]
        return beyond(stretched, low) - beyond(stretched, high)

    return sorted(((low, high, s, multiplicity(low, high, s)) for low, high, s in found), key=lambda r: -r[1] / r[2])


def refined(distinct: list[int], low: int, high: int, scale: int, bits: int) -> int:
    """The root in (low / scale, high / scale], times 2^bits and rounded: sign changes, with secant steps that keep the bracket."""
    one = 1 << bits
    a, b = (low << bits) // scale, -((-high << bits) // scale)
    fb = value(distinct, b, one)
    if fb == 0:
        return b
    fa = value(distinct, a, one)
    while fa == 0:  # a is a root of its own, which is not in the interval
        a += 1
        fa = value(distinct, a, one)
    while b - a > 1:
        # a secant step with a margin on both sides, then a halving, so that the bracket shrinks in any case
        guess = a + (b - a) * abs(fa) // (abs(fa) + abs(fb))
        width = max(1, (b - a) >> 12)
        for x in (guess - width, guess + width, (a + b) // 2):
            if a < x < b:
                fx = value(distinct, x, one)
                if fx == 0:
                    return x
                if (fx > 0) == (fa > 0):
                    a, fa = x, fx
                else:
                    b, fb = x, fx
    return b


# components


def factors(m: np.ndarray, bits: int) -> tuple[np.ndarray, list[int], list[int]]:
    """LU of a symmetric fixed-point matrix with full pivoting; pivots of zero become the least number."""
    a, d = m.copy(), len(m)
    rows, columns = list(range(d)), list(range(d))
    for k in range(d):
        part = np.abs(a[k:, k:])
        i, j = divmod(int(np.argmax(part)), d - k)
        i, j = i + k, j + k
        a[[k, i]], rows[k], rows[i] = a[[i, k]], rows[i], rows[k]
        a[:, [k, j]], columns[k], columns[j] = a[:, [j, k]], columns[j], columns[k]
        if a[k, k] == 0:
            a[k, k] = 1
        if k + 1 < d:
            f = (a[k + 1 :, k] << bits) // a[k, k]
            a[k + 1 :, k] = f
            a[k + 1 :, k + 1 :] -= (f[:, None] * a[k, k + 1 :]) >> bits
    return a, rows, columns


def solved(lu: tuple, x: np.ndarray, bits: int) -> np.ndarray:
    a, rows, columns = lu
    y, d = x[rows], len(x)
    for k in range(d):
        y[k + 1 :] -= (a[k + 1 :, k] * y[k]) >> bits
    for k in range(d - 1, -1, -1):
        y[k] = (y[k] << bits) // a[k, k]
        y[:k] -= (a[:k, k] * y[k]) >> bits
    out = np.empty(d, dtype=object)
    out[columns] = y
    return out


def unit(x: np.ndarray, bits: int) -> np.ndarray:
    most = max(abs(v) for v in x)
    x = np.array([(v << bits) // most for v in x], dtype=object)
    return np.array([(v << bits) // isqrt(sum(w * w for w in x)) for v in x], dtype=object)


def null_vectors(matrix: list[list[int]], root: int, many: int, bits: int) -> list[np.ndarray]:
    """``many`` orthonormal fixed-point vectors that ``matrix - root / 2^bits`` takes to zero, by inverse iteration."""
    d = len(matrix)
    trace = max(1, sum(matrix[i][i] for i in range(d)))
    m = np.array([[((v << bits) - (root if i == j else 0)) // trace for j, v in enumerate(row)] for i, row in enumerate(matrix)], dtype=object)
    lu = factors(m, bits)
    found: list[np.ndarray] = []

    def apart(x):
        for f in found:
            dot = sum(int(u) * int(v) for u, v in zip(f, x)) >> bits
            x = x - np.array([(dot * v) >> bits for v in f], dtype=object)
        return unit(x, bits)

    for k in range(many):
        # the unit vector of a column that was pivoted last lies nowhere near the other components' span
        x = np.array([(1 << bits) if i == lu[2][d - 1 - k] else 0 for i in range(d)], dtype=object)
        for _ in range(3):
            x = apart(unit(solved(lu, apart(x), bits), bits))
        x = apart(x)
        found.append(x if max(x, key=abs) > 0 else -x)
    return found


@dataclass(frozen=True)
class Whitener:
    n: int
    sums: list[int]
    projection: np.ndarray  # length x components: unit eigenvector over sqrt(eigenvalue)
    explained: list[float]


def as_double(numerator: int, denominator: int) -> float:
    return numerator / denominator  # Python rounds the exact quotient


def whitener(spark: SparkSession, m: Moments, components: int) -> Whitener:
    trace = sum(m.scatter[i][i] for i in range(len(m.sums)))
    if trace == 0:
        return Whitener(m.n, m.sums, np.zeros((len(m.sums), 0)), [])
    c = characteristic(spark, m.scatter)
    distinct = squarefree(c)
    # the lowest interval reaches below zero; where zero is a root, it is the one in there
    roots = [r for r in isolated(c, trace + 1) if r[0] >= 0 or c[0]]
    # as many bits as keep a root and its neighbours 2^-100 of their distance apart
    rough = [refined(distinct, low, high, s, 64) for low, high, s, _ in roots]
    gaps = [a - b for a, b in zip(rough, [*rough[1:], 0])]
    bits = 160 + 2 * ((trace << 64) // max(1, min(gaps))).bit_length()
    columns, explained = [], []
    for low, high, s, many in roots:
        if len(explained) >= components:
            break
        e = refined(distinct, low, high, s, bits)
        for v in null_vectors(m.scatter, e, many, bits):
            # whitened = ((n y - S) / n) . v / sqrt(e / n^2), and e is a root times 2^bits
            deviation = isqrt((e << bits))
            columns.append([as_double(int(x) * m.n, deviation) for x in v])
            explained.append(as_double(e, trace << bits))
    keep = slice(0, components)
    return Whitener(m.n, m.sums, np.array(columns[keep]).T, explained[keep])


# rows


def whitened_rows(y: np.ndarray, w: Whitener) -> tuple[list[int], np.ndarray]:
    """Deviations in whole numbers and the projected rows."""
    bound = max(int(y.max()), -int(y.min()), 1) * w.n + max(map(abs, w.sums))
    if bound * bound * y.shape[1] < 1 << 62:
        centred = y * w.n - np.array(w.sums, dtype=np.int64)
        deviations = (centred * centred).sum(axis=1).tolist()
        return deviations, (centred / w.n) @ w.projection
    centred = y.astype(object) * w.n - np.array(w.sums, dtype=object)
    return (centred * centred).sum(axis=1).tolist(), (centred / w.n).astype(np.float64) @ w.projection


def identity_errors(vectors: DataFrame, models: dict[int, Whitener], scale: int) -> dict[int, float]:
    """By length, the largest absolute entry of (covariance of the whitened rows - identity), centred before multiplying."""

    def run(batches):
        held = {}
        for batch in batches:
            for d, _, y in whole(batch, scale):
                for a in range(0, len(y), BLOCK):
                    z = whitened_rows(y[a : a + BLOCK], models[d])[1]
                    mean = z.mean(axis=0)
                    n, total, square = len(z), mean * len(z), (z - mean).T @ (z - mean)
                    if d in held:  # two centred parts: their own scatter and that of their means
                        n0, t0, s0 = held[d]
                        apart = t0 / n0 - mean
                        square = s0 + square + np.outer(apart, apart) * (n0 * n / (n0 + n))
                        n, total = n0 + n, t0 + total
                    held[d] = (n, total, square)
        for d, (n, total, square) in held.items():
            k = len(total)
            if not k:
                continue
            mean = total / n
            i, j = np.triu_indices(k)
            # the scatter about zero, the mean of all whitened rows but for rounding; the rounding is returned as well
            cells = [*zip([-1] * k, range(k), total.tolist()), *zip(i.tolist(), j.tolist(), (square + n * np.outer(mean, mean))[i, j].tolist())]
            columns = list(zip(*cells))
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * len(cells), pa.int32()), pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.float64())], names=["d", "i", "j", "value"])

    cells = vectors.mapInArrow(run, "d int, i int, j int, value double").groupBy("d", "i", "j").agg(F.sum("value").alias("value")).collect()
    sums = {(r.d, r.j): r.value for r in cells if r.i < 0}
    errors = dict.fromkeys(models, 0.0)
    for r in cells:
        if r.i >= 0:
            n = models[r.d].n
            error = abs(r.value / n - sums[(r.d, r.i)] / n * (sums[(r.d, r.j)] / n) - (r.i == r.j))
            errors[r.d] = max(errors[r.d], error)
    return errors


def whiten(df: DataFrame, ident: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Rows (``ident``, component, n, deviation, whitened, explained, identity_error, deviation_digits).

    Entries become ``floor(scale * entry)``; a number added to all of them, as
    by SHIFT, changes none of these columns.
    """
    spark = df.sparkSession
    ship_package(spark)
    vectors = df.select(F.col(ident).alias("id"), F.col(vector).alias("v"))
    models = {d: whitener(spark, m, components) for d, m in sorted(moments(vectors.select("v"), scale).items())}
    errors = identity_errors(vectors.select("v"), models, scale) if models else {}
    kind = df.schema[ident].dataType.simpleString()
    columns = f"`{ident}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_digits string"

    def run(batches):
        for batch in batches:
            for d, places, y in whole(batch, scale):
                model = models[d]
                k = len(model.explained)
                for a in range(0, len(y) if k else 0, BLOCK):
                    deviations, z = whitened_rows(y[a : a + BLOCK], model)
                    rows = len(z)
                    each = np.repeat(np.arange(rows), k)
                    ids = batch.column("id").take(pa.array(places[a : a + BLOCK][each]))
                    fits = pa.array([v if v < 1 << 63 else None for v in deviations], pa.int64()).take(pa.array(each))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, model.n)), fits, pa.array(z.ravel()), pa.array(model.explained * rows),
                         pa.array(np.full(rows * k, errors[d])), pa.array([str(v) for v in deviations], pa.string()).take(pa.array(each))],
                        names=[ident, "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_digits"])

    return vectors.mapInArrow(run, columns)

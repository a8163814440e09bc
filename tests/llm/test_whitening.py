from fractions import Fraction
from math import floor, prod

import numpy as np
import pytest

from tributary.llm import whitening as W
from tributary.llm.queries import QUERIES


def scatter_of(rows):
    """Whole numbers and n^2 times their covariance, in Python's long numbers."""
    y = [[floor(64.0 * c) + 1000000 for c in r] for r in rows]
    n, d = len(y), len(y[0])
    sums = [sum(r[i] for r in y) for i in range(d)]
    return y, sums, [[n * sum(r[i] * r[j] for r in y) - sums[i] * sums[j] for j in range(d)] for i in range(d)]


def expand(roots):
    c = [1]
    for r in roots:
        c = [a - r * b for a, b in zip([0, *c], [*c, 0])]
    return c


def determinant(m):
    m = [[Fraction(v) for v in row] for row in m]
    sign, out = 1, Fraction(1)
    for k in range(len(m)):
        i = next((i for i in range(k, len(m)) if m[i][k]), None)
        if i is None:
            return Fraction(0)
        if i != k:
            m[k], m[i], sign = m[i], m[k], -sign
        out *= m[k][k]
        for i in range(k + 1, len(m)):
            f = m[i][k] / m[k][k]
            m[i] = [a - f * b for a, b in zip(m[i], m[k])]
    return sign * out


def check(rows, got, components=32):
    """Every column of the contract, for the usable rows of one length."""
    y, sums, m = scatter_of([v for _, v in rows])
    n, d = len(y), len(y[0])
    values, vectors = np.linalg.eigh(np.array([[float(Fraction(v, n * n)) for v in row] for row in m]))
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    positive = int((values > 1e-9 * values[0]).sum())
    k = min(components, positive)
    table = {}
    for r in got:
        table.setdefault(r.vec_id, []).append(r)
    assert len(got) == n * k and {r.component for r in got} == set(range(1, k + 1))
    z = np.zeros((n, k))
    trace = sum(m[i][i] for i in range(d))
    for place, (ident, _) in enumerate(rows):
        own = table[ident]
        deviation = sum((n * v - s) ** 2 for v, s in zip(y[place], sums))
        for r in own:
            assert r.n == n and r.deviation == (deviation if deviation < 1 << 63 else None) and int(r.deviation_digits) == deviation
            assert abs(r.explained - values[r.component - 1] / (trace / n / n)) <= 1e-10 * r.explained + 1e-14
            assert r.identity_error <= 1e-9
            z[place, r.component - 1] = r.whitened
    centred = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(row, sums)] for row in y])
    assert np.abs(z.T @ z / n - np.eye(k)).max() < 1e-9
    for c in range(k):
        gap = min(abs(values[c] - v) for i, v in enumerate(values) if i != c) / values[0]
        if gap > 1e-6:
            expected = centred @ vectors[:, c] / np.sqrt(values[c])
            assert min(np.abs(z[:, c] - expected).max(), np.abs(z[:, c] + expected).max()) < 1e-6


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)


def test_usual_vectors_and_odd_rows(spark):
    rng = np.random.RandomState(0)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((300, 10)) * np.arange(1, 11))]
    odd = [(1000, None), (1001, []), (1002, [1.0] * 9 + [None]), (1003, [float("nan")] + [0.0] * 9), (1004, [float("inf")] + [0.0] * 9)]
    df = frame(spark, rows + odd).selectExpr("*", "1 as component", "'x' as whitened", "0 as id", "0 as v")
    check(rows, W.whiten(df).collect())
    check(rows, W.whiten(df, components=3).collect(), 3)


def test_repeated_rows_null_ids_and_lengths_apart(spark):
    rng = np.random.RandomState(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((40, 4)))]
    rows += [(100 + i, rows[0][1]) for i in range(100)]  # most rows are copies of one
    other = [(500 + i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((30, 2)))]
    got = W.whiten(frame(spark, rows + other)).collect()
    check(rows, [r for r in got if r.vec_id < 500])
    check(other, [r for r in got if r.vec_id >= 500])
    got = W.whiten(frame(spark, [(None, [1.0, 2.0]), (None, [2.0, 2.0])])).collect()
    assert [r.vec_id for r in got] == [None, None] and {r.component for r in got} == {1}


def test_equal_and_missing_eigenvalues(spark):
    # a cross has equal eigenvalues; two dimensions are copies, one never changes
    rows = [(i, [float(s * (j == k)) for j in range(3)] + [float(s * (k == 0)), 7.0]) for i, (k, s) in enumerate((k, s) for k in range(3) for s in (-2, 2))]
    got = W.whiten(frame(spark, rows)).collect()
    check(rows, got)
    assert {r.component for r in got} == {1, 2, 3}


def test_large_entries_and_single_rows(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate([[1e15, -3e14, 1.0], [-1e15, 2e13, 5.0], [3e12, 1e11, -2.0], [7e8, 9e3, 0.5], [1.0, 2.0, 3.0]])]
    y, sums, m = scatter_of([v for _, v in rows])
    got = W.whiten(frame(spark, rows)).collect()
    assert len(got) == 15 and max(r.identity_error for r in got) < 1e-4
    for r in got:
        deviation = sum((5 * v - s) ** 2 for v, s in zip(y[r.vec_id], sums))
        assert int(r.deviation_digits) == deviation and r.deviation == (deviation if deviation < 1 << 63 else None)
    assert W.whiten(frame(spark, [(1, [1.0, 2.0])])).collect() == []
    assert W.whiten(frame(spark, [])).collect() == []
    huge = W.whiten(frame(spark, [(0, [1e300]), (1, [-1e300]), (2, [0.0])])).collect()
    assert len(huge) == 3 and all(r.identity_error < 1e-4 for r in huge)


def test_close_eigenvalues_are_parted(spark):
    """Two components whose variances differ by a part in 10^9 come out as the exact matrix has them."""
    m = [[10**12 + 1, 3, 0], [3, 10**12 - 1, 1], [0, 1, 5]]
    c = W.characteristic(spark, m)
    assert c == expand_check(m)
    roots = W.isolated(c, sum(m[i][i] for i in range(3)) + 1)
    assert [r[3] for r in roots] == [1, 1, 1]
    bits = 400
    vectors = [W.null_vectors(m, W.refined(c, *r[:3], bits), 1, bits)[0] for r in roots]
    for e, v in zip([W.refined(c, *r[:3], bits) for r in roots], vectors):
        for i in range(3):
            error = sum(m[i][j] * int(v[j]) for j in range(3)) * (1 << bits) - e * int(v[i])
            assert abs(error) < 1 << (2 * bits - 150)
    for i in range(3):
        for j in range(3):
            dot = sum(int(a) * int(b) for a, b in zip(vectors[i], vectors[j]))
            assert abs(dot - (i == j) * (1 << 2 * bits)) < 1 << (2 * bits - 120)


def expand_check(m):
    (a, b, c), (_, e, f), (_, _, i) = m
    return [-(a * (e * i - f * f) - b * (b * i - f * c) + c * (b * f - e * c)), a * e - b * b + a * i - c * c + e * i - f * f, -(a + e + i), 1]


@pytest.mark.parametrize("seed", range(4))
def test_polynomials_and_roots(spark, seed):
    rng = np.random.RandomState(seed)
    d = int(rng.randint(1, 9))
    x = rng.randint(-9, 10, (d + 2 - 3 * (seed == 3), d)) if d > 3 else rng.randint(-9, 10, (d + 1, d))
    m = (x.T @ x).tolist()
    c = W.characteristic(spark, m)
    for t in range(-3, 4):
        assert sum(v * t**i for i, v in enumerate(c)) == determinant([[(t if i == j else 0) - v for j, v in enumerate(row)] for i, row in enumerate(m)])
    roots = sorted(rng.choice([0, 1, 2, 5, 5, 9, 100, 10**9], 7).tolist(), reverse=True)
    c = expand(roots)
    distinct = sorted(set(roots), reverse=True)
    assert W.squarefree(c) == expand(distinct)
    found = W.isolated(c, sum(roots) + 1)
    assert [r[3] for r in found] == [roots.count(v) for v in distinct]
    assert all(low < v * s <= high for (low, high, s, _), v in zip(found, distinct))
    assert [W.refined(expand(distinct), *r[:3], 40) for r in found] == [v << 40 for v in distinct]
    assert [W.beyond(c, v) for v in (-1, 0, 5, 10**9)] == [sum(r > v for r in roots) for v in (-1, 0, 5, 10**9)]


def test_exact_products():
    rng = np.random.RandomState(2)
    for most in (3, 10**5, 2**40, 2**62):
        y = rng.randint(-most, most, (500, 3))
        exact = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
        assert W.exact_product(y).tolist() == exact
    for v in (0, -1, 5, -(1 << 130), (1 << 130) + 7):
        assert sum(p << W.LIMB * i for i, p in enumerate(W.limbs(v, 5))) == v
    assert prod(next(W.primes_below(100)) for _ in range(1)) == 97


def test_query_over_its_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check([r for r in rows if r[1] is not None], QUERIES["op12_whitening"](spark, sf_dir).collect())

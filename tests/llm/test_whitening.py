"""Whitening against plain linear algebra."""

import math
from fractions import Fraction

import numpy as np
import pytest

from queuelens.llm import whitening as w


def plain(x):
    """Whole vectors -> n, sums, eigenvalues and vectors of the covariance of the different ones."""
    u = np.unique(x, axis=0)
    c = u - u.mean(axis=0)
    e, v = np.linalg.eigh(c.T @ c / len(u))
    return len(u), u.sum(axis=0), e[::-1], v[:, ::-1], u.mean(axis=0)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows], f"vec_id bigint, embedding array<{kind}>")


def check(found, rows, x, count=4):
    n, sums, e, v, mean = plain(x)
    got = {(r["vec_id"], r["component"]): r for r in found.collect()}
    count = min(count, int((e > e[0] * 1e-12).sum()))
    assert len(got) == len(rows) * count
    for k in range(count):
        ours = np.array([got[i, k + 1]["whitened"] for i, _ in rows])
        theirs = (x - mean) @ v[:, k] / math.sqrt(e[k])
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-8
    for (i, _), row in zip(rows, x.tolist()):
        r = got[i, 1]
        assert r["n"] == n and r["deviation"] == sum((n * a - int(s)) ** 2 for a, s in zip(row, sums))
        assert abs(r["explained"] - e[0] / e.sum()) < 1e-10 and r["identity_error"] < 1e-9


@pytest.mark.parametrize("width,count", [(1, 9), (2, 30), (5, 40), (17, 60)])
def test_equals_plain_linear_algebra(spark, width, count):
    rng = np.random.default_rng(width)
    x = rng.normal(size=(count, width)) * np.linspace(1, 3, width) + 5
    x = np.concatenate([x, x[:4]])  # copies do not count twice
    rows = list(enumerate(x.astype(np.float32)))
    check(w.whiten(frame(spark, rows)), rows, np.floor(x.astype(np.float32).astype(float) * 256).astype(int))


def test_embeddings(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect() if r["embedding"] is not None and all(c is not None and math.isfinite(c) for c in r["embedding"])]
    check(w.whiten(table), rows, np.array([[math.floor(256 * c) for c in v] for _, v in rows]))


def test_odd_rows_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [0.1, 0.9]), (1, [0.5, -0.2]), (2, [-0.7, 0.3]), (2, [-0.7, 0.3]), (None, [0.2, 0.2])]
    odd = [(5, None), (6, [None, 1.0]), (7, [nan, 1.0]), (8, [inf, 0.0]), (9, [-inf, 0.0]), (10, []), (11, [1.0, 2.0, 3.0])]
    table = frame(spark, good + odd, "double")
    clash = table.selectExpr("*", "1 as x", "2 as id", "'a' as whitened", "0 as component", "1 as n")
    found = [tuple(r) for r in w.whiten(clash).collect()]
    assert sorted({r[0] for r in found}, key=repr) == [0, 1, 2, None] and len(found) == 10
    assert {r[2] for r in found} == {4}


def test_tables_without_components(spark):
    assert w.whiten(frame(spark, [])).count() == 0
    assert w.whiten(frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).count() == 0
    assert w.whiten(frame(spark, [(1, []), (2, None)])).count() == 0
    line = [(i, [i, 2 * i, 0]) for i in range(5)]  # one direction alone
    assert {r["component"] for r in w.whiten(frame(spark, line)).collect()} == {1}


def test_equal_roots_get_an_orthonormal_basis(spark):
    rows = list(enumerate(np.concatenate([np.eye(3), -np.eye(3)])))
    found = w.whiten(frame(spark, rows))
    got = {(r["vec_id"], r["component"]): r["whitened"] for r in found.collect()}
    made = np.array([[got[i, k] for k in (1, 2, 3)] for i in range(6)])
    assert np.abs(made.T @ made / 6 - np.eye(3)).max() < 1e-12 and found.first()["identity_error"] < 1e-12


def test_numbers_beyond_doubles_stay_exact(spark):
    x = [[1e15, 3.0], [1e15 + 4, -7.0], [-1e15, 0.5], [2e15, 0.25]]
    found = w.whiten(frame(spark, list(enumerate(x)), "double"), count=2)
    got = {(r["vec_id"], r["component"]): r for r in found.collect()}
    whole = [[math.floor(Fraction(256) * Fraction(c)) for c in v] for v in x]
    sums = [sum(v[i] for v in whole) for i in range(2)]
    deviation = [sum((4 * a - s) ** 2 for a, s in zip(v, sums)) for v in whole]
    assert all(d >= 1 << 63 for d in deviation)
    assert all(r["deviation"] is None for r in got.values()) and len(got) == 8
    assert found.first()["identity_error"] < 1e-4
    assert len(w.whiten(frame(spark, [(0, [1e300, 1.0]), (1, [-1e300, 2.0])], "double")).collect()) == 2


def test_polynomial_and_roots(spark):
    matrix = [[4, 1, 0], [1, 3, 1], [0, 1, 2]]
    poly = w.characteristic(spark, matrix)
    assert poly == [-18, 24, -9, 1]  # (t - 3)(t^2 - 6 t + 6)
    assert [w.roots_above(poly, at, 0) for at in (0, 2, 3, 4, 5)] == [3, 2, 1, 1, 0]
    roots = [r.value / (1 << r.bits) for r in w.largest_roots(poly, 3)]
    assert roots == pytest.approx([3 + math.sqrt(3), 3, 3 - math.sqrt(3)], abs=1e-15)
    for r in w.largest_roots(poly, 3):
        v = np.array(w.null_vectors(matrix, r)[0])
        assert np.abs(np.array(matrix) @ v - r.value / (1 << r.bits) * v).max() < 1e-14
    zero = [[0] * 4 for _ in range(4)]
    zero[2][2] = 5  # columns without a pivot
    assert w.characteristic(spark, zero) == [0, 0, 0, -5, 1]
    assert [r.times for r in w.largest_roots([-72, 60, -14, 1], 3)] == [2, 1]  # 6, 6, 2
    close = [(10**30 + 1) * 10**30, -(2 * 10**30 + 1), 1]
    assert [r.value >> r.bits for r in w.largest_roots(close, 2)][0] in (10**30, 10**30 + 1)


def test_primes():
    found = w.primes(300)
    assert found[0] == 2**31 - 1 and len(set(found)) == 300 and found == sorted(found, reverse=True)
    assert all(p % q for p in found for q in range(2, 2000))

"""Operator 13 against numpy's eigenvectors and exact integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from pickmarts.llm import whitening
from pickmarts.llm.columns import read_table

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors: list[list[float]]):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], dtype=np.int64)
    n = len(x)
    c = x - x.mean(axis=0)
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = int(min(8, (e > 1e-9 * max(e.max(), 1e-300)).sum()))
    sums = [int(s) for s in x.sum(axis=0)]
    deviation = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviation, (c @ u[:, :k]) / np.sqrt(e[:k]), e[:k] / np.trace(v)


def check(spark, rows, good, schema=SCHEMA):
    got = whitening.op13_whiten(spark.createDataFrame(rows, schema).repartition(4))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    n, deviation, want, explained = brute([v for _, v in good])
    k = want.shape[1]
    assert len(got) == n * k
    table = {}
    for r in got:
        table.setdefault(r["vec_id"], {})[r["component"]] = r
    have = np.array([[table[i][j + 1]["whitened"] for j in range(k)] for i, _ in good])
    signs = np.sign((have * want).sum(axis=0))
    assert np.abs(have - want * signs).max() < 1e-6
    for r in got:
        assert r["n"] == n and abs(r["identity_error"]) < 1e-9
        assert abs(r["explained"] - explained[r["component"] - 1]) < 1e-10
    for (i, _), d in zip(good, deviation):
        assert table[i][1]["deviation"] == d
    assert len({r["identity_error"] for r in got}) == 1
    return got


def test_given_table(spark):
    rows = [tuple(r) for r in read_table(spark, "/root/testdata/sf0.001", "embeddings").collect()]
    check(spark, rows, [(i, v) for i, v, _ in rows])


def test_vectors_that_do_not_count_and_clashing_columns(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(300)]
    bad = [None, [], [1.0] * 5, [None] * 12, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [1.0] * 11 + [-math.inf], [3e38] * 12]
    rows = [(i, v, 1, "x", 2.0) for i, v in good] + [(None, v, None, "y", None) for v in bad]
    check(spark, rows, good, SCHEMA + ", component string, n double")


def test_rank_below_the_components_and_equal_vectors(spark):
    rng = np.random.default_rng(2)
    basis = rng.normal(size=(3, 10))
    good = []
    for i in range(200):
        # integers after scaling, so that the rank stays three
        v = np.round(rng.integers(-3, 4, 3) @ np.round(basis * 8)) / 1024
        good.append((i, v.astype(np.float32).tolist()))
    got = check(spark, [(i, v, 0) for i, v in good], good)
    assert max(r["component"] for r in got) == 3
    # a third of the rows is one vector
    good += [(1000 + i, good[0][1]) for i in range(100)]
    check(spark, [(i, v, 0) for i, v in good], good)


def test_no_variance_gives_no_rows(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(5)], [(1, None, 0)]):
        got = whitening.op13_whiten(spark.createDataFrame(rows, SCHEMA))
        assert got.collect() == []
        assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]


def test_equal_eigenvalues(spark):
    # a cross: every direction has the same variance
    rows = [(2 * d + s, [float((k == d) * (1 - 2 * s)) for k in range(6)], 0) for d in range(6) for s in (0, 1)]
    got = whitening.op13_whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    w = np.zeros((12, 6))
    for r in got:
        w[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert abs(r["explained"] - 1 / 6) < 1e-12
    assert np.abs(w.T @ w / 12 - np.eye(6)).max() < 1e-12


def test_deviation_beyond_a_long_is_null():
    m = whitening.Moments(2, (2**40, 2**40))
    x = np.array([[2**39, 2**39], [2**39 + 1, 2**39 - 1], [-(2**40), 2**39]])
    assert m.deviations(x) == [0, 8, None]


@pytest.mark.parametrize("d,n", [(1, 5), (7, 100), (40, 500), (20, 10)])
def test_factor_and_rotations(d, n):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(n, d)) * 10.0 ** rng.integers(-3, 4, d)
    x -= x.mean(axis=0)
    c = x.T @ x
    p, factor = whitening.pivoted_cholesky(c)
    assert np.allclose(np.triu(factor, 1), 0) and np.allclose(factor @ factor.T, c[np.ix_(p, p)], rtol=1e-9, atol=1e-9 * c.max())
    assert (np.diff(np.diag(factor)) <= 1e-12 * factor[0, 0]).all()  # pivots fall
    values, parts = whitening.principal_components(c)
    assert np.allclose(parts.T @ parts, np.eye(len(values)), atol=1e-12)
    assert np.allclose(c @ parts, parts * values, rtol=1e-9, atol=1e-12 * values[0])
    want = np.linalg.eigvalsh(c)[::-1][: len(values)]
    assert np.allclose(values, want, rtol=1e-6, atol=1e-10 * want[0])

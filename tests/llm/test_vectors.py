import math

import numpy as np
import pytest
from pyspark.sql import types as T

from martforge.llm import whitening as W

EMB = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                    T.StructField("label", T.IntegerType()), T.StructField("x", T.StringType()),
                    T.StructField("n", T.LongType())])


def brute(rows, k=4):
    """(vec_id, x) of usable rows, covariance and its spectrum by the definitions."""
    good = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({x for _, x in good}), dtype=float)
    n, s = len(fit), [sum(int(x[j]) for x in fit) for j in range(fit.shape[1])]
    c = fit - np.array(s) / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    return good, n, s, e[::-1], u[:, ::-1], v


def check(s, rows, tail=()):
    df = s.createDataFrame([(i, v, 0, "clash", 9) for i, v in rows], EMB).repartition(3)
    got = W.whiten_embeddings(s, df).collect()
    good, n, sums, e, u, v = brute(rows)
    dim, k = len(sums), min(4, len(sums))
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted(
        (str(i), c) for i, _ in good for c in range(1, k + 1))
    by = {}
    for i, x in good:
        dev = sum((n * a - b) ** 2 for a, b in zip(x, sums))
        y = (np.array(x) - np.array(sums) / n) @ u[:, :k] / np.sqrt(e[:k])
        by.setdefault(i, []).append((dev, y))
    sign = {}
    for r in got:
        assert r.n == n and abs(r.explained / (e[r.component - 1] / np.trace(v)) - 1) < 1e-9
        assert r.identity_error < 1e-9
        near = min(by[r.vec_id], key=lambda t: (t[0] != r.deviation, abs(abs(t[1][r.component - 1]) - abs(r.whitened))))
        want = near[1][r.component - 1]
        assert r.deviation == near[0] and abs(abs(r.whitened) - abs(want)) < 1e-8
        if abs(want) > 1e-6:
            assert sign.setdefault(r.component, r.whitened * want > 0) == (r.whitened * want > 0)


def test_rank_one_updates_keep_the_spectrum():
    rng = np.random.default_rng(0)
    for dim, n in ((1, 6), (3, 40), (17, 120)):
        x = np.floor(256 * rng.normal(size=(n, dim)) * np.linspace(0.01, 1, dim))
        if dim > 2:
            x[:, 1] = x[:, 2]                      # equal and empty directions are deflated
            x[:, 0] = 0
        one, other = W.Spectrum.empty(dim), W.Spectrum.empty(dim)
        for row in x[: n // 3]:
            one.add(row)
        for row in x[n // 3:]:
            other.add(row)
        one.combine(other)
        c = x - x.mean(axis=0)
        scatter = c.T @ c
        assert one.n == n and np.allclose(one.mean, x.mean(axis=0))
        assert np.abs(one.u.T @ one.u - np.eye(dim)).max() < 1e-12
        assert np.abs(one.u * one.d @ one.u.T - scatter).max() < 1e-11 * np.abs(scatter).max()


def test_secular_roots_solve_the_equation():
    rng = np.random.default_rng(1)
    for n in (1, 2, 9, 40):
        d, z2 = np.cumsum(rng.random(n) + 1e-3), rng.random(n) ** 6 + 1e-9
        origin, x = W.secular_roots(d, z2)
        root = d[origin] + x
        want = np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(z2), np.sqrt(z2)))
        assert np.allclose(root, want, rtol=0, atol=1e-12 * want.max())
        assert (root >= d).all() and (root[:-1] <= d[1:]).all()


def test_whitening_against_brute_force(s):
    rng = np.random.default_rng(2)
    scale = np.linspace(0.05, 1.3, 9)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=9) * scale]) for i in range(150)]
    rows += [(i, rows[3][1]) for i in range(500, 560)]               # a vector of many rows
    check(s, rows)
    check(s, [(1, [0.5]), (2, [0.25]), (2, [-1.0]), (None, [0.5])])


def test_whitening_of_the_given_table(s):
    rows = [(r.vec_id, r.embedding) for r in s.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(s, rows)


def test_whitening_of_odd_rows(s):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [1.0, 2.0, 3.0])]
    fine = [(10, [-0.0, 0.5]), (10, [-0.0, 0.5]), (None, [1.0, -2.0]), (12, [0.3, 0.1]), (13, [2.0, 2.5])]
    df = s.createDataFrame([(i, v, None, None, None) for i, v in bad + fine], EMB)
    got = W.whiten_embeddings(s, df).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(["10"] * 4 + ["None"] * 2 + ["12"] * 2 + ["13"] * 2)
    assert {r.n for r in got} == {4} and all(r.identity_error < 1e-12 for r in got)
    # nothing varies: whitened is 0 and there is nothing to explain
    one = W.whiten_embeddings(s, s.createDataFrame([(1, [0.5, 1.0], 0, "", 0)] * 3, EMB)).collect()
    assert len(one) == 6 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {
        (1, 0, 0.0, None, None)}
    # far entries: taken as the bound; a deviation beyond a long is null
    far = W.whiten_embeddings(s, s.createDataFrame([(1, [3e38, 0.0], 0, "", 0), (2, [-3e38, 1.0], 0, "", 0)], EMB))
    assert {r.deviation for r in far.collect()} == {None}
    empty = s.createDataFrame([], EMB)
    assert W.whiten_embeddings(s, empty).count() == 0
    assert W.whiten_embeddings(s, df.where("vec_id < 6")).count() == 0


@pytest.mark.parametrize("parts", [1, 40])
def test_spectra_of_many_partitions_combine(s, parts):
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(200, 5)) * [1, 5, 20, 50, 100]).astype(int)
    df = s.createDataFrame([(r.tolist(),) for r in x], "x array<long>").repartition(parts)
    got = W.spectrum(s, df, 5, fan=2 if parts == 1 else 3)
    c = x - x.mean(axis=0)
    assert got.n == 200 and np.allclose(got.d, np.linalg.eigvalsh(c.T @ c), rtol=1e-10)

"""Operator 12 against numpy's own eigenpairs and exact arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest
from starloom.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, label int, n string, x int"


def rows_of(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "clash", 1) for i, v in vectors], SCHEMA)


def check(spark, vectors, top=4):
    """The result of ``vectors`` beside a plain computation; returns the rows."""
    whole = [(i, v) for i, v in vectors if v and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in whole], dtype=object)
    fit = sorted({tuple(r) for r in x.tolist()})
    n, d = len(fit), len(fit[0])
    sums = [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(r, sums, strict=True)] for r in fit])
    cov = centred.T @ centred / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:top], vecs[:, ::-1][:, :top]
    got = w.whitened(rows_of(spark, vectors), top=top).collect()
    assert sorted((r.vec_id is not None, r.vec_id or 0, r.component) for r in got) == sorted((i is not None, i or 0, k + 1) for i, _ in whole for k in range(min(top, d)))
    assert {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9 and len({r.identity_error for r in got}) == 1
    for r in got:
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
    by = {}
    for r in got:
        by.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    for k in range(min(top, d)):
        mine = by[k + 1]
        for row, (i, _) in zip(x, whole, strict=True):
            assert any(q.deviation == sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for q in mine[i])
    return got, values, vecs, centred, fit, x, whole


def test_equals_numpy(spark):
    rng = np.random.default_rng(1)
    mix = rng.standard_normal((12, 12))
    vectors = [(i, [float(c) for c in mix @ rng.standard_normal(12) * 0.2]) for i in range(300)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(200)] + [(None, vectors[1][1]), (5, vectors[2][1])]
    vectors += [(2000, None), (2001, []), (2002, [None] + [0.0] * 11), (2003, [float("nan")] * 12), (2004, [float("inf")] * 12), (2005, [0.5] * 3), (2006, [-0.0] * 12)]
    clean = [(i, v) for i, v in vectors if i != 2005]
    got, values, vecs, centred, fit, x, whole = check(spark, clean)
    assert {r.vec_id for r in w.whitened(rows_of(spark, vectors)).collect()} == {r.vec_id for r in got}
    place = {t: k for k, t in enumerate(fit)}
    want = centred @ vecs / np.sqrt(values)
    ours = {}
    for r in got:
        if r.vec_id is not None and r.vec_id not in (5,):
            ours[r.vec_id, r.component] = r.whitened
    for k in range(4):
        a = np.array([ours[i, k + 1] for i, _ in whole if i not in (None, 5)])
        b = np.array([want[place[tuple(row)], k] for row, (i, _) in zip(x.tolist(), whole, strict=True) if i not in (None, 5)])
        assert np.abs(a - np.sign(a @ b) * b).max() < 1e-8


@pytest.mark.parametrize("seed", range(6))
def test_leading_eigenpairs(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 40))
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    spectrum = [rng.random(n), np.round(rng.random(n) * 3), np.full(n, 2.0), 10.0 ** -np.arange(n), np.append(1 + 1e-14, np.ones(n))[:n], rng.random(n) * 1e200][seed]
    a = q @ np.diag(spectrum) @ q.T
    a = (a + a.T) / 2
    values, vectors = w.leading_eigenpairs(a, 5)
    k = min(5, n)
    size = np.abs(a).max()
    assert np.allclose(values / size, np.sort(spectrum)[::-1][:k] / size, rtol=0, atol=1e-12)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(a / size @ vectors - vectors * values / size).max() < 1e-12


def test_degenerate_matrices():
    assert w.leading_eigenpairs(np.zeros((3, 3)), 2)[0].size == 0
    for a in (np.eye(4), np.diag([3.0, 1, 1, 2]), np.diag([0.0, 0, 5])):
        values, vectors = w.leading_eigenpairs(a, 3)
        assert np.allclose(values, np.sort(np.diag(a))[::-1][:3], atol=1e-14)
        assert np.abs(a @ vectors - vectors * values).max() < 1e-13 and np.abs(vectors.T @ vectors - np.eye(3)).max() < 1e-13


def test_sturm_counts():
    d, e = np.array([2.0, 0.0, 2.0, 5.0]), np.array([1.0, 0.0, 1e-3])
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    for x in np.linspace(-2, 6, 41):
        assert w.sturm_count(d, e, x) == (values < x).sum()


def test_few_components_and_no_spread(spark):
    got = w.whitened(rows_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 4.0]), (3, [1.0, 9.0])])).collect()
    assert {r.component for r in got} == {1} and all(r.explained == pytest.approx(1) for r in got)
    for vectors in ([], [(1, None)], [(1, [1.0]), (2, [1.0])]):
        assert w.whitened(rows_of(spark, vectors)).collect() == []


def test_huge_entries(spark):
    got = w.whitened(rows_of(spark, [(1, [1e38, 0.0]), (2, [-1e38, 1.0]), (3, [0.0, 3.0])])).collect()
    sums = (-1, 1024)  # the ends of 64 bits and 0; 0, 256 and 768
    assert {r.n for r in got} == {3} and {(r.vec_id, r.deviation) for r in got} == {(1, None), (2, None), (3, (0 - sums[0]) ** 2 + (3 * 768 - sums[1]) ** 2)}
    assert all(math.isfinite(r.whitened) for r in got)

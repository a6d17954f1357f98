"""Whitening against a dense eigendecomposition and exact integers."""

import math
import random

import numpy as np
import pytest

pytest.importorskip("touchline.llm")

from touchline.llm import whitening  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, vec int, component string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, "z", 5) for i, e in rows], SCHEMA).repartition(4)


def check(spark, rows):
    usable = [(i, e) for i, e in rows if e and all(x is not None and math.isfinite(x) for x in e)]
    sizes = [len(e) for _, e in usable]
    width = min(set(sizes), key=lambda n: (-sizes.count(n), n)) if sizes else 0
    usable = [(i, tuple(math.floor(256 * x) for x in e)) for i, e in usable if len(e) == width]
    fit = np.array(sorted({x for _, x in usable}), float)
    n, s = len(fit), [sum(x[d] for x in {x for _, x in usable}) for d in range(width)]
    v = (fit - fit.mean(axis=0)).T @ (fit - fit.mean(axis=0)) / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    k = min(4, int((e > 1e-12 * e.sum()).sum()))
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == k * len(usable)
    assert {r.n for r in got} == ({n} if got else set())
    assert all(r.identity_error < 1e-8 and abs(r.explained - e[r.component - 1] / e.sum()) < 1e-10 for r in got)
    want = sorted((str(i), c + 1, sum((n * x[d] - s[d]) ** 2 for d in range(width))) for i, x in usable for c in range(k))
    assert sorted((str(r.vec_id), r.component, r.deviation) for r in got) == want
    simple = [c for c in range(k) if all(abs(e[c] - e[o]) > 1e-6 * e[0] for o in range(width) if o != c)]
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r.whitened)
    for c in simple:
        a, b = [], []
        for i, x in usable:
            a += by[i, c + 1][:1] if sum(j == i for j, _ in usable) == 1 else []
            b += [float((np.array(x) - fit.mean(axis=0)) @ q[:, c] / e[c] ** 0.5)] if sum(j == i for j, _ in usable) == 1 else []
        a, b = np.array(a), np.array(b)
        assert np.abs(a - b * np.sign(a @ b)).max() < 1e-8
    return got


def test_whitening(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1 + d) for d in range(7)]) for i in range(120)]
    rows += [(500 + i, rows[3][1]) for i in range(60)]  # a hot vector counts once
    rows += [(600, None), (601, []), (602, [None] * 7), (603, [1.0, float("inf")] + [0.0] * 5), (604, [1.0] * 3), (None, rows[5][1]), (7, rows[8][1]), (605, [0.001] * 7)]
    check(spark, rows)


def test_few_dimensions_and_rows(spark):
    check(spark, [(i, [float(i % 5), float(i % 3)]) for i in range(30)])
    check(spark, [(1, [1.0, 2.0]), (2, [3.0, 5.0])])  # rank one
    assert check(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).count() == 0


def test_equal_eigenvalues(spark):
    rows = [(2 * d + (s > 0), [s * (d == j) for j in range(5)]) for d in range(5) for s in (-1.0, 1.0)]
    got = check(spark, rows)
    assert len(got) == 40


def test_large_entries(spark):
    got = whitening.whiten(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 5.0]), (3, [0.0, 1.0])])).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and {r.deviation for r in got if r.vec_id == 1} == {None}


def test_slicing():
    rng = np.random.default_rng(4)
    for size in (1, 2, 5, 30):
        a = rng.normal(size=(size, size))
        v = a @ a.T
        e = np.linalg.eigvalsh(v)
        for shift in [*rng.uniform(-1, e[-1] * 1.1, 20), 0.0]:
            assert whitening.above(v, shift) == (e > shift).sum()
            assert whitening.above(-v, -shift) == (-e > -shift).sum()
        found = whitening.leading(v, 4)
        assert np.allclose([x for x, _ in found], e[::-1][:4], rtol=1e-12)
        assert all(np.allclose(v @ x, value * x, atol=1e-11 * e[-1]) for value, x in found)
    assert whitening.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1  # needs a pivot of two rows
    near = np.diag([3.0, 3.0 - 1e-9, 1.0, 1.0, 1.0])
    assert np.allclose([x for x, _ in whitening.leading(near, 4)], [3, 3 - 1e-9, 1, 1], rtol=1e-14)

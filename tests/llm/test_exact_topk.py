"""Exact top-k against brute force in Python integers."""

import math
import random

import numpy as np
import pytest

pytest.importorskip("touchline.llm")

from touchline.llm import exact_topk  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, label int, entry long, q long, score string"


def brute(rows, k, every):
    usable = {}
    for i, e in rows:
        if i is not None and e and all(x is not None and math.isfinite(x) for x in e):
            usable[i] = max(usable.get(i, b""), np.floor(1024 * np.array(e)).astype("<i8").tobytes())
    vectors = {i: np.frombuffer(v, "<i8") for i, v in usable.items()}
    size = [len(v) for v in vectors.values()]
    width = min(set(size), key=lambda n: (-size.count(n), n)) if size else 0
    vectors = {i: v for i, v in vectors.items() if len(v) == width}
    out = []
    for i, v in vectors.items():
        if i % every == 0:
            found = sorted((-sum(int(a) * int(b) for a, b in zip(v, w, strict=True)), j) for j, w in vectors.items() if j != i)
            out += [(i, r, j, -s) for r, (s, j) in enumerate(found[:k], 1)]
    return sorted(out)


def check(spark, rows, k=10, every=5):
    df = spark.createDataFrame([(i, e, 1, 2, 3, "z") for i, e in rows], SCHEMA).repartition(4)
    got = exact_topk.exact_top(df, lambda c: c % every == 0, k)
    assert sorted(map(tuple, got.collect())) == brute(rows, k, every)


def vectors(rng, n, d, scale=1.0):
    return [[rng.gauss(0, scale) for _ in range(d)] for _ in range(n)]


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK", 64)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 16)
    rng = random.Random(1)
    rows = list(enumerate(vectors(rng, 300, 12)))
    same = rows[7][1]
    rows += [(400 + i, same) for i in range(90)]  # a hot vector
    rows += [(600 + i, [x + rng.gauss(0, 1e-3) for x in same]) for i in range(90)]  # near copies
    rows += [(700, None), (705, []), (710, [None] * 12), (715, [float("nan")] * 12), (720, [1.0] * 7), (None, same),
             (725, [0.0] * 12), (730, [-x for x in same]), (5, same), (5, same), (0, rows[0][1])]
    check(spark, rows)


def test_few_and_tied_rows(spark):
    check(spark, [(i, [float(i % 3), 1.0]) for i in range(40)], k=7)
    check(spark, [(i, [1.0]) for i in range(4)])
    check(spark, [(i, [-1.0 - i, -2.0]) for i in range(15)])
    check(spark, [(5, [1.0, 2.0])])
    check(spark, [])


def test_large_integers(spark):
    rng = random.Random(2)
    check(spark, list(enumerate(vectors(rng, 60, 8, 1e5))))  # beyond the range that doubles hold exactly
    most = math.isqrt((1 << 62) // 2)
    df = spark.createDataFrame([(0, [1e300, 1.0]), (1, [1e300, -1e300])], "vec_id long, embedding array<double>")
    assert [r.score for r in exact_topk.exact_top(df, lambda c: c == 0).collect()] == [most * most - 1024 * most]

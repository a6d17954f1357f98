"""What the boosted trees spare, with the same trees."""

import threading
from datetime import datetime

import numpy as np
import pytest

from touchline.ml import leafwise, train
from touchline.ml.leafwise import Growth


def test_features_of_one_bin_are_not_counted(monkeypatch):
    rng = np.random.default_rng(3)
    x = np.asfortranarray(rng.integers(0, 8, (500, 6)).astype(np.uint8))
    x[:, 2], x[:, 5] = 0, 3
    g, rows = rng.normal(size=500) * 1e6, np.flatnonzero(rng.random(500) < 0.4)
    seen = leafwise.histogram(x, np.arange(500), g, 8)[1]
    whole = leafwise.histogram(x, rows, g, 8)
    counted, real = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **k: counted.append(a) or real(*a, **k))
    part = leafwise.histogram(x, rows, g, 8, seen)
    assert np.array_equal(whole, part) and len(counted) == 9  # twice for four features, once for both others
    assert leafwise.histogram(x, rows[:0], g, 8, seen).sum() == 0


def test_known_counts_grow_the_same_tree():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 8, (600, 4)).astype(np.uint8)
    x[:, 1] = 0
    y, growth = x[:, 0] * 3.0 + (x[:, 2] > 4) + rng.normal(size=600), Growth(bins=8, min_rows=5)
    seen = leafwise.histogram(x, np.arange(600), y, 8)[1]
    plain, known = leafwise.grow(x, -y, growth, lambda a: a), leafwise.grow(np.asfortranarray(x), -y, growth, lambda a: a, seen)
    assert plain[0] == known[0] and np.array_equal(plain[1], known[1])


def test_a_run_fits_both_of_its_models_at_once(spark, monkeypatch):
    class Done(Exception):
        pass

    class Times:
        def fit_rows(self, frame):
            return frame

        development = tuning_rows = fit_rows

    class Forecaster:
        met = threading.Barrier(2)

        def fit(self, rows):
            self.met.wait(20)  # breaks where one fit waits for the other
            raise Done

    monkeypatch.setattr(train.splits, "chronology", lambda frame, n: Times())
    with pytest.raises(Done):
        train.evaluate_model(spark.range(1), Forecaster(), "v", datetime(2002, 1, 1))

"""The fit over all labelled rows and pairs."""

import numpy as np
import pytest

from roadlake.llm import ranking
from roadlake.llm.ranking import FEATURES

K = len(FEATURES)


def frame(spark, x, y, at=0):
    ids = range(at, at + len(y))
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in zip(ids, x)], "doc_id long, " + ", ".join(f"{c} double" for c in FEATURES))
    return rows, spark.createDataFrame([(i, int(v)) for i, v in zip(ids, y)], "doc_id long, label int")


def all_pairs(x, y):
    """Newton steps over the differences of every good and bad row."""
    good, bad = x[y == 1], x[y == 0]
    d = (good[:, None, :] - bad[None, :, :]).reshape(-1, K)
    w = np.zeros(K)
    for _ in range(ranking.STEPS):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ranking.RIDGE * np.eye(K)
        step = np.linalg.solve(curve, d.T @ p / len(d) - ranking.RIDGE * w)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return w


@pytest.mark.parametrize("copies", [1, 2])
def test_every_pair_counts(spark, copies):
    rng = np.random.default_rng(5)
    x = rng.random((300, K))
    y = (x[:, 2] + 0.3 * x[:, 5] + 0.3 * rng.random(300) < 0.8).astype(int)
    rows, labels = frame(spark, x, y)
    got = ranking.fit(rows, labels.union(labels) if copies == 2 else labels)
    want = all_pairs(x, y)
    assert np.allclose(got.weights, want, atol=2e-3)
    assert np.allclose(ranking.learn(x, y).weights, got.weights, atol=1e-7)
    s, bad = np.sort(np.repeat(x @ np.array(got.weights), copies)), copies * int((y == 0).sum())
    assert got.threshold == pytest.approx((s[bad - 1] + s[bad]) / 2, abs=1e-9)


def test_rows_beyond_twelve_thousand_are_learned_from(spark):
    """20,000 rows: the threshold is the quantile of all their scores."""
    rng = np.random.default_rng(6)
    x = rng.random((20_000, K))
    y = (x[:, 2] + 0.4 * rng.random(20_000) < 0.8).astype(int)
    rows, labels = frame(spark, x, y)
    got = ranking.fit(rows, labels)
    s, bad = np.sort(x @ np.array(got.weights)), int((y == 0).sum())
    assert got.threshold == pytest.approx((s[bad - 1] + s[bad]) / 2, abs=1e-9)
    assert np.allclose(ranking.learn(x, y).weights, got.weights, atol=1e-7)


def test_one_kind_and_none(spark):
    rows, labels = frame(spark, np.ones((3, K)), [1, 1, 1])
    assert ranking.fit(rows, labels).threshold == pytest.approx(-np.log(4))
    assert ranking.fit(rows, labels.where("label = 0")).threshold == 0

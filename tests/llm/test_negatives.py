"""Hard negatives against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlake.llm import negatives

SHAPE = "vec_id long, embedding array<float>, label int, id string, anchor string, score string"


def brute(rows, every=5, positives=5, best=3, low=50, high=95):
    ok = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows
          if i is not None and v is not None and c is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, v, c in ok:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (c, v)), (c, v))
    out = []
    for a, (c, v) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, k) for i, w, k in ok if i != a)
        for s, p, _ in [x for x in scored if x[2] == c][:positives]:
            fits = [x for x in scored if x[2] != c and low * -s <= -100 * x[0] <= high * -s][:best]
            out += [(a, p, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(fits)]
    return sorted(out)


def table(n, seed, labels=3, dim=4):
    rng = random.Random(seed)
    return [(i, [np.float32(rng.gauss(.3, .5)).item() for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "own", "own", "own") for r in rows], SHAPE).repartition(3)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, **options).collect())


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 20)
    monkeypatch.setattr(negatives, "STRIPE_ROWS", 60)
    monkeypatch.setattr(negatives, "TILE", 256)


def test_equals_brute_force_over_blocks_ties_and_odd_rows(spark, small_blocks):
    rows = table(250, 1)
    rows += [(1000 + i, rows[7][1], 1) for i in range(40)]                 # equal vectors: ties by id
    rows += [(2000 + i, [0.0] * 4, i % 3) for i in range(10)]             # zero scores
    rows += [(11, [5.0, 5.0, 5.0, 5.0], 0), (11, [5.0, 5.0, 5.0, 5.0], 0)]  # repeated rows
    rows += [(4, rows[4][1], 2), (-5, [.5, .25], 1), (3001, [], 1), (3005, [], 1)]
    rows += [(None, rows[0][1], 0), (3002, None, 0), (3003, rows[3][1], None), (3010, [1.0, None, 1.0, 1.0], 0),
             (3004, [1.0, math.nan, 1.0, 1.0], 0), (3015, [math.inf, 0.0, 0.0, 0.0], 0), (3006, [-math.inf, 0.0, 0.0, 0.0], 0)]
    assert run(spark, rows) == brute(rows)


def test_a_label_with_most_rows_and_other_parameters(spark, small_blocks):
    rows = [(i, v, 0 if i % 3 else c) for i, v, c in table(300, 2, labels=4)]
    assert run(spark, rows, positives=2, negatives=4, low=0, high=100) == brute(rows, positives=2, best=4, low=0, high=100)


def test_repeated_anchor_rows_give_one_anchor(spark):
    rows = table(60, 3) + [(10, [.1, .2, .3, .4], 1), (10, [.1, .2, .3, .4], 0)]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_no_anchor(spark):
    df = spark.createDataFrame([], SHAPE)
    out = negatives.hard_negatives(df, F.col("vec_id") % 5 == 0)
    assert out.collect() == [] and out.columns[:3] == ["anchor_id", "positive_id", "rank"]
    assert run(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []


def test_scores_are_exact_at_every_magnitude():
    rng = np.random.default_rng(4)
    for scale in (1e3, 1e9, 3e10, 1e25):
        a, b = (np.floor(rng.normal(size=(5, 6)) * scale) for _ in range(2))
        whole = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        cut = [[min(max(x, -2 ** 63), 2 ** 63 - 1) for x in r] for r in whole]
        assert negatives.scores(a, b).tolist() == cut


def test_keys_sort_like_their_tuples():
    rng = random.Random(5)
    rows = [(rng.choice([-7, 0, 3, 2 ** 62]), rng.choice([-2 ** 63, -1, 0, 5, 2 ** 63 - 1]), rng.randrange(2), rng.randrange(-3, 3))
            for _ in range(200)]
    import pyarrow as pa
    batch = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 2 + [pa.int32(), pa.int64()])],
                     names=["anchor", "score", "kind", "id"]).to_batches()[0]
    keys = next(negatives._pack([batch])).column("key")
    assert list(negatives._unpack(keys)) == rows
    packed = keys.to_pylist()
    assert [rows[i] for i in sorted(range(200), key=packed.__getitem__)] == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))

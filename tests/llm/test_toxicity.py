"""Terms, pairs and repeated rows of the factorization machine."""

import random

import numpy as np
from pyspark.sql import functions as F

from roadlake.llm import toxicity

DOCS = "doc_id long, text string"
LABELS = "doc_id long, label int"


def agreeing(n, seed):
    """Labels say whether two terms agree; each alone says nothing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.random() < .5, rng.random() < .5
        filler = [f"w{rng.randrange(400)}" for _ in range(20)]
        rows.append((i, " ".join(filler + ["Left"] * a + ["right"] * b), int(a == b)))
    return rows


def machine(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS)
    return toxicity.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], LABELS))


def test_a_pair_of_neutral_terms_is_learned(spark):
    m = machine(spark, agreeing(1200, 1))
    held = agreeing(400, 2)
    got = toxicity.scored(spark.createDataFrame([r[:2] for r in held], DOCS), m).collect()
    assert np.mean([g.predicted == r[2] for g, r in zip(sorted(got), held)]) > .97


def test_the_number_of_kept_terms_has_no_limit(spark):
    """600 marking terms, each in a few toxic rows only."""
    rng = random.Random(3)
    rows = [(i, " ".join([f"c{rng.randrange(50)}" for _ in range(8)] + [f"bad{rng.randrange(600)}" for _ in range(8)] * (i % 4 == 0)),
             int(i % 4 == 0)) for i in range(4000)]
    assert len(machine(spark, rows).weight) > 500


def test_sparse_margins_equal_dense_ones(spark):
    m = machine(spark, agreeing(300, 4))
    rng = np.random.default_rng(5)
    known = np.flatnonzero(m.place >= 0)
    rows = [np.unique(np.concatenate([rng.choice(known, min(2, len(known))), rng.integers(0, toxicity.BINS, 5)])) for _ in range(20)] + [np.empty(0, int)]
    x = np.zeros((len(rows), len(m.weight)))
    for i, b in enumerate(rows):
        x[i, m.place[b][m.place[b] >= 0]] = 1
    got = m.margins(len(rows), np.repeat(np.arange(len(rows)), [len(b) for b in rows]), np.concatenate(rows).astype(int))
    assert np.allclose(got, m.margin(x), atol=1e-5)


def test_a_row_repeated_often_is_learned_from_once(spark):
    rows = agreeing(400, 6)
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (5, None)], LABELS)
    hot = docs.union(spark.range(100_000).select(F.lit(7).cast("long"), F.lit(rows[7][1])))
    once, often = toxicity.fit(docs, labels), toxicity.fit(hot, labels)
    assert np.array_equal(once.place, often.place) and np.allclose(once.factor, often.factor)


def test_learned_rows_are_bounded_by_their_bins(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "ENTRIES", 2000)
    seen = []
    monkeypatch.setattr(toxicity, "learn", lambda bins, y: seen.append((sum(map(len, bins)), len(y))))
    machine(spark, agreeing(400, 8))
    assert 1900 < seen[0][0] <= 2000 and 0 < seen[0][1] < 400


def test_no_labels_and_no_rows(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 1)], LABELS)
    assert toxicity.fit(docs, labels).bias == 0
    one = toxicity.fit(spark.createDataFrame([(1, "a b"), (2, None)], DOCS), labels)
    assert [r.predicted for r in toxicity.scored(spark.createDataFrame([(1, None), (2, "")], DOCS), one).collect()] == [1, 1]

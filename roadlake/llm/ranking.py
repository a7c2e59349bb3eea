"""Quality classifier by Bradley-Terry pairwise ranking.

Each document gets statistics of its whole text. Every labelled pair of a good
and a bad document is a preference; weights come from the logistic loss on the
differences of their features (Newton steps, small ridge). A document's latent
score is its weighted sum; the threshold is the quantile of the training
scores at the share of bad documents, and the reported score is the logistic
of the distance to it, so 0.5 is the threshold.

The fit reads every labelled row and counts every pair. A pair's chance depends
on its two scores alone, so a step needs the rows' sums (number, features, their
products) in ``BINS`` equal ranges of the score, one aggregation over the
training rows; pairs of ranges stand for the pairs of their rows, each range at
the mean score of its rows. The threshold is the exact quantile, found by
counting in ever smaller ranges. What comes to the driver does not grow.

Defined cases: null and empty texts have all-zero features and get a score;
rows with a null label or doc_id are not learned from; repeated rows score
alike; with labels of one kind only the score is that label's share, smoothed;
no labels: 0.5.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import drop_clashing, materialize, read, text_of
from roadlake.llm.quality_rules import let, statistics

FEATURES = ("length", "word_size", "symbols", "symbol_share", "lines_again", "words_again", "capitals", "marks", "blank")
BINS = 1024
RIDGE = 1e-2
STEPS = 12


def features(text: Column) -> Column:
    """Struct of FEATURES, each between 0 and about 1."""
    def of(s: Column) -> Column:
        n = F.greatest(s["n_words"], F.lit(1))

        def share(a: Column, b: Column, times: float = 1.0) -> Column:
            return F.least(F.lit(1.0), times * a / F.greatest(b, F.lit(1)))

        cells = (F.log1p(s["n_words"]) / 10, share(s["word_chars"], n, 0.1), share(s["n_symbols"], n),
                 share(s["n_symbols"], s["word_chars"], 5.0), share(s["n_dup_lines"], s["n_lines"]),
                 share(s["n_repeat_words"], n), share(s["n_upper"], s["n_letters"]), share(s["n_marks"], n),
                 (s["n_words"] == 0).cast("double"))
        return F.struct(*[c.cast("double").alias(k) for k, c in zip(FEATURES, cells, strict=True)])

    return let(statistics(text), of)


@dataclass(frozen=True)
class Ranking:
    weights: tuple[float, ...]
    threshold: float


#: Pairs of features whose products a step needs.
PRODUCTS = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]


def newton(w: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """One step from ``w``. ``bins``: a row for each label and range of the
    score (label, number, sums of the features, sums of PRODUCTS)."""
    k = len(w)

    def parts(label: int):
        b = bins[bins[:, 0] == label]
        square = np.zeros((len(b), k, k))
        for n, (i, j) in enumerate(PRODUCTS):
            square[:, i, j] = square[:, j, i] = b[:, 2 + k + n]
        return b[:, 1], b[:, 2:2 + k], square, b[:, 2:2 + k] @ w / b[:, 1]

    n, x, xx, s = parts(1)
    m, y, yy, t = parts(0)
    pairs = n.sum() * m.sum()
    p = 1 / (1 + np.exp(np.clip(s[:, None] - t[None, :], -30, 30)))      # chance of the wrong order
    q = p * (1 - p)
    gradient = ((p @ m) @ x - (n @ p) @ y) / pairs - RIDGE * w
    cross = x.T @ q @ y
    curve = (np.tensordot(q @ m, xx, 1) + np.tensordot(n @ q, yy, 1) - cross - cross.T) / pairs + RIDGE * np.eye(k)
    step = np.linalg.solve(curve, gradient)
    return w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))


def descend(least: np.ndarray, most: np.ndarray, bins_of) -> np.ndarray:
    """Weights after the Newton steps. ``least`` and ``most``: bounds of each
    feature; ``bins_of(w, low, width)``: the rows' sums as ``newton`` takes them."""
    w = np.zeros(len(FEATURES))
    for _ in range(STEPS):
        low, high = np.minimum(w * least, w * most).sum(), np.maximum(w * least, w * most).sum()
        before, w = w, newton(w, bins_of(w, low, (high - low) / BINS or 1.0))
        if np.abs(w - before).max() < 1e-7:
            break
    # the order in which sums are taken moves the last digits only
    return np.round(w, 9)


def one_kind(good: float, rows: float) -> Ranking:
    """Without pairs, the score is the share of good rows, smoothed."""
    p = (good + 1) / (rows + 2) if rows else 0.5
    return Ranking((0.0,) * len(FEATURES), -math.log(p / (1 - p)))


def middle(rows: float, bad: float) -> int:
    """The threshold lies between the scores of this rank (from 0) and before."""
    return int(min(rows - 1, max(1, bad)))


def learn(x: np.ndarray, y: np.ndarray) -> Ranking:
    """Weights and threshold from all good-bad pairs of rows in memory."""
    bad = int((y == 0).sum())
    if not bad or bad == len(y):
        return one_kind(float(y.sum()), len(y))

    def bins_of(w, low, width):
        place = np.clip(((x @ w - low) / width).astype(int), 0, BINS - 1) + BINS * (y == 1)
        values = np.column_stack([np.ones(len(x)), x, *[x[:, i] * x[:, j] for i, j in PRODUCTS]])
        used, back = np.unique(place, return_inverse=True)
        return np.column_stack([used >= BINS, *[np.bincount(back, v) for v in values.T]])

    w = descend(x.min(0), x.max(0), bins_of)
    scores, k = np.sort(x @ w), middle(len(y), bad)
    return Ranking(tuple(w), float((scores[k - 1] + scores[k]) / 2))


def at_rank(scores: DataFrame, rank: int) -> float:
    """The score (column s, n times a row) of a rank from 0, by counts in
    ranges: the range that holds it is split until its scores are one."""
    low, high = scores.agg(F.min("s"), F.max("s")).first()
    while low < high:
        width = (high - low) / BINS
        place = F.least(F.floor((F.col("s") - low) / F.lit(width or high - low)), F.lit(BINS - 1))
        held = scores.where(F.col("s").between(low, high)).groupBy(place.alias("b")) \
            .agg(F.sum("n").alias("n"), F.min("s").alias("low"), F.max("s").alias("high")).collect()
        for r in sorted(held, key=lambda r: r["b"]):
            if rank < r["n"]:
                low, high = r["low"], r["high"]
                break
            rank -= r["n"]
    return low


def fit(rows: DataFrame, labels: DataFrame) -> Ranking:
    """``rows``: doc_id and FEATURES; ``labels``: doc_id, label (0 or 1). Learns
    from every row of a labelled doc_id, once for each of its labels."""
    labelled = (labels.where("doc_id is not null and label in (0, 1)")
                .groupBy("doc_id", F.col("label").cast("int").alias("label")).agg(F.count("*").alias("n")))
    train = materialize(rows.join(labelled, "doc_id").select("label", "n", *FEATURES), "train")
    bounds = train.agg(F.sum("n"), F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)),
                       *[f(c) for f in (F.min, F.max) for c in FEATURES]).first()
    count, good = bounds[0] or 0, bounds[1] or 0
    if not good or good == count:
        return one_kind(good, count)

    def latent(w):
        return sum((float(v) * F.col(c) for v, c in zip(w, FEATURES, strict=True)), F.lit(0.0))

    def bins_of(w, low, width):
        place = F.greatest(F.least(F.floor((latent(w) - float(low)) / float(width)), F.lit(BINS - 1)), F.lit(0))
        sums = [F.sum("n")] + [F.sum(F.col("n") * F.col(c)) for c in FEATURES] + \
            [F.sum(F.col("n") * F.col(FEATURES[i]) * F.col(FEATURES[j])) for i, j in PRODUCTS]
        got = train.groupBy("label", place.alias("b")).agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)])
        return np.array([tuple(r) for r in got.drop("b").collect()], float)

    bounds = np.array(bounds[2:], float)
    w = descend(bounds[:len(FEATURES)], bounds[len(FEATURES):], bins_of)
    scores, k = train.select(latent(w).alias("s"), "n"), middle(count, count - good)
    below = at_rank(scores, k - 1)
    upto, above = scores.agg(F.sum(F.when(F.col("s") <= below, F.col("n"))), F.min(F.when(F.col("s") > below, F.col("s")))).first()
    return Ranking(tuple(w.tolist()), (below + (below if upto > k else above)) / 2)


def score(ranking: Ranking, c) -> Column:
    latent = F.lit(-ranking.threshold)
    for name, w in zip(FEATURES, ranking.weights, strict=True):
        latent = latent + w * c(name)
    return 1 / (1 + F.exp(-latent))


def scored(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """``docs`` with score and predicted."""
    text = let(features(text_of()), lambda s: score(ranking, lambda k: s[k]))
    return drop_clashing(docs, ["score", "predicted"]).withColumn("score", text) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", features(text_of()).alias("f")).select("doc_id", "f.*")
    rows = materialize(docs, "features")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    labels = read(spark, sf_dir, "labels").where(~held).select("doc_id", F.col("quality").alias("label"))
    return rows.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), score(fit(rows, labels), F.col).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

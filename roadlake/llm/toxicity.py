"""Toxicity by a factorization machine over hashed terms.

A term is a lower-cased run of letters, digits or non-ASCII characters, hashed
into 2**18 bins; a document is the set of bins it holds, anywhere in its text.
Two tests say which bins of the learned rows have a weight and factors; their
number has no limit. A bin is kept when its rate differs between toxic and other
rows beyond chance (``ALONE`` standard errors); two bins, each in ``PAIRED`` of
the rows or more, are kept when the rows that hold both leave the weights' own
prediction beyond chance (``TOGETHER``), so that terms which say nothing alone
count as a pair. The machine adds to the weights the inner products of the bins'
factors, so a pair such as an insult and a mention of a group counts beyond its
parts. It is fitted by gradient steps (Adam) on the logistic loss. Rows are kept
sparse: a step costs the learned rows' kept bins.

The fit reads at most ``SAMPLE`` distinct (doc_id, text) of labelled rows, those
with the smallest hashes, whole texts, and of these as many as hold ``ENTRIES``
distinct bins in all (only very long texts reach that).

Defined cases: null and empty texts hold no bin and score as the bias says;
rows with a null label or doc_id are not learned from; a repeated row is learned
from once and its copies score alike; bins that no learned row holds count
nothing; without labels of both kinds the score is the smoothed share.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import PLAIN, U, drop_clashing, hashed_words, materialize, read, text_of

BINS = 1 << 18
FACTORS = 4
SAMPLE = 12_000
ENTRIES = 8_000_000
STEPS = 250
ALONE, TOGETHER, PAIRED = 4.5, 6.0, 0.02
#: Penalties of weights and factors.
RIDGE = (1e-4, 1e-3)


@dataclass
class Machine:
    place: np.ndarray            # bin -> its number, or -1
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Margins of dense rows over the kept bins."""
        s = x @ self.factor
        return self.bias + x @ self.weight + 0.5 * (s ** 2 - (x ** 2) @ (self.factor ** 2)).sum(axis=1)

    def margins(self, n: int, row: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """Margins of ``n`` rows from their distinct (row, bin)."""
        number = self.place[bins]
        row, number = row[number >= 0], number[number >= 0]
        out = self.bias + np.bincount(row, self.weight[number], n)
        for f in self.factor.T:
            out += 0.5 * (np.bincount(row, f[number], n) ** 2 - np.bincount(row, f[number] ** 2, n))
        return out

    def scores(self, text: pa.Array) -> np.ndarray:
        out = []
        for a, b, h, rows in hashed_words(text, PLAIN):
            row, bins = distinct_bins(h, rows)
            out.append(1 / (1 + np.exp(-np.clip(self.margins(b - a, row, bins), -30, 30))))
        return np.concatenate(out).astype(np.float64) if out else np.empty(0)


def distinct_bins(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bin) of the words' hashes ``h``; row i's words are at
    ``rows[i]`` to ``rows[i + 1]``."""
    row = np.repeat(np.arange(len(rows) - 1, dtype=np.int64), np.diff(rows))
    key = np.unique(row * BINS + (h & U(BINS - 1)).astype(np.int64)[rows[0]:rows[-1]])
    return key // BINS, key % BINS


def learn(bins: list[np.ndarray], y: np.ndarray) -> Machine:
    """``bins``: each document's distinct bins."""
    n, n1 = len(y), int(y.sum())
    row = np.repeat(np.arange(n), [len(b) for b in bins])
    held = np.concatenate(bins).astype(np.int64) if len(bins) else np.empty(0, np.int64)
    if not 0 < n1 < n:
        return fitted(n, row[:0], held[:0], y, 0)
    df1 = np.bincount(held, weights=y[row], minlength=BINS)
    df = np.bincount(held, minlength=BINS)
    # difference of the two rates in standard errors
    p1, p0, p = df1 / n1, (df - df1) / (n - n1), df / n
    z = np.abs(p1 - p0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / (n - n1)) + 1e-9)
    keep = (z > ALONE) & (df > 1)
    own = keep[held]
    alone = fitted(n, row[own], held[own], y, 0)
    expected = 1 / (1 + np.exp(-alone.margins(n, row, held)))
    for a, b in paired(n, row, held, np.flatnonzero(df >= max(2, PAIRED * n)), y - expected, expected * (1 - expected)):
        keep[a] = keep[b] = True
    own = keep[held]
    return fitted(n, row[own], held[own], y, FACTORS)


def paired(n, row, held, often, rest, variance):
    """Pairs of the bins ``often`` whose common rows leave the prediction: the
    sum of ``rest`` over them is beyond TOGETHER of its standard errors."""
    number = np.full(BINS, -1, np.int64)
    number[often] = np.arange(len(often))
    at = number[held]

    def columns(i):
        x = np.zeros((n, min(512, len(often) - i)), np.float32)
        own = (at >= i) & (at < i + 512)
        x[row[own], at[own] - i] = 1
        return x

    r, v = rest.astype(np.float32)[:, None], variance.astype(np.float32)[:, None]
    for i in range(0, len(often), 512):
        x = columns(i)
        for j in range(i, len(often), 512):
            w = x if i == j else columns(j)
            far = np.abs(x.T @ (r * w)) > TOGETHER * np.sqrt(x.T @ (v * w) + 1e-6)
            a, b = np.nonzero(far)
            yield often[i + a[i + a != j + b]], often[j + b[i + a != j + b]]


def fitted(n: int, row: np.ndarray, held: np.ndarray, y: np.ndarray, factors: int) -> Machine:
    """The machine of the rows' distinct bins (``row`` ascending)."""
    prior = (y.sum() + 1) / (n + 2)
    known, flat = np.unique(held, return_inverse=True)
    k = len(known)
    m = Machine(np.full(BINS, -1, np.int32), float(np.log(prior / (1 - prior))), np.zeros(k, np.float32),
                np.random.default_rng(5).normal(0, 0.05, (k, factors)).astype(np.float32))
    if not k:
        return m
    m.place[known] = np.arange(k)
    # entries by row, and the same by bin
    full, row_at = np.unique(row, return_index=True)
    order = np.argsort(flat, kind="stable")
    row_of, bin_at = row[order], np.searchsorted(flat[order], np.arange(k))

    def by_row(values):
        out = np.zeros((n, values.shape[1]), np.float32)
        out[full] = np.add.reduceat(values[flat], row_at)
        return out

    state = [[np.zeros_like(v), np.zeros_like(v)] for v in (np.zeros(1), m.weight, m.factor)]
    for t in range(1, STEPS + 1):
        # one gather gives the sums of weights, factors and their squares
        sums = by_row(np.column_stack([m.weight, (m.factor ** 2).sum(axis=1), m.factor]))
        s = sums[:, 2:]
        z = m.bias + sums[:, 0] + 0.5 * ((s ** 2).sum(axis=1) - sums[:, 1])
        g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n).astype(np.float32)
        back = np.add.reduceat(np.column_stack([g, g[:, None] * s])[row_of], bin_at)
        grads = (np.array([g.sum()]), back[:, 0] + RIDGE[0] * m.weight,
                 back[:, 1:] - back[:, :1] * m.factor + RIDGE[1] * m.factor)
        steps = []
        for q, grad in zip(state, grads):
            q[0] = 0.9 * q[0] + 0.1 * grad
            q[1] = 0.99 * q[1] + 0.01 * grad ** 2
            steps.append(0.05 * (q[0] / (1 - 0.9 ** t)) / (np.sqrt(q[1] / (1 - 0.99 ** t)) + 1e-8))
        m.bias -= float(steps[0][0])
        m.weight -= steps[1].astype(np.float32)
        m.factor -= steps[2].astype(np.float32)
    return m


def _bins(batches):
    for batch in batches:
        for a, b, h, rows in hashed_words(batch.column("text"), PLAIN):
            row, bins = distinct_bins(h, rows)
            ends = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, pa.array(bins.astype(np.int32)))
            kept = [batch.column(c).slice(a, b - a) for c in ("doc_id", "label", "th")]
            yield pa.RecordBatch.from_arrays([*kept, lists], names=["doc_id", "label", "th", "bins"])


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """``docs``: doc_id, text; ``labels``: doc_id, label (0 or 1)."""
    sample = (labels.where("doc_id is not null and label in (0, 1)")
              .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
              .distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(SAMPLE))
    text = text_of()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th")) \
        .join(F.broadcast(sample), "doc_id")
    # one row for each (doc_id, text): narrow keys first, then these rows' texts
    chosen = rows.select("doc_id", "label", "th").distinct() \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "th", "label").limit(SAMPLE)
    chosen = materialize(chosen, "learned")
    own = rows.join(F.broadcast(chosen), ["doc_id", "label", "th"]).select("doc_id", "label", "th", "text")
    held = own.mapInArrow(_bins, "doc_id long, label int, th long, bins array<int>")
    held = materialize(held.dropDuplicates(["doc_id", "label", "th"]), "bins")
    key = {"th": "long", "doc_id": "long", "label": "int"}
    sizes = held.select(*key, F.size("bins").alias("n")).toArrow().to_pandas().sort_values(list(key))
    if sizes["n"].sum() > ENTRIES:
        last = sizes[(sizes["n"].cumsum() <= ENTRIES) | (np.arange(len(sizes)) < 1)].iloc[-1]
        held = held.where(F.struct(*key) <= F.struct(*[F.lit(int(last[c])).cast(t).alias(c) for c, t in key.items()]))
    got = held.toArrow()
    keys = [got.column(c).to_numpy() for c in ("label", "doc_id", "th")]
    got = got.take(np.lexsort(keys)) if len(got) else got
    lists = [b.values.to_numpy() for b in got.column("bins")]
    return learn(lists, got.column("label").to_numpy().astype(np.float64))


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with score and predicted."""
    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(machine.scores(text), pa.float64())

    return drop_clashing(docs, ["score", "predicted"]).withColumn("score", score(text_of())) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = read(spark, sf_dir, "labels").where(~held).select("doc_id", F.col("toxic").alias("label"))
    out = scored(docs, fit(docs, labels))
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")

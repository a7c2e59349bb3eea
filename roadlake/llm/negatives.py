"""Hard negatives by a secondary sort.

Every anchor's partners are read in one pass in the order (anchor, descending
score, same label first, id). The key is packed into fixed-width bytes, so one
bytewise sort inside each partition (rows are dealt by anchor) brings that
order, and a streaming iterator does the rest: an anchor's first rows of its
own label are its positives, each opens a window of scores, and the rows of
other labels that fall into an open window are emitted until it has enough.
The iterator holds a few windows, never an anchor's rows.

Not all scores are shuffled. Anchors and rows meet in blocks: anchors in
blocks of ``ANCHOR_BLOCK``, rows in stripes that stream past a block, batch by
batch, so a task holds one block of anchors and one batch of rows. In two
passes over the stripes

1. each anchor keeps its best ``positives`` rows of the same label a stripe;
   the best of all stripes fix its windows;
2. each anchor keeps, a stripe and window, its best ``negatives`` rows of
   other labels.

What a stripe leaves out has enough better rows in the same stripe, so the
sorted stream gives what it would give over all pairs. A label that holds a
third of the rows costs no more: a stripe sends at most ``positives *
(negatives + 1)`` rows an anchor. The work is anchors times rows, as a search
of a stated query set; each row is sent once to each block of anchors.

Scores are exact integers: products are summed as doubles while they are
below 2**53, as 64-bit integers below 2**63, and else as Python integers cut
to the range of a long.

Defined cases: rows with a null id, label or vector, or with a null or
non-finite component, take no part; a shorter vector counts as filled up with
zeros; rows that share an anchor's id are not its partners; of rows that share
an anchor's id the least (label, vector) is the anchor; other repeated rows
count as often as they occur, ties go to the smaller id; an anchor without
positives or negatives gives no rows; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlake.llm.common import materialize, read
from roadlake.session import parallelism

#: Most anchors (about) that a task holds, and least rows of a stripe.
ANCHOR_BLOCK, STRIPE_ROWS = 4096, 4096
#: Scores that are computed at a time.
TILE = 1 << 21
LONG = np.iinfo(np.int64)


def matrix(vectors: pa.Array, scale: float) -> np.ndarray:
    """floor(scale * x) of a list column, as doubles, rows filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    most = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        flat = np.floor(np.clip(vectors.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale, -most, most))
    size = np.diff(offsets)
    width = int(size.max(initial=0))
    if len(size) and (size == width).all():
        return flat[offsets[0]:offsets[-1]].reshape(len(size), width)
    out = np.zeros((len(size), width))
    out[np.arange(width)[None, :] < size[:, None]] = flat[offsets[0]:offsets[-1]]
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b`` as 64-bit integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    top = [float(np.abs(x).max(initial=0.0)) for x in (a, b)]
    most = top[0] * top[1] * width
    if most < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    if most < 2.0 ** 62 and max(top) < 2.0 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    a, b = ([[int(x) for x in row] for row in m] for m in (a, b))
    return np.array([[min(max(sum(map(operator.mul, x, y)), LONG.min), LONG.max) for y in b] for x in a], np.int64).reshape(len(a), len(b))


def best(score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int):
    """(row, column) of each row's ``k`` best allowed columns: higher scores
    first, ties by smaller id."""
    if score.shape[1] > k:
        floor = np.where(allowed, score, LONG.min)
        at = score.shape[1] - k
        allowed = allowed & (score >= np.partition(floor, at, axis=1)[:, at:at + 1])
    row, col = np.nonzero(allowed)
    order = np.lexsort((ids[col], ~score[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], col[place < k]


class _Kept:
    """The ``k`` best (score, id) of each anchor so far."""

    def __init__(self, k: int):
        self.k, self.row, self.id, self.score = k, *(np.empty(0, np.int64) for _ in range(3))

    def add(self, row, ids, score):
        row, ids, score = (np.concatenate(x) for x in ((self.row, row), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, ~score, row))
        row, ids, score = row[order], ids[order], score[order]
        top = np.arange(len(row)) - np.searchsorted(row, row) < self.k
        self.row, self.id, self.score = row[top], ids[top], score[top]


def _stripes(batches, begin, work, end):
    """Rows arrive sorted by (block, stripe, kind): for each (block, stripe),
    ``begin`` with its anchors (kind 0), ``work`` with its rows, batch by
    batch, and ``end``."""
    key, anchors, state = None, [], None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if not len(t):
            continue
        names = np.stack([t.column(c).to_numpy() for c in ("block", "stripe", "kind")])
        cuts = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1
        edges = [0, *cuts.tolist(), len(t)]
        for x, y in zip(edges[:-1], edges[1:]):
            own = tuple(names[:2, x].tolist())
            if own != key:
                if state is not None:
                    yield from end(state)
                key, anchors, state = own, [], None
            if names[2, x] == 0:
                anchors.append(t.slice(x, y - x))
            elif anchors:
                if state is None:
                    state = begin(pa.concat_tables(anchors))
                work(state, t.slice(x, y - x))
    if state is not None:
        yield from end(state)


def _tiles(state, rows: pa.Table, scale: float):
    """(ids, labels, scores) of some rows at a time against the state's anchors."""
    step = max(1, TILE // len(state["id"]))
    for i in range(0, len(rows), step):
        part = rows.slice(i, step)
        yield (part.column("id").to_numpy(), part.column("label").to_numpy(),
               scores(state["vector"], matrix(part.column("vector"), scale)))


def _anchors(t: pa.Table, scale: float) -> dict:
    return {"id": t.column("id").to_numpy(), "label": t.column("label").to_numpy(), "vector": matrix(t.column("vector"), scale)}


def _positives(batches, k: int, scale: float):
    def begin(t):
        return _anchors(t, scale) | {"kept": _Kept(k)}

    def work(state, rows):
        for ids, label, s in _tiles(state, rows, scale):
            same = (label[None, :] == state["label"][:, None]) & (ids[None, :] != state["id"][:, None])
            row, col = best(s, same, ids, k)
            state["kept"].add(row, ids[col], s[row, col])

    def end(state):
        kept = state["kept"]
        yield pa.RecordBatch.from_arrays([pa.array(state["id"][kept.row]), pa.array(kept.id), pa.array(kept.score)],
                                         names=["anchor", "id", "score"])

    yield from _stripes(batches, begin, work, end)


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Integer scores with low * score <= 100 * x <= high * score (from, to)."""
    return -(-low * score // 100), high * score // 100


def _negatives(batches, k: int, scale: float, low: int, high: int):
    def begin(t):
        state = _anchors(t, scale)
        opened = [[window(p, low, high) for p in own or ()] for own in t.column("windows").to_pylist()]
        most = max(map(len, opened), default=0)
        empty = (1, 0)
        state["windows"] = [(np.array([o[i] if i < len(o) else empty for o in opened], np.int64).T, _Kept(k)) for i in range(most)]
        return state

    def work(state, rows):
        for ids, label, s in _tiles(state, rows, scale):
            other = (label[None, :] != state["label"][:, None]) & (ids[None, :] != state["id"][:, None])
            for (low_end, high_end), kept in state["windows"]:
                row, col = best(s, other & (s >= low_end[:, None]) & (s <= high_end[:, None]), ids, k)
                kept.add(row, ids[col], s[row, col])

    def end(state):
        # a row of several windows goes once, repeated rows as often as a window holds them
        found = [np.stack([kept.row, kept.id, kept.score, _occurrence(kept.row, kept.id, kept.score)]) for _, kept in state["windows"]]
        if found:
            row, ids, score, _ = np.unique(np.concatenate(found, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(state["id"][row]), pa.array(ids), pa.array(score)],
                                             names=["anchor", "id", "score"])

    yield from _stripes(batches, begin, work, end)


def _occurrence(*columns) -> np.ndarray:
    """Place of each row among the equal rows beside it, from 0."""
    n = len(columns[0])
    new = np.ones(n, bool)
    for c in columns:
        new[1:] &= c[1:] == c[:-1]
    first = np.ones(n, bool)
    first[1:] = ~new[1:]
    return np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))


#: The sort key: all parts unsigned and big-endian, so bytes compare like the
#: tuple (anchor, descending score, kind, id); kind 0 is the anchor's label.
KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
_SIGN = np.uint64(1 << 63)


def _unsigned(x) -> np.ndarray:
    return np.asarray(x, np.int64).view(np.uint64) ^ _SIGN


def _pack(batches):
    for batch in batches:
        key = np.empty(len(batch), KEY)
        anchor, score, kind, ids = (batch.column(c).to_numpy() for c in ("anchor", "score", "kind", "id"))
        key["anchor"], key["score"], key["kind"], key["id"] = _unsigned(anchor), _unsigned(~score), kind, _unsigned(ids)
        raw = key.tobytes()
        offsets = np.arange(0, len(raw) + 1, KEY.itemsize, dtype=np.int32)
        keys = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        yield pa.RecordBatch.from_arrays([batch.column("anchor"), keys], names=["anchor", "key"])


def _unpack(column: pa.Array):
    key = np.frombuffer(b"".join(column.to_pylist()), KEY)
    plain = lambda x: (x.astype(np.uint64) ^ _SIGN).view(np.int64)
    return zip(plain(key["anchor"]).tolist(), (~plain(key["score"])).tolist(), key["kind"].tolist(), plain(key["id"]).tolist())


class _Window:
    __slots__ = ("positive", "score", "low", "high", "taken")

    def __init__(self, positive, score, ends):
        self.positive, self.score, (self.low, self.high), self.taken = positive, score, ends, 0


def _mine(batches, positives: int, negatives: int, low: int, high: int):
    """Keys arrive in order: windows open at an anchor's first positives, and
    every negative goes to each window that it falls into and that is not full."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    current, windows, opened = None, [], 0
    for batch in batches:
        out = []
        for anchor, score, kind, row in _unpack(batch.column("key")):
            if anchor != current:
                current, windows, opened = anchor, [], 0
            if kind == 0:
                if opened < positives:
                    opened += 1
                    windows.append(_Window(row, score, window(score, low, high)))
                continue
            closed = False
            for w in windows:
                if w.low <= score <= w.high:
                    w.taken += 1
                    out.append((anchor, w.positive, w.taken, row, w.score, score))
                closed = closed or w.taken == negatives or score < w.low
            if closed:
                windows = [w for w in windows if w.taken < negatives and score >= w.low]
        columns = zip(*out) if out else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def hard_negatives(rows: DataFrame, anchor: Column, ids: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of floor(scale * x). Anchors are the rows where
    ``anchor`` holds. For each of an anchor's ``positives`` best rows of its
    label: the ``negatives`` best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score."""
    if not 0 <= low <= high <= 100:
        raise ValueError("a window lies in 0 .. 100 per cent of the positive's score")
    label = F.col(label) if isinstance(label, str) else label
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    table = rows.select(F.col(ids).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).alias("vector"),
                        anchor.alias("anchor")).where(F.col("id").isNotNull() & F.col("label").isNotNull()
                                                      & F.col("vector").isNotNull() & finite)
    n, a = table.agg(F.count("*"), F.count_if("anchor")).first()
    blocks = max(1, -(-a // ANCHOR_BLOCK))
    stripes = max(1, min(-(-n // STRIPE_ROWS), -(-parallelism(rows.sparkSession) // blocks)))
    whole = lambda x: F.lit(x).cast("long")
    anchors = (table.where("anchor").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("own"))
               .select("id", "own.label", "own.vector", F.pmod(F.xxhash64("id"), whole(blocks)).alias("block")))
    # rows are dealt by their place in the table, so that repeated rows spread
    dealt = table.select("id", "label", "vector", F.pmod(F.xxhash64(F.monotonically_increasing_id()), whole(stripes)).alias("stripe"),
                         F.explode(F.sequence(whole(0), whole(blocks - 1))).alias("block"))

    def meet(anchors: DataFrame) -> DataFrame:
        windows = F.col("windows") if "windows" in anchors.columns else F.lit(None).cast("array<long>")
        first = anchors.select("id", "label", "vector", "block", F.explode(F.sequence(whole(0), whole(stripes - 1))).alias("stripe"),
                               windows.alias("windows"), whole(0).alias("kind"))
        both = first.unionByName(dealt.withColumns({"windows": F.lit(None).cast("array<long>"), "kind": whole(1)}))
        return both.repartition(blocks * stripes, "block", "stripe").sortWithinPartitions("block", "stripe", "kind")

    shape = "anchor long, id long, score long"
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    opened = materialize(meet(anchors).mapInArrow(lambda b: _positives(b, positives, scale), shape)
                         .withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives).drop("place"), "positives")
    windows = opened.groupBy(F.col("anchor").alias("id")).agg(F.sort_array(F.collect_list("score"), False).alias("windows"))
    fitting = meet(anchors.join(windows, "id")).mapInArrow(lambda b: _negatives(b, negatives, scale, low, high), shape)
    keys = (opened.withColumn("kind", F.lit(0)).unionByName(fitting.withColumn("kind", F.lit(1)))
            .mapInArrow(_pack, "anchor long, key binary"))
    return (keys.repartition("anchor").sortWithinPartitions("key")
            .mapInArrow(lambda b: _mine(b, positives, negatives, low, high),
                        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"))


def query(spark, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    own = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (own + 1) % 10).otherwise(own)
    return hard_negatives(rows, F.col("vec_id") % 50 == 0, label=label)


#: All anchors against all rows.
SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), w AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
  WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM w WHERE rank <= 3
"""

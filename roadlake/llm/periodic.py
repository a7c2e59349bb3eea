"""Periodic runs of words, caught online with dyadic blocks.

Words are appended one after another (in slices of any size; the result does
not depend on the slicing). For every level k the text is cut into blocks of
L = 2**k words. A square, that is a stretch of 2p words with period p, whose
period lies in 2L-1 .. 4L-2 holds a whole block of level k in its first half,
and the block's copy p words later. So each completed block sets a catcher,
and each appended word advances, at each level, the comparison of the last L
words with the two blocks that lie such a distance back. A hit is stretched to
both sides as long as words p apart are identical; a stretch that still
matches at the end of the text stays open and grows with the words appended
later. Stretches of two periods and more are squares that overlap, merged into
one run.

Comparisons use 64-bit hashes of the block's words (all words of a slice at
once); what they find is checked word by word, so hashes only save work. Work
grows with words times levels (logarithm of the longest period), and memory
with one text.

Hits inside a run whose period is at most L repeat that run with a multiple
of its period; they are skipped, so a text of one word repeated stays cheap.

Defined cases: null, empty and blank texts have no words and no runs; texts of
any length are read whole; every row is treated alone, so repeated rows repeat
their result; of runs that cover the same words the smallest period counts;
ties for the best run go to the smallest start, then period; other columns
pass through, clashing result columns are replaced; an empty table gives no
rows.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import WORD_BASE, U, _inverse, drop_clashing, mix, powers, read, schema_with, text_of, words_of

#: A run has at least this many words and this many periods.
MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Most words that are appended at a time.
SLICE_WORDS = 1 << 18
#: Rows of one Arrow batch whose results are held at a time.
HELD_ROWS = 1024


class SquareCatcher:
    """Runs of a sequence of word numbers that arrives in slices.

    ``length``: the number of words that will come, if known (then periods of
    runs that cannot reach ``exponent`` periods are not looked for)."""

    def __init__(self, length: int | None = None, exponent: int = MIN_EXPONENT, least: int = MIN_LENGTH):
        if exponent < 2:
            raise ValueError("a run has at least two periods")
        self.n, self.length, self.exponent, self.least = 0, length, exponent, least
        self.words = np.empty(length or 1024, np.int64)
        self.total = np.zeros(len(self.words) + 1, U)
        self.open: dict[tuple[int, int], None] = {}          # (start, period): matches up to the end
        self.runs: dict[tuple[int, int], int] = {}           # (start, end): smallest period

    # -- the text so far
    def _extend(self, words: np.ndarray) -> None:
        n = self.n + len(words)
        if n > len(self.words):
            size = max(n, 2 * len(self.words))
            self.words = np.concatenate([self.words[:self.n], np.empty(size - self.n, np.int64)])
            self.total = np.concatenate([self.total[:self.n + 1], np.zeros(size - self.n, U)])
        self.words[self.n:n] = words
        value = mix(words.astype(U) + U(1)) * powers(WORD_BASE, n)[self.n:]
        np.cumsum(value, dtype=U, out=self.total[self.n + 1:n + 1])
        self.total[self.n + 1:n + 1] += self.total[self.n]
        self.n = n

    def _common(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, side: int) -> np.ndarray:
        """Identical words from i and j (i < j) on (side 1), or before them
        (side -1), at most ``most``: never too few, too many by a collision."""
        shift, total = powers(WORD_BASE, self.n + 1)[j - i], self.total
        low, high = np.zeros(len(i), np.int64), most.astype(np.int64)
        while (low < high).any():
            mid = (low + high + 1) >> 1
            if side > 0:
                same = (total[i + mid] - total[i]) * shift == total[j + mid] - total[j]
            else:
                same = (total[i] - total[i - mid]) * shift == total[j] - total[j - mid]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    # -- what the catchers of one level see in the words from ``old`` on
    def _hits(self, size: int, old: int) -> tuple[np.ndarray, np.ndarray]:
        """(block's start, period) of the hits whose copy ends after ``old``."""
        first = max(old - size + 1, 2 * size - 1)
        at = np.arange(first, self.n - size + 1)
        total, back = self.total, powers(_inverse(WORD_BASE), self.n)
        suffix = (total[first + size:self.n + 1] - total[first:self.n - size + 1]) * back[first:self.n - size + 1]
        near = (at - (2 * size - 1)) // size
        from_block = max(0, int(near[0]) - 1)
        starts = np.arange(from_block, int(near[-1]) + 1) * size
        blocks = (total[starts + size] - total[starts]) * back[starts]
        found = []
        for block in (near, near - 1):
            k = np.flatnonzero((blocks[np.maximum(block, 0) - from_block] == suffix) & (block >= 0))
            found.append((block[k] * size, at[k] - block[k] * size))
        start, period = (np.concatenate(x) for x in zip(*found))
        if self.length is not None:
            fits = period * self.exponent <= self.length
            start, period = start[fits], period[fits]
        return start, period

    def _new(self, start, period, size):
        """Hits that no run of a period up to ``size`` explains, the first of
        every chain of neighbouring blocks with one period."""
        known = [(a, b) for (a, b), q in self.runs.items() if q <= size]
        known += [(a, self.n) for a, q in self.open if q <= size and self.n - a >= 2 * q]
        if known:
            known.sort()
            a, b = np.array(known).T
            reach = np.concatenate([[0], np.maximum.accumulate(b)])
            out = reach[np.searchsorted(a, start, "right")] < start + period + size
            start, period = start[out], period[out]
        order = np.lexsort((start, period))
        start, period = start[order], period[order]
        chained = np.zeros(len(start), bool)
        chained[1:] = (period[1:] == period[:-1]) & (start[1:] == start[:-1] + size)
        return start[~chained], period[~chained]

    def _keep(self, start: int, end: int, period: int) -> None:
        """Words ``period`` apart are identical in start .. end, by their
        hashes: check them, and keep each stretch of two periods."""
        w = self.words
        differs = np.flatnonzero(w[start:end - period] != w[start + period:end])
        edges = [-1, *differs.tolist(), end - period - start]
        for x, y in zip(edges[:-1], edges[1:]):
            a, b = start + x + 1, start + y + period
            if b == self.n and y == end - period - start:
                self.open.setdefault((a, period))
            elif b - a >= 2 * period:
                self.runs[a, b] = min(period, self.runs.get((a, b), period))

    def append(self, words) -> None:
        words = np.asarray(words, np.int64)
        if not len(words):
            return
        old = self.n
        self._extend(words)
        waiting, self.open = self.open, {}
        for start, period in waiting:                     # open stretches grow
            differs = np.flatnonzero(self.words[old:self.n] != self.words[old - period:self.n - period])
            if not len(differs):
                self.open[start, period] = None
            elif (end := old + int(differs[0])) - start >= 2 * period:
                self.runs[start, end] = min(period, self.runs.get((start, end), period))
        size, longest = 1, self.n if self.length is None else self.length // self.exponent
        while 3 * size - 1 <= self.n and 2 * size - 1 <= longest:
            start, period = self._hits(size, old)
            if len(start):
                start, period = self._new(start, period, size)
                start = start - self._common(start, start + period, start, -1)
                start, period = np.unique(np.stack([start, period]), axis=1)
                end = start + period + self._common(start, start + period, self.n - start - period, 1)
                due = (end == self.n) | (end - start >= 2 * period)
                for s, e, p in zip(start[due].tolist(), end[due].tolist(), period[due].tolist()):
                    if not any(a == s and e == self.n and p % q == 0 for a, q in self.open) \
                            and not any(p % q == 0 for q in [self.runs.get((s, e), p + 1)]):
                        self._keep(s, e, p)
            size *= 2

    def found(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs in the words so far, by start,
        then period."""
        runs = dict(self.runs)
        for start, period in self.open:
            if self.n - start >= 2 * period:
                runs[start, self.n] = min(period, runs.get((start, self.n), period))
        return sorted((a, b - a, q) for (a, b), q in runs.items()
                      if b - a >= max(self.least, self.exponent * q))


def best_run(runs):
    """The run with the most periods (exactly), the first of equal ones."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list, runs) -> list:
    """``words`` without those of a run after its first period."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    stay = np.cumsum(cover)[:-1] == 0
    return [w for w, s in zip(words, stay.tolist()) if s]


def word_runs(words: list) -> list[tuple[int, int, int]]:
    """Runs of a list of words."""
    numbers: dict = {}
    ids = np.fromiter(map(numbers.setdefault, words, count()), np.int64, len(words))
    catcher = SquareCatcher(len(ids))
    for a in range(0, len(ids), SLICE_WORDS):
        catcher.append(ids[a:a + SLICE_WORDS])
    return catcher.found()


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _runs(batches, text: str):
    for batch in batches:
        for i in range(0, len(batch), HELD_ROWS):
            part = batch.slice(i, HELD_ROWS)
            runs, best, kept = [], [], []
            for t in part.column(text):
                words = t.as_py().encode().split()
                own = word_runs(words)
                top = best_run(own)
                runs.append([dict(zip(("start", "length", "period"), r)) for r in own])
                best.append(None if top is None else dict(zip(("start", "length", "period"), top)))
                kept.append(b" ".join(collapsed(words, own)).decode())
            columns = [c for n, c in zip(part.schema.names, part.columns) if n != text]
            names = [n for n in part.schema.names if n != text]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(runs, pa.list_(RUN)), pa.array(best, RUN), pa.array(kept, pa.string())],
                names=[*names, "runs", "best_run", "collapsed"])


RESULT = ("runs", "best_run", "collapsed")


def periodic_runs(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """``docs`` without their text, and ``runs`` (array of start, length,
    period: word numbers from 0, by start, then period), ``best_run`` (the one
    with the most periods; null without a run) and ``collapsed`` (the text
    with each run cut to its first period; words joined by one space)."""
    own = drop_clashing(docs, RESULT)
    column = "__text__"
    rows = own.select(*[c for c in own.columns if c.lower() != "text"],
                      (text_of() if text is None else text_of(text)).alias(column))
    shape = "struct<start:long,length:long,period:long>"
    out = schema_with(rows.drop(column), f"runs array<{shape}>, best_run {shape}, collapsed string")
    return rows.mapInArrow(lambda batches: _runs(batches, column), out)


def planted(text: Column, doc_id: Column) -> Column:
    """Texts of a tenth of the ids (by the checksum h of the decimal id) with
    their words from number a on repeated with period p: g = floor(h / 10),
    a = g mod n, p = 1 + floor((n - a) / (3 + g mod 8))."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    words = words_of(text_of(text))

    def repeated(w):
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                                        lambda i: F.get(w, place(i).cast("int"))), " ")

    # the words are found once: an array of one element is transformed
    changed = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit(""))), F.lit(0))
    return F.when(F.pmod(h, F.lit(10)) == 0, changed).otherwise(text_of(text))


def query(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = periodic_runs(docs.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text")))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    best = F.col("best_run")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * best_run.length div best_run.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def oracle() -> str:
    """Stretches of identical words q apart, for every q that matches at three
    multiples of itself at least (as each run of four periods does)."""
    import zlib
    step = [zlib.crc32(bytes([255 ^ i])) ^ 0xFF000000 for i in range(256)]
    return rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), lambda x: ('0x' || x)::BIGINT)),
             lambda a, x: xor(a >> 8, CAST({step} AS BIGINT[])[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) AS h
  FROM documents
), g AS (
  SELECT doc_id, w, len(w)::BIGINT AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g FROM d
), a AS (
  SELECT *, CASE WHEN planted THEN g % n ELSE 0 END AS a FROM g
), p AS (
  SELECT *, CASE WHEN planted THEN 1 + (n - a) // (3 + g % 8) ELSE 1 END AS p FROM a
), o AS (
  SELECT doc_id, unnest(range(0, n)) AS i, unnest(w) AS x FROM p
), u AS (
  SELECT k.doc_id, k.i, o.x
  FROM (SELECT o.doc_id, o.i, CASE WHEN planted AND o.i >= a THEN a + (o.i - a) % p ELSE o.i END AS origin
        FROM o JOIN p ON o.doc_id = p.doc_id) k
  JOIN o ON o.doc_id = k.doc_id AND o.i = k.origin
), c AS (
  SELECT doc_id, q, unnest(range(0, n - q, q)) AS i FROM (SELECT doc_id, n, unnest(range(1, n // 4 + 1)) AS q FROM p)
), q AS (
  SELECT c.doc_id, c.q FROM c JOIN u x ON x.doc_id = c.doc_id AND x.i = c.i JOIN u y ON y.doc_id = c.doc_id AND y.i = c.i + c.q AND y.x = x.x
  GROUP BY c.doc_id, c.q HAVING count(*) >= 3
), m AS (
  SELECT q.doc_id, q.q, x.i, x.i - row_number() OVER (PARTITION BY q.doc_id, q.q ORDER BY x.i) AS stretch
  FROM q JOIN u x ON x.doc_id = q.doc_id JOIN u y ON y.doc_id = q.doc_id AND y.i = x.i + q.q AND y.x = x.x
), s AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM m GROUP BY doc_id, q, stretch
), r AS (
  SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= 6 AND length >= 4 * q GROUP BY doc_id, start, length
), b AS (
  SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1
), l AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM r GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r
), kept AS (
  SELECT u.doc_id, string_agg(u.x, ' ' ORDER BY u.i) AS t FROM u ANTI JOIN gone ON u.doc_id = gone.doc_id AND u.i = gone.i GROUP BY u.doc_id
)
SELECT d.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length, b.period::BIGINT AS period,
       (1000 * b.length // b.period)::BIGINT AS exponent_milli, sha256(coalesce(l.lines, '')) AS runs_sha256,
       sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN l USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

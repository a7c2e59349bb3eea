"""Benchmark decontamination: n-gram seeds and local alignment.

Words are runs of letters, digits and non-ASCII characters, compared
without case by the rules of Unicode. Every four consecutive words of a test item are a seed, common or rare: an edit
breaks seeds, and a group of copies makes seeds common, so none is left out.
Where a document shares a seed, the words around it are aligned with the item
(Smith-Waterman over words: match 2, mismatch -1, gap -1); the score is
divided by that of the unchanged item, and 0.5 or more marks a copy, edited or
not. Windows that hold too few of the item's words to reach that are not
aligned.

Test items are taken in blocks of bounded size, each sent to the tasks; all
documents are read against every block. Nothing else is broadcast, and no
document leaves its row.

Defined cases: null or empty texts leak nothing; items with fewer than four
words are one seed of all their words and must be found whole; items without words are skipped;
repeated items and rows each get their answer; an empty benchmark marks
nothing; other columns pass through.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import PLAIN, U, drop_clashing, hashed_words, ngram_hashes, read, text_of

GRAM = 4
THRESHOLD = 0.5
#: Words of test items in one block (8 bytes a word, about 40 bytes a seed).
BLOCK_WORDS = 250_000
FILTER_BITS = 20
#: Seed hits, each with one item, that are held at a time (one document's at least).
HITS = 1 << 21
MATCH, MISMATCH, GAP = 2, -1, -1
LEAKS = "array<struct<item_id:bigint,score:double>>"


@dataclass
class Block:
    """Test items: ids, word hashes (CSR), and seeds sorted by hash with the
    item and offset of each."""
    ids: list
    words: np.ndarray
    starts: np.ndarray
    seeds: np.ndarray
    item: np.ndarray
    offset: np.ndarray


def make_block(ids: list, texts: list) -> Block | None:
    words, kept = [], []
    for a, b, h, rows in hashed_words(pa.array(texts, pa.string()), PLAIN):
        for i in range(a, b):
            w = h[rows[i - a]:rows[i - a + 1]]
            if len(w):
                kept.append(ids[i])
                words.append(w)
    if not kept:
        return None
    seeds = [ngram_hashes(w, min(GRAM, len(w))) for w in words]
    s = np.concatenate(seeds)
    item = np.repeat(np.arange(len(kept)), [len(x) for x in seeds])
    offset = np.concatenate([np.arange(len(x)) for x in seeds])
    order = np.argsort(s, kind="stable")
    starts = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    return Block(kept, np.concatenate(words), starts, s[order], item[order], offset[order])


def blocks(benchmark: DataFrame):
    """Blocks of test items, read one after the other."""
    ids, texts, size = [], [], 0
    for r in benchmark.select(F.col("item_id").cast("long"), folded(text_of())).toLocalIterator():
        ids.append(r[0])
        texts.append(r[1])
        size += r[1].count(" ") + 1
        if size >= BLOCK_WORDS:
            yield make_block(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield make_block(ids, texts)


def folded(text: Column) -> Column:
    """``text`` without differences of case. Both conversions are needed, as
    for STRASSE and a final sigma; Spark would reduce upper(lower(x)) to one."""
    return F.upper(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")))


def alignment(item: np.ndarray, window: np.ndarray) -> int:
    """Best Smith-Waterman score of two word sequences."""
    n = len(window)
    if n == 0:
        return 0
    slope = -GAP * np.arange(n)
    above = np.zeros(n + 1, np.int64)
    best = 0
    for w in item:
        cell = np.maximum(above[:-1] + np.where(window == w, MATCH, MISMATCH), above[1:] + GAP)
        cell = np.maximum(cell, 0)
        # gaps along the window: running maximum of what each cell leaves behind
        cell = np.maximum(cell, np.maximum.accumulate(cell + slope) - slope)
        above[1:] = cell
        best = max(best, int(cell.max()))
    return best


class Finder:
    """Seed hits and alignments of documents against one block."""

    def __init__(self, block: Block):
        self.b = block
        self.distinct, self.first = np.unique(block.seeds, return_index=True)
        self.last = np.append(self.first[1:], len(block.seeds))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.distinct & U((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
        # lengths below GRAM that some item has as a whole
        sizes = np.diff(block.starts)
        self.lengths = sorted({GRAM, *sizes[sizes < GRAM].tolist()})
        self.known: OrderedDict = OrderedDict()

    def hits(self, h: np.ndarray, rows: np.ndarray):
        """(row, word position, seed number) of every seed in a slice."""
        out = []
        for n in self.lengths:
            g = ngram_hashes(h, n)
            p = np.flatnonzero(self.filter[(g & U((1 << FILTER_BITS) - 1)).astype(np.int64)])
            k = np.searchsorted(self.distinct, g[p])
            ok = k < len(self.distinct)
            ok[ok] = self.distinct[k[ok]] == g[p[ok]]
            p, k = p[ok], k[ok]
            row = np.searchsorted(rows, p, "right") - 1
            inside = p + n <= rows[row + 1]
            out.append((row[inside], p[inside], k[inside]))
        return [np.concatenate(x) for x in zip(*out)]

    @staticmethod
    def least(n: int) -> float:
        """Lowest score of a copy of an item of n words."""
        return MATCH * n * (THRESHOLD if n >= GRAM else 1.0)

    def score(self, i: int, window: np.ndarray) -> float:
        key = (i, window.tobytes())
        if key not in self.known:
            item = self.b.words[self.b.starts[i]:self.b.starts[i + 1]]
            # no alignment scores more than MATCH for each of the item's words that occur
            most = MATCH * np.isin(item, window).sum()
            self.known[key] = alignment(item, window) / (MATCH * len(item)) if most >= self.least(len(item)) else 0.0
            if len(self.known) > 20_000:
                self.known.popitem(last=False)
        return self.known[key]

    def leaks(self, h: np.ndarray, rows: np.ndarray) -> list[list[dict]]:
        row, p, k = self.hits(h, rows)
        out: list[list[dict]] = [[] for _ in range(len(rows) - 1)]
        order = np.argsort(row, kind="stable")
        row, p, k = row[order], p[order], k[order]
        many = self.last[k] - self.first[k]
        total = np.cumsum(many)
        a = 0
        while a < len(row):
            b = max(a + 1, int(np.searchsorted(total, total[a] - many[a] + HITS, "right")))
            b = int(np.searchsorted(row, row[b - 1], "right"))
            self.align(h, rows, row[a:b], p[a:b], k[a:b], out)
            a = b
        return out

    def align(self, h, rows, row, p, k, out) -> None:
        """Leaks of the documents that the hits are in, added to ``out``."""
        many = self.last[k] - self.first[k]
        at = np.repeat(self.first[k], many) + (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
        row, p = np.repeat(row, many), np.repeat(p, many)
        item = self.b.item[at]
        diagonal = p - self.b.offset[at]
        size = np.diff(self.b.starts)[item]
        order = np.lexsort((diagonal, item, row))
        row, item, diagonal, size = row[order], item[order], diagonal[order], size[order]
        # neighbouring diagonals of the same row and item share a window
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > size[1:])
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(row)) - 1
        best: dict[tuple[int, int], float] = {}
        for x, y in zip(a, b):
            r, i, n = int(row[x]), int(item[x]), int(size[x])
            room = max(GRAM, n // 2)
            lo = max(int(rows[r]), int(diagonal[x]) - room)
            hi = min(int(rows[r + 1]), int(diagonal[y]) + n + room)
            s = self.score(i, h[lo:hi])
            if s >= (THRESHOLD if n >= GRAM else 1.0):
                best[r, i] = max(s, best.get((r, i), 0.0))
        for (r, i), s in sorted(best.items()):
            out[r].append({"item_id": self.b.ids[i], "score": s})


def leaks_of(benchmark: DataFrame) -> Column:
    """Column of a document's test items with their scores."""
    out = F.expr(f"cast(array() as {LEAKS})")
    for block in blocks(benchmark):
        if block is None:
            continue
        out = F.concat(out, finder_udf(block)(folded(text_of())))
    return out


def finder_udf(block: Block):
    held: list[Finder] = []

    @F.arrow_udf(LEAKS)
    def find(text: pa.Array) -> pa.Array:
        if not held:
            held.append(Finder(block))
        out = []
        for _, _, h, rows in hashed_words(text, PLAIN):
            out += held[0].leaks(h, rows)
        return pa.array(out, pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64())])))

    return find


def with_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with ``leaks``: array of (item_id, score)."""
    return drop_clashing(docs, ["leaks"]).withColumn("leaks", leaks_of(benchmark))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no test item."""
    return docs.where(F.size(leaks_of(benchmark)) == 0)


def query(spark, sf_dir: str) -> DataFrame:
    found = with_leaks(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    ranked = F.array_sort(F.transform("leaks", lambda x: F.struct((-x["score"]).alias("s"), x["item_id"].alias("i"))))
    return found.select("doc_id", (F.size("leaks") > 0).alias("contaminated"),
                        F.array_sort(F.transform("leaks", lambda x: x["item_id"])).alias("item_ids"),
                        F.get(ranked, F.lit(0))["i"].alias("best_item_id"),
                        (-F.get(ranked, F.lit(0))["s"]).alias("best_score"))

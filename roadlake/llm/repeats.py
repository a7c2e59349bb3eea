"""Repeated passages by phrase automata.

A window is 35 consecutive words; a word is removed if it lies in a window
whose words also start anywhere else in the corpus.

1. Rows equal in id and text become one row with their number: they share all
   results. Rows are dealt to shards of bounded bytes by a hash of both.
2. Of every window the eight-word phrase with the smallest hash is its anchor
   (equal windows have equal anchors). Phrases that are anchors at two or more
   places recur; they travel to the shards that hold them as words.
3. Each shard compiles its recurring phrases into an Aho-Corasick automaton and
   streams its documents through it: windows whose anchor the automaton locates
   are candidates. They are counted over all shards by 96 bits of hashes.
4. Candidates that occur once in the corpus go back to their shard (they are
   few); there all other windows that the automaton locates are repeats, and
   their words go.

The automaton alone decides which windows are looked at: no shard knows the
hashes of recurring phrases. Counts are summed before they are shuffled, so a
passage of any frequency costs each shard a row. The texts are shuffled once:
all passes over the shards read the same exchange.

Defined cases: null, empty and short texts have no windows and lose nothing;
kept words are joined by one space; equal rows are repeats of each other and
each gets its row; other columns are not returned.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import U, mix, ngram_hashes, read, signed, slices, text_of, utf8, word_hashes, word_spans

WINDOW = 35
PHRASE = 8
SPAN = WINDOW - PHRASE + 1
SHARD_BYTES = 1 << 20
POSITION_BITS = 28
#: Bytes of different rows among which a task merges equal ones.
HELD_BYTES = 1 << 23
#: Changes the word hashes for the last third of a window's 96 bits (arbitrary).
SECOND = U(0xA24BAED4963EE407)
#: Equal rows are put back in two steps of at most this many.
STEP = 1 << 16


def rolling_least(x: np.ndarray) -> np.ndarray:
    """Minimum of every SPAN consecutive values."""
    size = 1
    while size * 2 <= SPAN:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (SPAN - size)], x[SPAN - size:]) if SPAN > size else x


def windows(h: np.ndarray, rows: np.ndarray):
    """Of the word hashes of a slice: starts of the windows inside one row,
    the position of each one's anchor, and the hashes of all phrases."""
    phrase = ngram_hashes(h, PHRASE)
    if len(h) < WINDOW:
        none = np.empty(0, np.int64)
        return none, none, phrase
    low = U((1 << POSITION_BITS) - 1)
    packed = (phrase & ~low) | np.arange(len(phrase), dtype=U)
    at = (rolling_least(packed) & low).astype(np.int64)
    inside = np.zeros(len(h) + 1, np.int64)
    a, b = rows[:-1], rows[1:]
    long = b - a >= WINDOW
    np.add.at(inside, a[long], 1)
    np.add.at(inside, b[long] - WINDOW + 1, -1)
    start = np.flatnonzero(np.cumsum(inside)[:len(at)] > 0)
    return start, at[start], phrase


def _merged(batches):
    """Rows with ``n``, the equal ones among HELD_BYTES of different rows as one."""
    held, size = {}, 0

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in held], pa.int64()), pa.array([k[1] for k in held], pa.binary()).cast(pa.string()),
             pa.array(held.values(), pa.int64())], names=["doc_id", "text", "n"])

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for i, k in enumerate(batch.column("doc_id").to_pylist()):
            key = k, texts[i].as_py()
            n = held.get(key, 0)
            held[key] = n + 1
            if n == 0:
                size += len(key[1]) + 64
                if size >= HELD_BYTES:
                    yield flush()
                    held, size = {}, 0
    if held:
        yield flush()


def anchors(batch: pa.RecordBatch):
    """Of every slice of rows, its distinct (phrase hash, shard): hashes,
    shards, occurrences, and the phrases' bytes as (bytes, starts, ends)."""
    shard, n = batch.column("shard").to_numpy(), batch.column("n").to_numpy()
    data, offsets = utf8(batch.column("text"))
    for a, b in slices(offsets):
        part = data[offsets[a]:offsets[b]]
        starts, ends, rows = word_spans(part, offsets[a:b + 1] - offsets[a])
        _, at, phrase = windows(word_hashes(part, starts, ends), rows)
        if not len(at):
            continue
        at = at[np.append(True, at[1:] != at[:-1])]
        row = a + np.searchsorted(rows, at, "right") - 1
        h, of = signed(phrase[at]), shard[row]
        order = np.lexsort((of, h))
        h, of, at = h[order], of[order], at[order]
        first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (of[1:] != of[:-1])))
        yield (h[first], of[first], np.add.reduceat(n[row][order], first),
               (part, starts[at[first]], ends[at[first] + PHRASE - 1]))


def _counts(batches):
    for batch in batches:
        for h, _, n, _ in anchors(batch):
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["h", "n"])


def _phrases(batches):
    for batch in batches:
        for h, shard, _, (data, a, b) in anchors(batch):
            ends = np.cumsum(b - a)
            body = data[np.repeat(a - (ends - (b - a)), b - a) + np.arange(ends[-1])]
            offsets = np.append(0, ends).astype(np.int32)
            words = pa.Array.from_buffers(pa.binary(), len(h), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(shard), words], names=["h", "shard", "phrase"])


def shard_words(text: pa.Array):
    """Word hashes and row borders of a whole shard."""
    data, offsets = utf8(text)
    parts, borders, n = [], [np.zeros(1, np.int64)], 0
    for a, b in slices(offsets):
        part = data[offsets[a]:offsets[b]]
        starts, ends, rows = word_spans(part, offsets[a:b + 1] - offsets[a])
        parts.append(word_hashes(part, starts, ends))
        borders.append(rows[1:] + n)
        n += len(starts)
    return (np.concatenate(parts) if parts else np.empty(0, U)), np.concatenate(borders)


def located(text: pa.Array, rows: np.ndarray, phrases: list[bytes]) -> np.ndarray:
    """The words of a shard at which one of ``phrases`` begins, by streaming
    its texts through the phrases' automaton."""
    found = np.zeros(int(rows[-1]), bool)
    number: dict[bytes, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for phrase in phrases:
        # numbers from 1; 0 is every word that no phrase has
        automaton.add_word(tuple([number.setdefault(w, len(number) + 1) for w in phrase.split()]), 1)
    if not len(automaton):
        return found
    automaton.make_automaton()
    data, offsets = utf8(text)
    for i in np.flatnonzero(np.diff(rows) >= WINDOW).tolist():
        words = data[offsets[i]:offsets[i + 1]].tobytes().split()
        ends = [end for end, _ in automaton.iter(tuple([number.get(w, 0) for w in words]))]
        found[np.array(ends, np.int64) + (rows[i] - PHRASE + 1)] = True
    return found


def candidates(docs: pa.Table, phrases: list[bytes]):
    """Of a shard: its row borders, the starts of the windows whose anchor is
    located, and the two hashes of each."""
    h, rows = shard_words(docs.column("text"))
    start, at, _ = windows(h, rows)
    start = start[located(docs.column("text"), rows, phrases)[at]] if len(start) else start
    if not len(start):
        none = np.empty(0, np.int64)
        return rows, start, none, none.astype(np.int32)
    return rows, start, signed(ngram_hashes(h, WINDOW)[start]), ngram_hashes(mix(h ^ SECOND), WINDOW)[start].astype(np.uint32).view(np.int32)


def _candidates(docs: pa.Table, phrases: pa.Table) -> pa.Table:
    shard = docs.column("shard")[0].as_py() if len(docs) else 0
    rows, start, h, g = candidates(docs, phrases.column("phrase").to_pylist())
    order = np.lexsort((g, h))
    h, g = h[order], g[order]
    first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1]))) if len(h) else order
    n = docs.column("n").to_numpy()[np.searchsorted(rows, start, "right") - 1][order] if len(h) else h
    return pa.table({"h": h[first], "g": g[first], "shard": np.full(len(first), shard, np.int64),
                     "n": np.add.reduceat(n, first) if len(first) else n})


def _removed(docs: pa.Table, known: pa.Table) -> pa.Table:
    once = known.column("phrase").is_null().to_numpy()
    rows, start, h, g = candidates(docs, known.column("phrase").drop_null().to_pylist())
    if len(start) and once.any():
        alone_h, alone_g = known.column("h").to_numpy()[once], known.column("g").to_numpy()[once]
        order = np.argsort(alone_h)
        alone_h, alone_g = alone_h[order], alone_g[order]
        k = np.minimum(np.searchsorted(alone_h, h), len(alone_h) - 1)
        start = start[(alone_h[k] != h) | (alone_g[k] != g)]
    total = int(rows[-1])
    cover = np.zeros(total + 1, np.int64)
    cover[start] += 1
    np.add.at(cover, start + WINDOW, -1)
    stays = np.cumsum(cover)[:total] == 0
    data, offsets = utf8(docs.column("text"))
    words, removed, kept = [], [], []
    for i in range(len(docs)):
        own = data[offsets[i]:offsets[i + 1]].tobytes().split()
        stay = stays[rows[i]:rows[i + 1]]
        left = own if stay.all() else [w for w, s in zip(own, stay.tolist(), strict=True) if s]
        words.append(len(own))
        removed.append(len(own) - len(left))
        kept.append(b" ".join(left).decode())
    return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(words, pa.int64()),
                     "n_removed": pa.array(removed, pa.int64()), "text": pa.array(kept, pa.string()), "n": docs.column("n")})


def without_repeats(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed and text (the kept words) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    if shards is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = size // SHARD_BYTES + 1
    rows = (rows.mapInArrow(_merged, "doc_id long, text string, n long")
            .withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards).cast("long")))
            .repartition("shard").groupBy("shard", "doc_id", "text").agg(F.sum("n").alias("n")))
    recurring = rows.mapInArrow(_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    phrases = rows.mapInArrow(_phrases, "h long, shard long, phrase binary").join(recurring, "h", "left_semi").select("shard", "phrase")
    counted = (rows.groupBy("shard").cogroup(phrases.groupBy("shard"))
               .applyInArrow(_candidates, "h long, g int, shard long, n long"))
    once = counted.groupBy("h", "g").agg(F.sum("n").alias("n"), F.min("shard").alias("shard")).where("n = 1")
    known = phrases.select("shard", "phrase", F.lit(None).cast("long").alias("h"), F.lit(None).cast("int").alias("g")).unionAll(
        once.select("shard", F.lit(None).cast("binary").alias("phrase"), "h", "g"))
    found = (rows.groupBy("shard").cogroup(known.groupBy("shard"))
             .applyInArrow(_removed, "doc_id long, n_words long, n_removed long, text string, n long"))
    # as many rows again as were equal
    steps = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / STEP).cast("long")))
    again = F.explode(F.sequence(F.lit(1), F.least(F.lit(STEP), F.col("n") - F.col("step") * STEP).cast("int")))
    return found.withColumn("step", steps).withColumn("again", again).select("doc_id", "n_words", "n_removed", "text")


def query(spark, sf_dir: str) -> DataFrame:
    out = without_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


#: Every window as a string; a word goes if one of the 35 windows over it recurs.
SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM w WHERE len(w) >= 35
), k AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i+34], ' ')) AS k FROM s
), r AS (
  SELECT doc_id, i FROM k WHERE k IN (SELECT k FROM k GROUP BY k HAVING count(*) > 1)
), c AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM r
), x AS (
  SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id
), m AS (
  SELECT w.doc_id, w.w, coalesce(x.gone, []::BIGINT[]) AS gone FROM w LEFT JOIN x USING (doc_id)
), u AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM m
), left_over AS (
  SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.i) AS kept
  FROM u ANTI JOIN c ON u.doc_id = c.doc_id AND u.i = c.i GROUP BY u.doc_id
)
SELECT m.doc_id, len(m.w)::BIGINT AS n_words, len(m.gone)::BIGINT AS n_removed, sha256(coalesce(l.kept, '')) AS kept_sha256
FROM m LEFT JOIN left_over l USING (doc_id)
"""

"""Repeated passages: the automaton decides, equal rows spread, results equal brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from roadlake.llm import repeats

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n=repeats.WINDOW):
    ws = [WORDS.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i:i + n]) for w in ws for i in range(len(w) - n + 1))
    out = []
    for (k, _), w in zip(rows, ws):
        gone = {j for i in range(len(w) - n + 1) if count[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
        out.append((k, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def corpus(seed, docs=40):
    rng = random.Random(seed)

    def prose(n, vocabulary=400):
        return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]

    passages = [prose(n) for n in (34, 35, 36, 60, 200)]
    rows = []
    for i in range(docs):
        w = prose(rng.randrange(120))
        for _ in range(rng.randrange(4)):
            at, p = rng.randrange(len(w) + 1), rng.choice(passages)
            # a passage may be cut, so that phrases recur where no window does
            w[at:at] = p[rng.randrange(10):] if rng.random() < .4 else p
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
    return rows + [(None, None), (100, ""), (101, " ".join(["x"] * 90)), (102, " ".join(["a", "b"] * 30))]


@pytest.mark.parametrize("seed,shards", [(1, 1), (2, 4), (3, 9)])
def test_results_equal_brute_force(spark, seed, shards):
    rows = corpus(seed)
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), shards).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_only_the_automaton_locates(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    docs = pa.table({"doc_id": [1, 2], "text": [f"a b {passage} c", f"{passage} d e"], "n": [1, 1], "shard": [0, 0]})
    h, rows = repeats.shard_words(docs.column("text"))
    _, at, _ = repeats.windows(h, rows)
    every = sorted({b" ".join(w.split()[p - o:p - o + repeats.PHRASE]) for p in at.tolist()
                    for o, w in [(0, docs.column("text")[0].as_py().encode())] if p < rows[1]
                    and p - o + repeats.PHRASE <= rows[1]})
    assert len(repeats.candidates(docs, [])[1]) == 0
    assert len(repeats.candidates(docs, [b"no such words are in any of the texts"])[1]) == 0
    some = repeats.candidates(docs, every)[1]
    assert len(some) >= 2 * (50 - repeats.WINDOW + 1)


def test_phrases_match_whole_words_inside_one_text():
    text = pa.array(["a b c d e f g hh " + "z " * 40, "b c d e f g h " + "y " * 40, "a b c d e f g h " + "x " * 40])
    _, rows = repeats.shard_words(text)
    found = repeats.located(text, rows, [b"a b  c d e f\ng h"])
    assert np.flatnonzero(found).tolist() == [int(rows[2])]


def test_equal_rows_are_held_once(spark, monkeypatch):
    """A row that is repeated 100,000 times reaches its shard as one row."""
    passage = " ".join(f"q{i}" for i in range(60))
    lone = " ".join(f"l{i}" for i in range(60))
    df = spark.range(100_000).selectExpr("cast(7 as long) doc_id", f"'{passage}' text").unionAll(
        spark.createDataFrame([(8, lone), (9, "tail " + lone[:20])], "doc_id long, text string"))
    got = repeats.without_repeats(df, 3).groupBy("doc_id", "n_words", "n_removed", "text").count().collect()
    assert sorted(map(tuple, got)) == [(7, 60, 60, "", 100_000), (8, 60, 0, lone, 1),
                                       (9, len(("tail " + lone[:20]).split()), 0, "tail " + lone[:20], 1)]
    batch = pa.record_batch({"doc_id": [7] * 1000, "text": [passage] * 1000})
    assert [b.column("n").to_pylist() for b in repeats._merged([batch] * 5)] == [[5000]]
    monkeypatch.setattr(repeats, "HELD_BYTES", 10)
    assert sum(b.num_rows for b in repeats._merged([batch])) == 1000


def test_equal_rows_come_back_beyond_one_step(spark, monkeypatch):
    monkeypatch.setattr(repeats, "STEP", 4)
    df = spark.range(13).selectExpr("id % 2 doc_id", "'some words' text")
    assert sorted(r.doc_id for r in repeats.without_repeats(df, 2).collect()) == [0] * 7 + [1] * 6

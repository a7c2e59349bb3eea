"""The n-gram Jaccard join against brute force."""

import random
import re

import numpy as np
import pytest

from roadlake.llm import jaccard_join

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SHAPE = "doc_id long, text string, node string, n_links string, th string, label string"


def grams(t):
    w = WORDS.findall((t or "").translate(LOWER))
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def brute(rows, limit=85):
    sets = [grams(t) for _, t in rows]
    linked = [[j for j, y in enumerate(sets) if i != j and x and 100 * len(x & y) >= limit * len(x | y)] for i, x in enumerate(sets)]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in linked[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc_id, len(linked[i])))
    return sorted(out, key=repr)


def corpus(seed, n=40):
    """Texts with edited copies at similarities around the limit, and a passage that all share."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(n):
        base = [word() for _ in range(rng.randrange(3, 160))] + passage * rng.randrange(2)
        texts.append(base)
        for _ in range(rng.randrange(5)):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 30)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(copy[:rng.choice([len(copy), len(copy) - 2])])
    texts = [" ".join(t) for t in texts]
    return texts + texts[:6] + [t.upper() for t in texts[3:6]]


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "own", "own", "own", "own") for r in rows], SHAPE).repartition(3)
    return sorted((tuple(r) for r in jaccard_join.ngram_join(df, **options).collect()), key=repr)


def test_equals_brute_force_with_odd_rows(spark):
    texts = [None, "", " \n\t ", "one", "One", "two words", "two words\n", "a b c d", "é ß 😀 \x00 end", "x " * 3000] + corpus(1)
    rows = list(enumerate(texts)) + [(None, texts[12]), (None, None), (None, "only this one here"), (3, "one"), (40, texts[14]), (40, texts[14])]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("limit", [60, 100])
def test_equals_brute_force_over_many_fragments_and_blocks(spark, monkeypatch, limit):
    for name, value in (("FRAGMENT", 1 << 9), ("DEAL", 1 << 10), ("BLOCK", 3), ("COLUMNS", 16), ("FREQUENT", 3)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = list(enumerate(corpus(2)))
    assert run(spark, rows, limit=limit) == brute(rows, limit)


def test_a_large_group_of_near_copies_just_around_the_limit(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 64)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(300):
        copy = list(base)
        for j in rng.sample(range(200), rng.choice([1, 3, 4, 5])):
            copy[j] = f"e{i}x{j}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    found = run(spark, rows)
    assert found == brute(rows) and len({r[2] for r in found}) > 1


def test_passages_of_many_documents_make_no_group(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(30)) + " " + passage) for i in range(400)]
    assert all(r[0] == r[2] and r[3] == 0 for r in run(spark, rows))


def test_partial_overlaps_sum_to_the_intersections(monkeypatch):
    monkeypatch.setattr(jaccard_join, "COLUMNS", 7)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 90, rng.integers(1, 60))) for _ in range(40)]
    for left, right in ((np.arange(40), np.arange(40)), (np.arange(10), np.arange(10, 40))):
        for often in (0, 5, 100):
            monkeypatch.setattr(jaccard_join, "FREQUENT", often)
            want = [[len(np.intersect1d(sets[i], sets[j])) for j in right] for i in left]
            assert jaccard_join.overlaps(sets, left, right).tolist() == want


def test_empty_table(spark):
    out = jaccard_join.ngram_join(spark.createDataFrame([], SHAPE))
    assert out.collect() == [] and out.columns == ["doc_id", "n_shingles", "component_id", "n_links"]

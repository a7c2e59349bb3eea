"""Periodic runs against brute force, in one piece and word by word."""

import hashlib
import random
import zlib

from roadlake.llm import periodic


def brute(w):
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in out.items())


def sequence(rng):
    n, k = rng.randrange(90), rng.choice([1, 2, 3, 5, 40])
    w = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n:
            a, p = rng.randrange(n), rng.randrange(1, 12)
            for i in range(a + p, rng.randrange(a, n)):
                w[i] = w[i - p]
    return w


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        w = sequence(rng)
        assert periodic.word_runs(w) == brute(w), w


def test_runs_are_known_after_each_appended_slice():
    rng = random.Random(4)
    for _ in range(60):
        w, catcher, i = sequence(rng), periodic.SquareCatcher(), 0
        while i < len(w):
            step = rng.choice([1, 1, 2, 7])
            catcher.append(w[i:i + step])
            i += step
            assert catcher.found() == brute(w[:i])


def test_slices_of_long_texts_do_not_change_runs(monkeypatch):
    rng = random.Random(5)
    w = [rng.randrange(900) for _ in range(3000)]
    w = w + w[:400] * 6 + ["x"] * 700 + w[:13] * 9
    whole = periodic.word_runs(w)
    monkeypatch.setattr(periodic, "SLICE_WORDS", 97)
    assert periodic.word_runs(w) == whole == brute(w)


def test_one_word_and_repeated_runs_stay_cheap():
    assert periodic.word_runs(["a"] * 200_000) == [(0, 200_000, 1)]
    w = (["a"] * 500 + ["b"]) * 100
    found = periodic.word_runs(w)
    assert (0, len(w), 501) in found and len(found) == 101


def test_words_of_equal_hashes_of_sums_are_told_apart():
    # sums of powers of an odd base modulo 2**64 collide on such sequences
    w = [i.bit_count() % 2 for i in range(1 << 13)]
    w += w[:1 << 10] * 5
    assert periodic.word_runs(w) == brute(w)


def expected(doc_id, text):
    w = (text or "").encode().split()
    if doc_id is not None and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute(w)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_equals_brute_force_on_odd_rows(spark, tmp_dir):
    rng = random.Random(6)
    texts = [None, "", " \n\t ", "one", "a a a a a", "a a a a a a", "é ß\x00 é ß\x00 é ß\x00 é ß\x00", "line one\n" * 30,
             " ".join(str(x) for x in range(5000))]
    texts += [" ".join(map(str, sequence(rng))) for _ in range(150)]
    rows = [(i * 3, t, "own", "own") for i, t in enumerate(texts)]
    rows += [(None, "b b b b b b b", "own", "own"), (9, texts[5], "own", "own"), (9, texts[5], "own", "own")]
    path = tmp_dir + "/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, runs string, start string").repartition(3).write.parquet(path)
    out = [tuple(r) for r in periodic.query(spark, tmp_dir).collect()]
    assert sorted(out, key=repr) == sorted((expected(r[0], r[1]) for r in rows), key=repr)
    docs = spark.read.parquet(path)
    assert periodic.periodic_runs(docs).columns == ["doc_id", "start", "runs", "best_run", "collapsed"]
    assert periodic.periodic_runs(docs.limit(0)).collect() == []

"""The training-data operators against brute force, and on odd inputs."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from roadlake.llm import (decontaminate, extract, neardup, pii, quality_rules, ranking, repeats,
                          sentencepiece_codec, shards, toxicity)

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Extra columns take the names of results.
SCHEMA = ("doc_id long, text string, kept string, shard string, leaks string, ids string, score string, "
          "n_words string, pii_base string, th string, label string")


def words(n, seed, size=300):
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}x{seed if rng.random() < .5 else ''}" for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    a, b = words(120, 1), words(90, 2)
    edited = a[:60] + ["changed"] + a[61:]
    far = a[:30] + words(90, 3)
    texts = [" ".join(a), " ".join(edited).upper(), " ".join(far), " ".join(b), " ".join(b), None, "", " \n\t ",
             "one", "One", "two words here\n", " ".join(words(3000, 4)) + "\n" + " ".join(a), "é ß 😀 \x00 end",
             "line\nline\nline\n" * 30, "mail a.b@c.example.com and 4111 1111 1111 1111, +1 (499) 555-6503 or 10.0.0.255 now"]
    out = [(i, t) for i, t in enumerate(texts)]
    return out + [(None, " ".join(b)), (None, None), (3, " ".join(b)), (3, " ".join(b))]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, *["own"] * 9) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ------------------------------------------------------------ near duplicates
def shingles(t):
    w = WORDS.findall((t or "").translate(ASCII_LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_near_duplicates_equal_brute_force(docs, rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 75 * len(x | y):
                    label[i] = min(label[i], label[j])
    want = []
    for i, (k, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None] if sets[i] else [k]
        c = min(ids) if ids and ids[0] is not None else None
        want.append((k, len(sets[i]), c, k == c))
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_deduplicate_keeps_one_of_each_group_and_all_columns(docs):
    out = neardup.deduplicate(docs)
    assert out.columns == docs.columns
    ids = Counter(r.doc_id for r in out.select("doc_id").collect())
    assert ids[0] == 1 and ids[1] == 0 and ids[3] == 1 and ids[4] == 0 and ids[5] == 1


def test_a_large_group_of_near_copies_is_one_component(spark):
    base = words(100, 7, 10_000)
    made = []
    for i in range(300):
        w = list(base)
        w[(i * 7) % 100] = f"edit{i}"
        made.append((i, " ".join(w)))
    got = neardup.near_duplicates(spark.createDataFrame(made, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}


def test_links_just_above_the_limit_in_a_large_group_of_pairs_just_below(spark, monkeypatch):
    """Copies of one text with three edits each: most pairs fall short of the
    limit, a few reach it. Small blocks, so that pairs meet across blocks."""
    monkeypatch.setattr(neardup, "TEXT_BLOCK", 40)
    rng = np.random.default_rng(3)
    base = words(110, 11, 10_000)
    made = []
    for i in range(160):
        w = list(base)
        for at in rng.choice(110, 3, replace=False):
            w[at] = f"edit{rng.integers(4)}"
        made.append((i, " ".join(w)))
    sets = [shingles(t) for _, t in made]
    label = list(range(len(made)))
    for i, x in enumerate(sets):
        for j in range(i):
            if label[i] != label[j] and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if v == high else v for v in label]
    assert 1 < len(set(label)) < 160
    got = neardup.near_duplicates(spark.createDataFrame(made, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(label))


def test_estimate_follows_the_similarity():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 2000, dtype=np.int64).astype(np.uint64)
    for shared in (1800, 1000, 200):
        y = np.concatenate([x[:shared], rng.integers(0, 1 << 63, 2000 - shared, dtype=np.int64).astype(np.uint64)])
        s = neardup.packed(np.stack([neardup.minima(x), neardup.minima(y)]))
        assert abs(neardup.estimate(s[0], s[1]) - shared / (4000 - shared)) < 0.15


# ------------------------------------------------------------------ tokenising
def test_codec_equals_the_library():
    import sentencepiece
    path = sentencepiece_codec.default_model()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    c = sentencepiece_codec.Codec(sentencepiece_codec.load_pieces(path))
    rng = random.Random(3)
    texts = ["", " ", "the  end \n", "▁ a", "x" * 300, "<s> <0x0A>", "the" + " " * 70 + "the"]
    texts += ["".join(rng.choice("abe th\n\t▁éß的🙂\x00.,0A") for _ in range(rng.randrange(60))) for _ in range(800)]
    for t in texts:
        ids = c.encode(t)
        assert ids == sp.encode(t)
        assert c.decode(ids) == sp.decode(ids)
    for _ in range(500):
        ids = [rng.randrange(32000) if rng.random() < .5 else rng.randrange(3, 259) for _ in range(8)]
        assert c.decode(ids) == sp.decode(ids)


def test_encode_decode_columns(docs, empty, rows):
    path = sentencepiece_codec.default_model()
    got = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, path), path).select("text", "ids", "decoded").collect()
    assert all((r.text or "") == r.decoded for r in got)
    d = {r.text: r for r in sentencepiece_codec.digests(docs, path).collect()}
    for r in got:
        assert d[r.text].ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
    assert sentencepiece_codec.digests(empty, path).count() == 0


# ------------------------------------------------------------------ extraction
def test_article_blocks_are_found_in_other_pages():
    m, rng, right, total = extract.trained(), random.Random(71), 0, 0
    for _ in range(150):
        page, y = extract.training_page(rng)
        blocks = extract.Blocks(page).out
        if blocks:
            assert len(blocks) == len(y)
            right += (((m.logits(m.batch([blocks]))[0][:, 0]) > 0) == np.array(y, bool)).sum()
            total += len(y)
    assert right / total > 0.99


def test_main_text_of_table_and_odd_pages(spark):
    page = ("<html><head><title>t</title></head><body><nav><ul><li><a href=x>Home</a></ul></nav><article><h1>A &amp; B</h1>"
            "<p>One\n two<br>three <b>bold</b><p>Four &lt;5&gt;</article><script>var x='<p>no</p>'</script>"
            "<footer>&copy; me</footer></body></html>")
    df = spark.createDataFrame([(1, page, "x"), (2, None, "x"), (3, "", "x"), (4, "<<<>", "x"), (5, "<p" * 3000, "x")],
                               "page_id long, html string, text string")
    got = {r.page_id: r.text for r in extract.main_text(df).collect()}
    assert got[1] == "A & B\n\nOne two three bold\n\nFour <5>"
    assert got[2] == got[3] == ""
    assert extract.main_text(df.limit(0)).count() == 0


def test_names_behind_long_attributes_and_any_depth_are_read():
    long = f'style="{"margin:0;" * 90}" data-x=\'{"y" * 500}\''
    for page in ('<div {}class="user-comments" id=top role="note">text</div>', "<nav {}><p {}class=advert>text"):
        assert extract.Blocks(page.replace("{}", long + " ")).out == extract.Blocks(page.replace("{}", "")).out
    half = f'<div id="{"w " * 199}comments">text</div>'
    assert set(extract.tag_bins("x", "id=comments")[1:]) <= set(extract.Blocks(half).out[0][1])
    for depth in (10, 64, 500):
        text, path, _ = extract.Blocks("<nav>menu" + "<section>" * depth + "in</nav>after").out[-1]
        assert (text, path) == ("after", ())
    nested = extract.Blocks("<main><nav><nav>a</nav>b</nav>c</nav>d</main>e").out
    assert [len(p) for _, p, _ in nested] == [2, 2, 1, 1, 0]


# --------------------------------------------------------------- quality rules
def plain_statistics(t):
    t = t or ""
    w = WORDS.findall(t)
    c = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again)


def test_statistics_equal_brute_force(docs):
    for r in quality_rules.with_statistics(docs).collect():
        want = plain_statistics(r.text)
        assert tuple(r[c] for c in quality_rules.BASE) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_posterior_rejects_symbol_junk_and_keeps_prose(spark, empty):
    good = [(i, " ".join(words(150, i)).capitalize() + ".") for i in range(80)]
    bad = [(100 + i, " ".join(w + "***" for w in words(150, 50 + i))) for i in range(20)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string")
    assert {r.doc_id for r in quality_rules.filter_quality(df).collect()} == set(range(80))
    assert quality_rules.filter_quality(empty).count() == 0


# -------------------------------------------------------------- contamination
def test_copies_of_items_are_found_edited_or_not(spark, docs, empty):
    item = "Which river crosses the old town before it meets the northern sea near two lighthouses".split()
    edited = item[:4] + ["very"] + item[4:9] + ["cold"] + item[10:]
    near = " ".join(words(40, 8))
    df = spark.createDataFrame([(1, f"{near} {' '.join(item)} {near}"), (2, f"{near} {' '.join(edited).upper()}!"), (3, near),
                                (4, " ".join(item[:4]) + near), (5, None), (6, ""), (7, "a b c"), (8, f"{near} tiny item")],
                               "doc_id long, text string")
    bench = spark.createDataFrame([(10, " ".join(item)), (10, " ".join(item)), (11, None), (12, ""), (13, "tiny item")],
                                  "item_id long, text string")
    got = {r.doc_id: {x.item_id for x in r.leaks} for r in decontaminate.with_leaks(df, bench).collect()}
    assert got == {1: {10}, 2: {10}, 3: set(), 4: set(), 5: set(), 6: set(), 7: set(), 8: {13}}
    assert {r.doc_id for r in decontaminate.decontaminate(df, bench).collect()} == {3, 4, 5, 6, 7}
    assert decontaminate.decontaminate(df, bench.limit(0)).count() == 8
    assert decontaminate.decontaminate(docs, bench).columns == docs.columns
    assert decontaminate.decontaminate(empty, bench).count() == 0


def test_edits_that_break_half_the_seeds_and_common_seeds_lose_no_copy(spark):
    items = {n: [f"i{n}x{j}" for j in range(n)] for n in (40, 50, 60)}
    near = words(40, 8)
    lone = {n: [f"edit{j}" if j % 7 == 6 else w for j, w in enumerate(items[n])] for n in (40, 50)}
    # a group that holds the same two thirds of an item, so that its live seeds are the common ones
    part = [f"other{j}" if j % 12 >= 8 else w for j, w in enumerate(items[60])]
    made = [(n, " ".join(near + w + near)) for n, w in lone.items()] + [(100 + i, f"own{i} " + " ".join(part)) for i in range(60)]
    df = spark.createDataFrame(made, "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    got = {r.doc_id: [x.item_id for x in r.leaks] for r in decontaminate.with_leaks(df, bench).collect()}
    assert got == {40: [40], 50: [50], **{100 + i: [60] for i in range(60)}}
    assert decontaminate.decontaminate(df, bench).count() == 0


def test_copies_in_other_case_are_found_in_any_alphabet(spark):
    items = ["Über die größere Straße läuft jeden Abend ein älterer Ärztekongreß öfters früher heim",
             "Какая река пересекает старый город прежде чем встретить северное море у двух маяков",
             "Ποιος ποταμός διασχίζει την παλιά πόλη πριν συναντήσει τη βόρεια θάλασσα δίπλα στους φάρους"]
    texts = [f(t) for t in items for f in (str, str.upper, str.lower, str.swapcase)]
    df = spark.createDataFrame([(i, f"w1 w2 w3 {t} w4 w5") for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.doc_id: [(x.item_id, x.score) for x in r.leaks] for r in decontaminate.with_leaks(df, bench).collect()}
    assert got == {i: [(i // 4, 1.0)] for i in range(12)}


def test_leaks_do_not_depend_on_the_hits_held(monkeypatch):
    rng = np.random.default_rng(4)
    items = [" ".join(f"w{x}" for x in rng.integers(0, 9, 12)) for _ in range(20)]
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 9, 90)) for _ in range(30)] + items
    find = decontaminate.Finder(decontaminate.make_block(list(range(20)), items))
    slices = [(h, rows) for *_, h, rows in decontaminate.hashed_words(decontaminate.pa.array(texts))]
    whole = [find.leaks(h, rows) for h, rows in slices]
    monkeypatch.setattr(decontaminate, "HITS", 1)
    assert [find.leaks(h, rows) for h, rows in slices] == whole
    assert all(any(x["item_id"] == i and x["score"] == 1 for x in whole[0][30 + i]) for i in range(20))


def test_alignment_equals_the_plain_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = (rng.integers(0, 4, rng.integers(1, 14)).astype(np.uint64) for _ in range(2))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontaminate.alignment(a, b) == h.max()


# ------------------------------------------------------------------- sharding
def test_shards_are_even_and_slots_gapless(docs, empty, spark):
    many = spark.createDataFrame([(i % 700, ["", "same", f"text {i} " * (i % 40)][min(i % 5, 2)]) for i in range(2000)], "doc_id long, text string")
    got = shards.assign(shards.keyed(many).drop("text")).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(got) == 2000 and sorted(sizes.index) == list(range(8)) and sizes.max() - sizes.min() <= 2 * got["size"].max()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert shards.assign(shards.keyed(docs)).count() == docs.count()
    assert shards.assign(shards.keyed(empty)).count() == 0


# ------------------------------------------------------------ repeated passages
def plain_repeats(rows, n=35):
    ws = [WORDS.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i:i + n]) for w in ws for i in range(len(w) - n + 1))
    out = []
    for (k, _), w in zip(rows, ws):
        gone = {j for i in range(len(w) - n + 1) if count[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
        out.append((k, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def test_repeats_equal_brute_force(docs, rows, empty, spark):
    key = lambda r: str(r)
    assert sorted(map(tuple, repeats.without_repeats(docs, 3).collect()), key=key) == sorted(plain_repeats(rows), key=key)
    periodic = [(1, "a " * 36), (2, "a " * 34), (3, "b c " * 40), (4, " ".join(words(34, 1)) + " z"), (5, " ".join(words(34, 1)) + " z y")]
    got = repeats.without_repeats(spark.createDataFrame(periodic, "doc_id long, text string"), 2).collect()
    assert sorted(map(tuple, got)) == sorted(plain_repeats(periodic))
    assert repeats.without_repeats(empty).count() == 0


# ----------------------------------------------------------------- classifiers
def test_ranking_orders_and_survives_one_label():
    rng = np.random.default_rng(1)
    x = rng.random((400, len(ranking.FEATURES)))
    y = (x[:, 2] < 0.7).astype(int)
    r = ranking.learn(x, y)
    s = x @ np.array(r.weights) - r.threshold
    assert ((s >= 0) == (y == 1)).mean() > 0.95
    assert ranking.learn(x, np.ones(400, int)).weights == (0.0,) * len(ranking.FEATURES)
    assert ranking.learn(x[:0], y[:0]).threshold == 0


def test_ranking_scores_every_text(docs, empty):
    r = ranking.Ranking((1.0,) * len(ranking.FEATURES), 0.5)
    got = ranking.scored(docs, r).collect()
    assert len(got) == docs.count() and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in got)
    assert ranking.scored(empty, r).count() == 0


def test_machine_learns_a_pair(spark, docs, empty):
    rng = random.Random(4)
    made, y = [], []
    for i in range(1500):
        a, b = rng.random() < .5, rng.random() < .5
        made.append(np.array(sorted({*(rng.randrange(5000) for _ in range(20)), *([9001] if a else []), *([9002] if b else [])})))
        y.append(float(a and b))
    m = toxicity.learn(made, np.array(y))
    assert m.place[9001] >= 0 and m.place[9002] >= 0
    x = np.zeros((4, len(m.weight)), np.float32)
    x[1, m.place[9001]] = x[2, m.place[9002]] = x[3, m.place[9001]] = x[3, m.place[9002]] = 1
    s = m.margin(x)
    assert s[3] > 0 > max(s[:3])
    got = toxicity.scored(docs, m).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scored(empty, m).count() == 0
    none = toxicity.learn([np.array([1])], np.array([0.0]))
    assert 0 < float(1 / (1 + np.exp(-none.bias))) < 0.5


@pytest.mark.parametrize("module,label,share", [(ranking, "quality", .85), (toxicity, "toxic", .85)])
def test_held_out_accuracy(spark, module, label, share):
    sf = "/root/testdata/sf0.01"
    got = module.query(spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held[label]).mean() >= share


# --------------------------------------------------------------- personal data
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (c > "4") for i, c in enumerate(reversed(d))) % 10 == 0


def plain_spans(t):
    out = []
    for k, p in PATTERNS.items():
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                    "card": lambda: 13 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[k]():
                out.append((k, m.start(), m.end()))
    return out


def test_base_spans_equal_brute_force(spark, docs, rows, empty):
    odd = ["a@b.c_x@d.e a@b", "1.2.3.4.5.6.7.8 999.1.1.1 00001.2.3.4", "9" * 20000, "1 " * 9000, "x@y.z " * 500, "+1 ((((((",
           "😀 4111 1111 1111 1111 😀 +1 (499) 555-6503", "4111111111111111-", "+1.2.3.4.5.6.7.8.9.0.1"]
    df = docs.select("doc_id", "text").union(spark.createDataFrame([(50 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    for r in pii.spans(df, None).collect():
        got = [(k, s.start, s.end) for k in pii.KINDS for s in r.pii_base[k]]
        assert got == plain_spans(r.text), r.text[:60]
        assert list(r.pii_added) == []
    assert pii.redact(empty).count() == 0


def test_ips_with_zero_parts_equal_brute_force(spark):
    parts = ["0", "00", "000", "05", "010", "0255", "255", "256", "0256", "8"]
    texts = [".".join(["8"] * at + [p] + ["9"] * (3 - at)) for at in range(4) for p in parts]
    texts += ["0.0.0.0", "10.0.0.1 127.0.0.1, 192.168.0.7", "0.0.0.256", "0" * 3000 + ".0.0." + "0" * 3000, "0" * 3000 + "1.2.3.999"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.spans(df, None).collect():
        assert [(k, s.start, s.end) for k in pii.KINDS for s in r.pii_base[k]] == plain_spans(r.text), r.text[:60]
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got[41] == "[IP] [IP], [IP]"


def test_redaction_replaces_spans(spark):
    df = spark.createDataFrame([(1, "mail a.b@c.example.com, card 4111 1111 1111 1111 end", 0), (2, None, 0), (3, "nothing here", 12)],
                               "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(df).collect()}
    assert got[1][0] == "mail [EMAIL], card [CARD] end" and got[1][1] == len(got[1][0])
    assert got[2][0] is None and got[3] == ("nothing here", 12)


def test_spans_on_a_table_keep_the_base_and_add_tokens(spark):
    got = pii.query(spark, "/root/testdata/sf0.01").collect()
    kinds = Counter(s.split(":")[0] for r in got for s in r.spans.split(",") if s)
    assert kinds["secret"] > 0 and kinds["email"] == sum(r.n_email for r in got)


def test_hot_copies_do_not_displace_other_proposals(spark, monkeypatch):
    """One proposal of each label in more copies than the sample holds."""
    monkeypatch.setattr(pii, "SAMPLE", 40)
    kinds = [lambda i: f"mail {'a' * (i % 17 + 1)}@{'b' * (i % 5 + 1)}.com", lambda i: f"on 12{' ' * (i % 2)}-34{'.' * (i % 4 // 2)}5{'6' * (i % 7 % 3 + 1)} seen",
             lambda i: f"token: \"{'xK3' * (6 + i % 7)}{i}\" end"]
    made = [kinds[i % 3](i) for i in range(150)]
    seen = []
    monkeypatch.setattr(pii, "materialize", lambda df, name="part": (seen.append((name, df.cache())), seen[-1][1])[1])
    for hot in (made[0], made[1]):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(made + [hot] * 200)], "doc_id long, text string")
        assert pii.fit(df.select("text")) is not None
        sample = [r.asDict() for n, d in seen if n == "proposals" for r in d.collect()]
        seen.clear()
        for y in (0, 1):
            own = [r for r in sample if r["label"] == y]
            assert len({tuple(r[n] for n in pii.FEATURES) for r in own}) == len(own) > 3
            assert 0 < sum(r["nth"] % 4 == 0 for r in own) < len(own)
        assert max(r["weight"] for r in sample) >= 200


# -------------------------------------------------------------------- pipeline
def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() < docs.count()
    assert out.columns[:len(docs.columns)] == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "pii", "sentencepiece"]

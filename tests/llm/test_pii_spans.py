"""Added spans and redaction against plain Python, and texts of many matches."""

import random
import time

from pyspark.sql import functions as F

from roadlake.llm import pii

BITS = ["a.b@c.com", "10.0.0.1", "4111 1111 1111 1111", "+1 (499) 555-6503", "😀", "token: ", "x9f8e7d6c5b4a39281zz", " ", "é",
        "joe [at] ex.com", "12-34-56-78", "1234567890", "\n", "2020-01-02", "abcdefghij1234567890", "=", "word"]


def made_texts(n):
    rng = random.Random(11)
    return ["".join(rng.choice(BITS) + rng.choice(["", " "]) for _ in range(rng.randrange(60))) for _ in range(n)] + [None, ""]


def plain_added(proposed):
    """Leftmost, then longest, free of the base spans and of earlier choices."""
    base = [(p.start, p.end) for p in proposed if p.is_base]
    out, at = [], 0
    for start, back, kind in sorted((p.start, -p.end, p.kind) for p in proposed if not p.is_base and p.digits >= 6):
        if start >= at and not any(a < -back and start < b for a, b in base):
            out.append((kind, start, -back))
            at = -back
    return out


def plain_redacted(text, spans):
    out, at = "", 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def test_added_spans_and_redaction_equal_plain_python(spark, monkeypatch):
    monkeypatch.setattr(pii, "fit", lambda docs: lambda c: c("digits") >= 6)
    df = spark.createDataFrame(list(enumerate(made_texts(150))), "doc_id long, text string")
    text = F.coalesce("text", F.lit(""))
    proposed = {r.doc_id: r.p for r in df.select(
        "doc_id", pii.let(pii.base_spans(text), lambda b: pii.proposals(text, b)).alias("p")).collect()}
    redacted = {r.doc_id: r.text for r in pii.redact(df).collect()}
    for r in pii.spans(df).collect():
        got = [(s.kind, s.start, s.end) for s in r.pii_added]
        assert got == plain_added(proposed[r.doc_id]), r.text
        for p in proposed[r.doc_id]:
            assert r.text[p.start:p.end] == p.value
            assert p.quoted == (r.text[p.start - 1:p.start] in ("'", '"') or r.text[p.end:p.end + 1] in ("'", '"')) or not p.start
        every = [(s.start, s.end, k) for k in pii.KINDS for s in r.pii_base[k]] + [(b, e, k) for k, b, e in got]
        assert redacted[r.doc_id] == (plain_redacted(r.text, every) if r.text is not None else None)


def test_a_hundred_thousand_matches_in_one_text(spark):
    """2 MB with 100,000 base spans and as many proposals, in seconds."""
    part = "ip 10.0.0.1 key x9f8e7d6c5b4a392 "
    df = spark.createDataFrame([(1, part * 100_000)], "doc_id long, text string")
    began = time.time()
    n, m = pii.spans(df, lambda c: c("digits") >= 6).select(F.size("pii_base.ip"), F.size("pii_added")).first()
    assert (n, m) == (100_000, 100_000)
    assert time.time() - began < 120


def test_redaction_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(pii, "fit", lambda docs: lambda c: c("digits") >= 6)
    df = spark.createDataFrame([(1, "ip 10.0.0.1 key x9f8e7d6c5b4a392 " * 20_000)], "doc_id long, text string")
    assert pii.redact(df).first().text == "ip [IP] key [SECRET] " * 20_000

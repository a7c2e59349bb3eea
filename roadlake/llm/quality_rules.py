"""Quality rules combined by weak supervision. DataFrame functions only.

Seven rules read whole-text statistics and vote "good" (1), "bad" (-1) or
abstain (0). Expectation-maximisation over the counts of vote patterns (at
most 3**7 rows, whatever the corpus) estimates each rule's rate of every vote
on good and on bad documents; a document is kept when its posterior
probability of being good is at least 0.5 and its base checks pass.

Defined cases: a null text counts as empty; a document without words fails
the base checks (fewer than 50 words) and its rules abstain; on an empty
table the starting rates are used; equal texts get equal verdicts; a column
whose name clashes with a result's is replaced by the result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import drop_clashing, fresh, materialize, read, text_of, words_of

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: further statistics that only the rules read
MORE = ["n_lines", "n_upper", "n_letters", "n_marks"]
VOTES = ("symbols", "symbol_share", "repeats", "lines", "word_size", "capitals", "marks")
KEEP_AT = 0.5
ROUNDS = 8
WINDOW = 3


def let(value: Column, body) -> Column:
    """``body`` of ``value``, computed once (a one-element array's lambda)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_of(text: Column, chars: str) -> Column:
    """Characters of the class ``chars``."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def repeat_words(hashes: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows become 64-bit hashes. Those whose upper 40 bits recur (found by
    sorting plain longs that carry the position below) are then compared in
    full; covered words are counted over the sorted positions."""
    def neighbours(a: Column, same) -> Column:
        # elements of a sorted array that agree with the one before or after
        i = F.sequence(F.lit(0), F.size(a) - 1)
        return F.filter(F.transform(i, lambda k: F.when(
            same(F.get(a, k), F.get(a, k - 1)) | same(F.get(a, k), F.get(a, k + 1)), F.get(a, k))),
            lambda x: x.isNotNull())

    low = (1 << 24) - 1

    def windows(h):
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                           lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))

    def rough(w):
        # (upper hash bits, position), as one long
        packed = F.transform(w, lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")))
        return let(F.sort_array(packed), lambda s: neighbours(
            s, lambda x, y: F.coalesce(F.shiftright(x, 24) == F.shiftright(y, 24), F.lit(False))))

    def exact(w, found):
        pairs = F.sort_array(F.transform(found, lambda p: let(
            p.bitwiseAND(F.lit(low)).cast("int"), lambda i: F.struct(F.get(w, i).alias("w"), i.alias("i")))))
        return let(pairs, lambda s: neighbours(
            s, lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))))

    def covered(found):
        at = F.sort_array(F.transform(found, lambda x: x["i"]))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(at, start, lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")))["n"].cast("long")

    def count(w):
        return let(rough(w), lambda found: F.when(F.size(found) == 0, F.lit(0).cast("long")).otherwise(
            let(exact(w, found), lambda e: F.when(F.size(e) == 0, F.lit(0).cast("long")).otherwise(covered(e)))))

    return F.when(F.size(hashes) < WINDOW + 1, F.lit(0).cast("long")).otherwise(let(windows(hashes), count))


def statistics(text: Column) -> Column:
    """BASE, MORE and base_failed of a whole text, as one struct whose parts
    are computed once, however often the struct's fields are read."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    hashes = F.transform(words_of(text), lambda w: F.xxhash64(w))

    def failed(s: Column) -> Column:
        return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])

    words = let(hashes, lambda h: F.struct(F.size(h).cast("long").alias("n"), repeat_words(h).alias("again")))
    lined = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d")))
    plain = let(F.struct(words.alias("w"), lined.alias("l")), lambda s: F.struct(
        s["w"]["n"].alias("n_words"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        count_of(text, "#*$%&|<>").alias("n_symbols"),
        (s["l"]["n"] - s["l"]["d"]).alias("n_dup_lines"),
        s["w"]["again"].alias("n_repeat_words"),
        s["l"]["n"].alias("n_lines"),
        count_of(text, "A-Z").alias("n_upper"),
        count_of(text, "A-Za-z").alias("n_letters"),
        count_of(text, "!?").alias("n_marks")))
    return let(plain, lambda s: F.struct(*[s[n].alias(n) for n in (*BASE, *MORE)], failed(s).alias("base_failed")))


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns BASE, MORE and base_failed, over whole texts."""
    docs = drop_clashing(docs, [*BASE, *MORE, "base_failed"])
    held = fresh(docs, "stats")[0]
    return docs.withColumn(held, statistics(text_of())).select(*[f"`{c}`" for c in docs.columns], f"{held}.*")


def votes(c) -> dict[str, Column]:
    """Each rule's vote from the statistics ``c(name)``; 0 where there are no words."""
    n = c("n_words")

    def vote(good: Column, bad: Column) -> Column:
        return F.coalesce(F.when(n == 0, 0).when(bad, -1).when(good, 1).otherwise(0), F.lit(0))

    return dict(zip(VOTES, (
        vote(c("n_symbols") * 50 <= n, c("n_symbols") * 5 > n),
        vote(c("n_symbols") * 100 <= c("word_chars"), c("n_symbols") * 20 > c("word_chars")),
        vote(c("n_repeat_words") * 5 <= n, c("n_repeat_words") * 2 > n),
        vote(c("n_dup_lines") <= 1, (c("n_dup_lines") > 3) & (c("n_dup_lines") * 10 > c("n_lines") * 3)),
        vote((c("word_chars") >= 3 * n) & (c("word_chars") <= 9 * n),
             (c("word_chars") < 2 * n) | (c("word_chars") > 12 * n)),
        vote(c("n_upper") * 8 <= c("n_letters"), c("n_upper") * 10 > c("n_letters") * 3),
        vote(c("n_marks") * 50 <= n, c("n_marks") * 5 > n)), strict=True))


@dataclass(frozen=True)
class Rates:
    """Share of good documents, and for each rule the probabilities of its
    votes (bad, abstain, good) on good and on bad documents."""
    good: float
    on_good: tuple[tuple[float, float, float], ...]
    on_bad: tuple[tuple[float, float, float], ...]


#: Before the first round: good documents are seldom voted bad; on bad ones a
#: rule often sees nothing wrong, as most faults show in one rule only.
START = Rates(0.85, ((0.005, 0.05, 0.945),) * len(VOTES), ((0.30, 0.05, 0.65),) * len(VOTES))


def posterior(rates: Rates, vote) -> Column:
    """Probability that a document is good, given its votes ``vote(rule)``."""
    odds = F.lit(math.log(rates.good / (1 - rates.good)))
    for name, g, b in zip(VOTES, rates.on_good, rates.on_bad, strict=True):
        w = [math.log(x / y) for x, y in zip(g, b)]
        odds = odds + F.when(vote(name) == -1, w[0]).when(vote(name) == 1, w[2]).otherwise(w[1])
    return 1 / (1 + F.exp(-odds))


def by_column(name: str) -> Column:
    return F.col(f"vote_{name}")


def with_votes(stats: DataFrame) -> DataFrame:
    return drop_clashing(stats, [f"vote_{n}" for n in VOTES]).withColumns(
        {f"vote_{n}": v for n, v in votes(F.col).items()})


def fit(stats: DataFrame, rounds: int = ROUNDS) -> Rates:
    """Rates by expectation-maximisation over all documents of ``stats`` that
    pass the base checks (the others are decided already)."""
    names = [f"vote_{n}" for n in VOTES]
    patterns = materialize(with_votes(stats.where("not base_failed")).groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "votes")
    rates = START
    for _ in range(rounds):
        p = posterior(rates, by_column)
        sums = [F.sum(F.col("n")), F.sum(F.col("n") * F.col("p"))]
        for name in names:
            for v in (-1, 0, 1):
                hit = F.col("n") * (F.col(name) == v).cast("int")
                sums += [F.sum(hit * F.col("p")), F.sum(hit * (1 - F.col("p")))]
        got = patterns.withColumn("p", p).agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        if not got[0]:
            return START
        total, good = float(got[0]), float(got[1])

        def share(k: int, of: float) -> tuple[float, float, float]:
            # one pseudo-count a vote keeps every rate above zero
            return tuple((got[k + 2 * v] + 1) / (of + 3) for v in range(3))

        rates = Rates((good + 1) / (total + 2),
                      tuple(share(2 + 6 * i, good) for i in range(len(VOTES))),
                      tuple(share(3 + 6 * i, total - good) for i in range(len(VOTES))))
    return rates


def judge(stats: DataFrame, rates: Rates) -> DataFrame:
    """``stats`` with the votes, p_good and kept."""
    out = with_votes(drop_clashing(stats, ["p_good", "kept"])).withColumn("p_good", posterior(rates, by_column))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_AT))


def filter_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with the same columns."""
    rates = fit(with_statistics(docs.select("text")).drop("text"))

    def kept(s: Column) -> Column:
        v = votes(lambda name: s[name])
        return ~s["base_failed"] & (posterior(rates, lambda name: v[name]) >= KEEP_AT)

    return docs.where(let(statistics(text_of()), kept))


def query(spark, sf_dir: str) -> DataFrame:
    stats = materialize(with_statistics(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"), "stats")
    return judge(stats, fit(stats)).select(
        "doc_id", *BASE, "base_failed", "kept", "p_good", *[f"vote_{n}" for n in VOTES])

"""Personal data by candidate gradient boosting. DataFrame functions only.

Base patterns (email, ip, card, phone) are redacted always. High-recall
generators propose further, overlapping spans: long numbers in any grouping,
mixed letter-digit tokens, disguised addresses. Gradient-boosted trees over
format and context features score them; the trees are fitted on proposals
that carry a weak label (base spans and keyword-introduced tokens are
positive, short plain numbers, dates, versions and tokens inside links are
negative) and are turned into a column expression, so scoring needs no
shuffle. The threshold is the lowest score whose precision on all labelled
proposals reaches 0.95, each scored by trees that have not seen it. Selected
proposals never displace a base span; among themselves the leftmost, then
longest, wins.

Labelled proposals with the same label and features are one, with their count
as its weight in the trees and in the precision, so copies of a text take one
place. The fit reads all of them, in tasks of about ``SAMPLE``. Every fourth of
a label, in the order of a hash, is a fold: for the threshold each fold in turn
is held out, and the trees that score texts learn from all rows. Work in a
text grows with its length and with its matches times the logarithm of their
number.

Defined cases: a null text is empty and has no spans; offsets are code
points, end exclusive; without labelled proposals of both labels nothing is
added to the base spans; equal texts get equal spans; other columns pass
through, clashing result columns are replaced.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlake.functions.arrays import let, running_max, running_sum
from roadlake.llm.common import drop_clashing, materialize, read, text_of

KINDS = ("email", "ip", "card", "phone")
ADDED = ("number", "secret", "contact")
#: Distinct labelled proposals in a task of the fit, which reads all of them.
SAMPLE = 100_000
#: Spark draws the trees' cut points from max(bins squared, EXAMPLES) rows when there are more.
BINS, EXAMPLES = 32, 10_000
PRECISION = 0.95
FOLDS = 4
TREES, DEPTH = 15, 3

#: Possessive forms of the base patterns: the same matches, without retries
#: inside a run of characters that cannot match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+", "number": "[0-9]{2}", "secret": "[0-9]",
         "contact": r"(?i)[\[(]at[\])]"}
PROPOSALS = {
    "number": r"[0-9](?:[\x20().-]{0,2}[0-9])++",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}+",
    "contact": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[a-z0-9-]++(?:\.[a-z0-9-]++)++",
}
FEATURES = ("length", "digits", "letters", "marks", "plus", "at", "hexadecimal", "quoted", "keyword",
            "joined", "groups", "upper")
#: Each part is at most 255; leading zeros do not count, and a part may be zeros only.
OCTETS = r"^(?:0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"
#: Code points in a block of a text, and proposals in a block of the choice.
BLOCK = 256
SPAN = "array<struct<start:int,end:int,value:string>>"


def matches(text: Column, kind: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches, with their offsets: the pieces
    between matches and the matches alternate, so lengths add up to them."""
    both = F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    none = F.expr(f"cast(array() as {SPAN})")

    def placed(s: Column) -> Column:
        ends = running_sum(F.transform(s["m"], lambda m, i: F.length(F.get(s["p"], i)) + F.length(m)))
        return F.zip_with(ends, s["m"], lambda e, m: F.struct(
            (e - F.length(m)).alias("start"), e.alias("end"), m.alias("value")))

    return F.when(text.rlike(NEEDS[kind]), let(both, lambda s: F.when(F.size(s["m"]) > 0, placed(s)).otherwise(none))) \
        .otherwise(none)


def blocks(text: Column) -> Column:
    """The text in blocks of BLOCK code points, so that a part is reached
    without a walk from the text's start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def part(blocks_of: Column, begin: Column, end: Column) -> Column:
    """Code points ``begin`` to ``end`` (exclusive) of the text."""
    first = F.floor(begin / BLOCK).cast("int")
    held = F.array_join(F.slice(blocks_of, first + 1, F.greatest(F.floor(end / BLOCK).cast("int") - first, F.lit(0)) + 1), "")
    return F.substring(held, begin - first * BLOCK + 1, F.greatest(end - begin, F.lit(0)))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def base_spans(text: Column) -> Column:
    """Struct of the base kinds' span arrays; failing matches are dropped."""
    def card(x):
        d = digits(x["value"])
        return F.length(d).between(13, 19) & F.call_function("luhn_check", d)

    valid = {"email": lambda x: F.lit(True), "ip": lambda x: x["value"].rlike(OCTETS), "card": card,
             "phone": lambda x: F.length(digits(x["value"])).between(9, 15)}
    return F.struct(*[F.filter(matches(text, k, BASE[k]), valid[k]).alias(k) for k in KINDS])


def features(context: Column, s: Column) -> dict[str, Column]:
    """Format and context of the span ``s`` (start, end, value); ``context``
    holds the 24 code points before it and the one after."""
    v, before = s["value"], context["before"]
    count = lambda chars: F.length(F.regexp_replace(v, f"[^{chars}]+", ""))
    near = F.concat(F.when(s["start"] > 0, F.right(before, F.lit(1))).otherwise(F.lit(" ")), F.lit("|"), context["after"])
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return {
        "length": F.length(v), "digits": count("0-9"), "letters": count("A-Za-z"), "marks": count(r"\x20().\-"),
        "plus": flag(before.endswith("+") | before.rlike(r"\+[0-9() .-]{0,6}$") | v.startswith("+")),
        "at": flag(v.contains("@") | v.rlike(r"(?i)[\[(]at[\])]")), "hexadecimal": flag(v.rlike("^[0-9a-f]+$") & v.rlike("[a-f]")),
        "quoted": flag(near.rlike(r"""^["']\|["']$""")),
        "keyword": flag(before.rlike(r"""(?i)(token|key|secret|passw|pin|card|tel|phone|iban|account)\w*\s*[:=]?\s*["']?$""")),
        "joined": flag(near.rlike(r"^[A-Za-z0-9_/=&?%-]\||\|[A-Za-z0-9_/=&?%-]$")),
        "groups": F.size(F.split(v, r"[\x20().\-]+", -1)), "upper": count("A-Z"),
    }


def proposals(text: Column, base: Column) -> Column:
    """array of struct(kind, start, end, value, is_base, feature...)."""
    def described(kind, spans, is_base, cut):
        def one(s):
            context = F.struct(part(cut, F.greatest(s["start"] - 24, F.lit(0)), s["start"]).alias("before"),
                               part(cut, s["end"], s["end"] + 1).alias("after"))
            return let(context, lambda c: F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
                F.lit(is_base).alias("is_base"), *[f.cast("double").alias(n) for n, f in features(c, s).items()]))

        return F.transform(spans, one)

    enough = {"number": lambda s: F.length(digits(s["value"])) >= 6,
              "secret": lambda s: F.length(digits(s["value"])) >= 4, "contact": lambda s: F.lit(True)}
    more = F.struct(*[F.filter(matches(text, k, PROPOSALS[k]), enough[k]).alias(k) for k in ADDED])

    def all_of(m):
        some = sum((F.size(x) for x in [base[k] for k in KINDS] + [m[k] for k in ADDED]), F.lit(0)) > 0
        cut = F.when(some, blocks(text)).otherwise(F.expr("cast(array() as array<string>)"))
        return let(cut, lambda t: F.concat(*[described(k, base[k], True, t) for k in KINDS],
                                           *[described(k, m[k], False, t) for k in ADDED]))

    return let(more, all_of)


def weak_label(c: Column) -> Column:
    """1, 0, or null where the rules say nothing."""
    plain = (c["kind"] == "number") & (c["keyword"] == 0)
    dated = c["value"].rlike(r"^(?:(?:19|20)[0-9]{2}[-.][0-9]{1,2}[-.][0-9]{1,2}|[0-9]{1,2}[-.][0-9]{1,2}[-.](?:19|20)[0-9]{2})$")
    return (F.when(c["is_base"], 1)
            .when((c["kind"] == "secret") & (c["keyword"] == 1) & (c["digits"] > 0), 1)
            .when(plain & ((c["digits"] < 9) | dated | c["value"].rlike(r"^[0-9]{1,2}(?:\.[0-9]{1,3})+$")), 0)
            .when((c["kind"] == "secret") & (c["joined"] == 1) & (c["hexadecimal"] == 0), 0)
            .when((c["kind"] == "secret") & (c["digits"] < 6), 0))


def tree_expression(node, c) -> Column:
    """A fitted tree as nested conditions over the features ``c(name)``."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    at = node.split()
    return F.when(c(FEATURES[at.featureIndex()]) <= float(at.threshold()), tree_expression(node.leftChild(), c)) \
        .otherwise(tree_expression(node.rightChild(), c))


def ranked(labelled: DataFrame) -> DataFrame:
    """``labelled`` with nth, each row's place (from 1) in its label by (h,
    FEATURES): places in ranges of h, after the rows of the ranges before."""
    bucket = F.shiftright("h", 56)
    sizes = labelled.groupBy("label", bucket.alias("bucket")).agg(F.count("*").alias("size"))
    before = sizes.select("label", "bucket", (F.sum("size").over(Window.partitionBy("label").orderBy("bucket")) - F.col("size")).alias("before"))
    nth = F.row_number().over(Window.partitionBy("label", "bucket").orderBy("h", *FEATURES)) + F.col("before")
    return labelled.withColumn("bucket", bucket).join(F.broadcast(before), ["label", "bucket"]) \
        .withColumn("nth", nth).drop("bucket", "before")


def fit(docs: DataFrame):
    """A function of c(feature) that says whether a proposal is selected (None
    when either label is absent)."""
    text = text_of()
    found = docs.select(F.explode(let(base_spans(text), lambda b: proposals(text, b))).alias("c"))
    labelled = (found.select(weak_label(F.col("c")).alias("label"), *[F.col(f"c.{n}").alias(n) for n in FEATURES])
                .where("label is not null").groupBy("label", *FEATURES).agg(F.count("*").cast("double").alias("weight"))
                .withColumn("h", F.xxhash64(*FEATURES)))
    labelled = materialize(labelled, "labelled")
    n = labelled.count()
    rows = materialize(ranked(labelled).repartition(1 + n // SAMPLE, "h").sortWithinPartitions("label", "h", *FEATURES), "proposals")
    sizes = [r["count"] for r in rows.groupBy("label").count().collect()]
    if len(sizes) < 2:
        return None
    # as many bins as keep every row among those that cut points are drawn from
    bins = BINS if n <= EXAMPLES else max(BINS, math.isqrt(n - 1) + 1)
    fold = F.col("nth") % FOLDS
    found = []
    for k in range(FOLDS):
        if k == 1 and min(sizes) == 1:      # a label's only row: nothing to learn it from
            continue
        score = learned(rows.where(fold != k), bins)
        found += (rows.where(fold == k).groupBy(F.floor(score(F.col) * 100).alias("bin"))
                  .agg(F.sum(F.col("label") * F.col("weight")).alias("pos"), F.sum("weight").alias("n")).collect())
    at = least_score(found)
    score = learned(rows, bins)
    return lambda c: score(c) >= at


def learned(rows: DataFrame, bins: int):
    """The score, a function of c(feature), of trees fitted to all of ``rows``."""
    x = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows.withColumn("y", F.col("label").cast("double")))
    model = GBTClassifier(featuresCol="x", labelCol="y", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, maxBins=bins, stepSize=0.3, seed=7).fit(x)
    trees = [t._call_java("rootNode") for t in model.trees]
    weights = model.treeWeights

    def score(c) -> Column:
        margin = F.lit(0.0)
        for w, t in zip(weights, trees, strict=True):
            margin = margin + w * tree_expression(t, c)
        return 1 / (1 + F.exp(-2 * margin))

    return score


def least_score(found) -> float:
    """The lowest of 100 thresholds whose precision holds on ``found``, rows of
    (bin of the score, pos, n); a bin may come more than once."""
    sums: dict[int, tuple[float, float]] = {}
    for r in found:
        pos, n = sums.get(r["bin"], (0, 0))
        sums[r["bin"]] = pos + r["pos"], n + r["n"]
    threshold, pos, n = 0.5, 0, 0
    for b in sorted(sums, reverse=True):
        pos, n = pos + sums[b][0], n + sums[b][1]
        if pos < PRECISION * n:
            break
        threshold = min(threshold, b / 100)
    return max(threshold, 0.05)


def free_of_base(proposed: Column, chosen) -> Column:
    """Selected proposals (start, back = -end, kind) that overlap no base span:
    the greatest end of the base spans that start before a proposal's end is
    not beyond its start."""
    marks = F.transform(
        F.filter(proposed, lambda c: c["is_base"] | chosen(lambda n: c[n])), lambda c: F.struct(
            # at equal places a proposal's end comes before a base span's start
            F.when(c["is_base"], c["start"]).otherwise(c["end"]).alias("at"), c["is_base"].alias("base"),
            c["start"].alias("start"), (-c["end"]).alias("back"), c["kind"].alias("kind")))

    def apart(m):
        reach = running_max(F.transform(m, lambda x: F.when(x["base"], -x["back"]).otherwise(F.lit(0))))
        free = let(reach, lambda r: F.filter(m, lambda x, i: ~x["base"] & (F.get(r, i) <= x["start"])))
        return F.array_sort(F.transform(free, lambda x: F.struct(x["start"], x["back"], x["kind"])))

    return let(F.array_sort(marks), apart)


def added_spans(proposed: Column, chosen) -> Column:
    """Selected proposals that overlap no base span nor an earlier choice."""
    none = "cast(array() as array<struct<kind:string,start:int,end:int>>)"

    def step(a, c):
        one = F.struct(c["kind"].alias("kind"), c["start"].alias("start"), (-c["back"]).alias("end"))
        return F.when(c["start"] >= a["at"], F.struct((-c["back"]).alias("at"), F.concat(a["out"], F.array(one)).alias("out"))) \
            .otherwise(a)

    def leftmost(order):
        # choices are appended to a block's own short list, lists to the result
        def block(a, k):
            start = F.struct(a["at"].alias("at"), F.expr(none).alias("out"))
            one = F.aggregate(F.slice(order, k * BLOCK + 1, F.lit(BLOCK)), start, step)
            return let(one, lambda o: F.struct(o["at"].alias("at"), F.concat(a["out"], F.array(o["out"])).alias("out")))

        start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{none.split(' as ')[1][:-1]}>)").alias("out"))
        numbers = F.sequence(F.lit(0), F.floor((F.size(order) - 1) / BLOCK).cast("int"))
        return F.when(F.size(order) > 0, F.flatten(F.aggregate(numbers, start, block)["out"])).otherwise(F.expr(none))

    return let(free_of_base(proposed, chosen), leftmost)


def spans(docs: DataFrame, model="fit") -> DataFrame:
    """``docs`` with ``pii_base`` (struct of the four kinds' spans) and
    ``pii_added`` (kind, start, end)."""
    chosen = fit(docs.select("text")) if model == "fit" else model
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    text = text_of()

    def both(b):
        more = none if chosen is None else let(proposals(text, b), lambda p: F.when(
            F.size(p) > 0, added_spans(p, chosen)).otherwise(none))
        return F.struct(b.alias("base"), more.alias("added"))

    docs = drop_clashing(docs, ["pii_base", "pii_added", "pii_all"])
    own = [F.col(f"`{c}`") for c in docs.columns]
    return docs.withColumn("pii_all", let(base_spans(text), both)).select(
        *own, F.col("pii_all.base").alias("pii_base"), F.col("pii_all.added").alias("pii_added"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets
    (overlapping spans become one) and n_chars, where present, brought up to
    date."""
    columns = docs.columns
    out = spans(docs)
    text = text_of()

    def placed(spans_of, kind):
        return F.transform(spans_of, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), kind(s).alias("kind")))

    def named(kind):
        return lambda s: F.lit(kind)

    every = F.concat(*[placed(F.col(f"pii_base.{k}"), named(k)) for k in KINDS],
                     placed(F.col("pii_added"), lambda s: s["kind"]))

    def replaced(all_spans):
        # a span that begins inside those before it only moves their end
        def marked(s, reach, cut):
            before = lambda i: F.coalesce(F.get(reach, i - 1), F.lit(0))
            marks = F.transform(s, lambda x, i: F.when(x["start"] < before(i), F.lit("")).otherwise(
                F.concat(part(cut, before(i), x["start"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))))
            end = F.element_at(reach, -1)
            return F.concat(F.array_join(marks, ""), part(cut, end, F.greatest(F.length(text), end)))

        return let(F.array_sort(all_spans), lambda s: let(
            running_max(F.transform(s, lambda x: x["end"])), lambda r: let(blocks(text), lambda t: marked(s, r, t))))

    new = let(every, lambda e: F.when(F.size(e) > 0, replaced(e)).otherwise(F.col("text")))
    out = out.withColumn("text", new)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[f"`{c}`" for c in columns])


def query(spark, sf_dir: str) -> DataFrame:
    found = spans(read(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(kinds, more=()):
        # sorted by kind as listed, then start
        def shown(kind, spans_of):
            return F.transform(spans_of, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

        def of(kind):
            return F.filter("pii_added", lambda s: s["kind"] == kind)

        return F.array_join(F.concat(*[shown(k, F.col(f"pii_base.{k}")) for k in kinds],
                                     *[shown(k, of(k)) for k in more]), ",")

    return found.select(
        "doc_id", *[F.size(f"pii_base.{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(KINDS), 256).alias("base_sha256"), listed(KINDS, ADDED).alias("spans"))

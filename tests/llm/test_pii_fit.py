"""The fit reads every labelled proposal."""

import pytest
from pyspark.sql import functions as F

from roadlake.llm import pii


class Seen(Exception):
    pass


def made(spark):
    """5,832 kinds of tokens (and some plain numbers) that differ in their features."""
    part = F.explode(F.sequence(F.lit(6), F.lit(23)))
    tokens = spark.range(1).select(part.alias("a")).select("a", part.alias("b")).select("a", "b", part.alias("c"))
    text = F.concat(F.lit('token: "'), F.expr("repeat('1', a)"), F.expr("repeat('x', b)"), F.expr("repeat('Y', c)"), F.lit('" on 12-3456 end'))
    return tokens.select(text.alias("text"))


def learned(spark, monkeypatch, docs, run=pii.fit):
    """Rows handed to the trees, and the trees' parameters."""
    got = {}

    class Trees:
        def __init__(self, **options):
            got.update(options)

        def fit(self, rows):
            got["rows"] = rows.collect()
            raise Seen

    tables = {}
    monkeypatch.setattr(pii, "GBTClassifier", Trees)
    monkeypatch.setattr(pii, "materialize", lambda df, name="part": tables.setdefault(name, df.cache()))
    with pytest.raises(Seen):
        run(docs)
    return got, tables["proposals"].collect()


def test_all_labelled_proposals_are_learned_from_or_held_out(spark, monkeypatch):
    got, proposals = learned(spark, monkeypatch, made(spark))
    assert sum(r.label == 1 for r in proposals) == 18 ** 3
    for y in (0, 1):
        own = sorted((r for r in proposals if r.label == y), key=lambda r: r.nth)
        assert [r.nth for r in own] == list(range(1, len(own) + 1))
        assert [r.h for r in own] == sorted(r.h for r in own)
    assert len(got["rows"]) == sum(r.nth % 4 > 0 for r in proposals)


def test_cut_points_are_drawn_from_all_rows(spark, monkeypatch):
    """Spark draws them from max(maxBins squared, 10,000) rows."""
    monkeypatch.setattr(pii, "EXAMPLES", 1000)
    monkeypatch.setattr(pii, "SAMPLE", 2000)
    got, proposals = learned(spark, monkeypatch, made(spark))
    assert got["maxBins"] ** 2 >= len(got["rows"])
    assert len(proposals) > 18 ** 3


def test_the_pipelines_stage_learns_from_all(spark, monkeypatch):
    import corpus_pipeline
    docs = made(spark).select(F.monotonically_increasing_id().alias("doc_id"), "text")
    got, proposals = learned(spark, monkeypatch, docs, lambda d: corpus_pipeline.personal_data(spark, d, ""))
    assert sum(r.label == 1 for r in proposals) == 18 ** 3 and len(got["rows"]) > 4000


def fits(monkeypatch, run):
    """Rows of every fit of the trees, and the proposals that were scored."""
    seen, real = [], pii.GBTClassifier

    class Trees:
        def __init__(self, **options):
            self.trees = real(**options)

        def fit(self, rows):
            seen.append({r.h for r in rows.select("h").collect()})
            return self.trees.fit(rows)

    counted, least = [], pii.least_score
    monkeypatch.setattr(pii, "GBTClassifier", Trees)
    monkeypatch.setattr(pii, "least_score", lambda found: counted.append(sum(r["n"] for r in found)) or least(found))
    return run(), seen, counted


def numbers(spark):
    return spark.createDataFrame([(f"on {a}-34{'5' * i} end",) for i in range(2, 5) for a in ("12", "1-2")], "text string")


def test_trees_and_threshold_come_from_all_rows(spark, monkeypatch):
    """Every proposal is held out once for the threshold; the last trees learn from all."""
    docs = made(spark).orderBy("text").limit(40).union(numbers(spark))
    chosen, seen, counted = fits(monkeypatch, lambda: pii.fit(docs))
    assert chosen is not None and len(seen) == 5
    every = seen[-1]
    assert set.union(*seen[:-1]) == every and len(every) > 40
    assert sum(len(every - s) for s in seen[:-1]) == len(every)
    assert set.union(*[every - s for s in seen[:-1]]) == every
    assert counted == [40 * 2 + 6]            # a token and a number, or a number


def test_a_labels_only_row_is_learned_from(spark, monkeypatch):
    docs = spark.createDataFrame([('token: "11111111xxxxxxxxxYYY" end',)], "text string").union(numbers(spark))
    chosen, seen, _ = fits(monkeypatch, lambda: pii.fit(docs))
    assert chosen is not None and len(seen) == 4 and len(seen[-1]) == 7


def test_least_score_adds_the_folds():
    rows = [{"bin": 90, "pos": 10, "n": 10}, {"bin": 30, "pos": 9, "n": 9}, {"bin": 30, "pos": 0, "n": 1}, {"bin": 10, "pos": 0, "n": 5}]
    assert pii.least_score(rows) == 0.3 and pii.least_score(rows[:1]) == 0.5 and pii.least_score([]) == 0.5

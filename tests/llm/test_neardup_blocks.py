"""A large group's members are not copied for its own blocks."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from roadlake.llm import neardup


def made(group, near):
    """``group`` copies with one edit each, that all link, and ``near`` copies
    with three edits each, that share buckets with them but link with none."""
    rng = np.random.default_rng(5)
    base = [f"w{rng.integers(10_000)}" for _ in range(100)]
    out = []
    for i in range(group + near):
        w = list(base)
        for at in [(i * 7) % 100] if i < group else 10 + 30 * np.arange(3) + i % 20:
            w[at] = f"edit{i}x{at}"
        out.append((i, " ".join(w)))
    return out


def test_a_groups_members_come_once_in_a_bucket_and_the_others_once_a_block(spark, monkeypatch):
    monkeypatch.setattr(neardup, "TEXT_BLOCK", 30)
    tables, write = {}, neardup.materialize
    monkeypatch.setattr(neardup, "materialize", lambda df, name="part": tables.setdefault(name, write(df, name)) if name == "involved" else write(df, name))
    docs = spark.createDataFrame(made(120, 6), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert got == {i: 0 if i < 120 else i for i in range(126)}
    rows = tables["involved"].select("band", "node", "label").collect()
    labels = Counter(r.label for r in rows)
    large = max(labels, key=labels.get)
    members = Counter((r.band, r.node) for r in rows if r.label == large)
    assert len(members) > 120 and set(members.values()) == {1}
    assert max(Counter((r.band, r.node) for r in rows if r.label != large).values()) > 1


def test_pairs_of_blocks_miss_no_pair_of_different_labels(spark, monkeypatch):
    monkeypatch.setattr(neardup, "TEXT_BLOCK", 7)
    for labels in ([1] * 40 + [2, 3, 4] * 6, [1, 2], list(range(30)), [1] * 20 + [2] * 20):
        members = spark.createDataFrame([(5, i, x) for i, x in enumerate(labels)], "band long, node long, label long")
        n, (top, c) = len(labels), Counter(labels).most_common(1)[0]
        bucket = [F.lit(n).alias("size"), F.lit(9 * n).alias("shingles"),
                  F.struct(F.lit(c).alias("c"), F.lit(9 * c).alias("s"), F.lit(top).cast("long").alias("label")).alias("top")]
        met = set()
        rows = neardup.dealt(members.select("*", *bucket)).collect()
        for key in {(r.bi, r.bj) for r in rows}:
            task = [r for r in rows if (r.bi, r.bj) == key]
            assert all(r.block in key for r in task) and len({(r.node, r.block) for r in task}) == len(task)
            met |= {frozenset((a.node, b.node)) for a in task if a.block == key[0] for b in task if b.block == key[1]}
        assert met >= {frozenset((a, b)) for a in range(n) for b in range(n) if labels[a] != labels[b]}


def test_a_small_graphs_labels_take_one_file(spark, monkeypatch):
    """Also where no partitions are merged: each file a task writes costs a process."""
    settings = {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    files, write = [], neardup.materialize

    def counted(df, name="part"):
        out = write(df, name)
        if name == "labels":
            files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(neardup, "materialize", counted)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        edges = spark.range(200).selectExpr("id as a", "id + 200 * (1 + id % 3) as b")
        label = neardup.components(edges)
        assert {(r.node, r.label) for r in label.collect()} == {(i, i) for i in range(200)} | {(i + 200 * (1 + i % 3), i) for i in range(200)}
        trees = neardup.roots(edges)
        assert {(r.node, r.label) for r in trees.collect()} == {(r.node, r.label) for r in label.collect()}
        joined = neardup.joined(label, spark.createDataFrame([(0, 1), (2, 203)], "a long, b long"))
        assert {r.label for r in joined.where("node in (0, 1, 200, 401)").collect()} == {0}
        assert files and set(files) == {1}
        monkeypatch.setattr(neardup, "LABELS", 40)
        neardup.components(edges)
        assert files[-1] > 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

"""Near-duplicate documents by b-bit MinHash.

Every document's set of five-word shingles is sketched by 240 minima. Bands
of five minima generate candidates; of each minimum only two bits are kept,
packed, and a pair's similarity is estimated from the count of equal two-bit
fields, corrected for accidental collisions. Pairs that pass the estimate are
confirmed on the full sets, and components of confirmed links are the groups.

Candidates come in four rounds, so that a large group costs a link per member
and not all its pairs:

1. every node against the smallest node it shares a bucket with: the links
   are a forest, whose trees are the first components;
2. in buckets that still span several components, every member against the
   bucket's smallest node; components again;
3. in buckets that span several even then, in blocks of bounded size, every
   member outside the block's commonest component against its best-estimated
   member of another; repeated while links are found;
4. in buckets that are still mixed, members of different components against
   each other. In a bucket of more than one block, the members outside its
   commonest component meet each other and that component's blocks (pairs of
   blocks), whose own members never meet. A pair is tested in the first bucket
   it shares, inside the block's task: members with a candidate bring their
   texts there once, and only links that join components leave it.

Rounds 3 and 4 read one table of the members of mixed buckets with their
signatures, written once.

A pair at similarity 0.75 misses all 48 bands with probability 2e-6; it falls
under the estimate's cut, or looks shared earlier by 32 equal bits of other
buckets, with probabilities below 2e-8.

Defined cases: null, empty or blank text has no shingles and links with
nothing; documents with equal sets are one node; rows with a null ``doc_id``
take part, and a group's id is its smallest non-null one (null if there is
none); repeated rows all appear; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import LOWER, U, hashed_words, materialize, mix, ngram_hashes, read, signed, text_of

SHINGLE = 5
BANDS, ROWS, BITS = 48, 5, 2
HASHES = BANDS * ROWS
ESTIMATE_CUT = 0.55
BLOCK = 4096
#: Labels in a file, at least while there are fewer files than partitions. Each
#: file that a task writes may start a process (Hadoop's local chmod).
LABELS = 50_000
#: Members and shingles of a block whose texts are compared.
TEXT_BLOCK, TEXT_SHINGLES = 1024, 1 << 20

_rng = np.random.default_rng(20240501)
_MUL = _rng.integers(0, 1 << 63, HASHES, dtype=np.int64).astype(U) * U(2) + U(1)
_ADD = _rng.integers(0, 1 << 63, HASHES, dtype=np.int64).astype(U)
_BAND_MUL = _rng.integers(0, 1 << 63, ROWS, dtype=np.int64).astype(U) * U(2) + U(1)


def shingle_set(h: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of a document's word hashes."""
    if len(h) == 0:
        return h
    return np.unique(ngram_hashes(h, min(SHINGLE, len(h))))


def minima(x: np.ndarray) -> np.ndarray:
    m = np.full(HASHES, np.iinfo(np.uint64).max, U)
    for i in range(0, len(x), 2048):
        np.minimum(m, (x[None, i:i + 2048] * _MUL[:, None] + _ADD[:, None]).min(axis=1), out=m)
    return m


def packed(m: np.ndarray) -> np.ndarray:
    """Two bits of each minimum, four to a byte (rows of 60 bytes)."""
    f = ((m >> U(32)) & U((1 << BITS) - 1)).astype(np.uint8).reshape(len(m), -1, 4)
    return f[..., 0] | f[..., 1] << 2 | f[..., 2] << 4 | f[..., 3] << 6


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures (last axis: bytes), corrected for the
    chance 2**-BITS that unequal minima agree in the kept bits."""
    d = a ^ b
    unequal = np.bitwise_count((d | d >> 1) & np.uint8(0x55)).sum(axis=-1, dtype=np.int64)
    by_chance = 2.0 ** -BITS
    return ((1 - unequal / HASHES) - by_chance) / (1 - by_chance)


def _sketch(batches):
    for batch in batches:
        ids, th = batch.column("doc_id"), batch.column("th")
        for a, b, h, rows in hashed_words(batch.column("text"), LOWER):
            n = np.zeros(b - a, np.int64)
            node = np.zeros(b - a, U)
            m = np.zeros((b - a, HASHES), U)
            for i in range(b - a):
                s = shingle_set(h[rows[i]:rows[i + 1]])
                n[i] = len(s)
                if len(s):
                    node[i] = mix(s).sum(dtype=U)      # order-free
                    m[i] = minima(s)
            node = mix(node * U(3) + n.astype(U))      # hash of the set
            keys = (m.reshape(-1, BANDS, ROWS) * _BAND_MUL).sum(axis=2, dtype=U)
            keys = signed(mix(keys + np.arange(BANDS, dtype=U) * U(0x9E3779B97F4A7C15)))
            offs = np.arange(0, (b - a + 1) * BANDS, BANDS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([
                ids.slice(a, b - a), th.slice(a, b - a), pa.array(n), pa.array(signed(node)),
                pa.array([r.tobytes() for r in packed(m)], pa.binary()),
                pa.ListArray.from_arrays(pa.array(offs), pa.array(keys.ravel())),
            ], names=["doc_id", "th", "n_shingles", "node", "sig", "bands"])


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, node (hash of the set), sig, bands."""
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("th"),
                    text_of().alias("text"))
    return t.mapInArrow(_sketch, "doc_id long, th long, n_shingles long, node long, sig binary, bands array<long>")


def _close(batches):
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(len(batch), -1)
                for c in ("sig_a", "sig_b"))
        if len(batch):
            ok = pa.array(estimate(a, b) >= ESTIMATE_CUT)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)],
                                             names=["a", "b"])


def _confirm(batches):
    """Pairs whose full sets have 100 * intersection >= 75 * union."""
    def sets(col):
        # equal neighbours (a bucket's smallest node) are hashed once
        kept, which = [], []
        for t in col.to_pylist():
            if not kept or kept[-1] != t:
                kept.append(t)
            which.append(len(kept) - 1)
        out = []
        for _, _, h, rows in hashed_words(pa.array(kept, pa.string()), LOWER):
            out += [shingle_set(h[x:y]) for x, y in zip(rows[:-1], rows[1:])]
        return [out[i] for i in which]

    for batch in batches:
        for i in range(0, len(batch), 256):
            part = batch.slice(i, 256)
            ok = []
            for x, y in zip(sets(part.column("text_a")), sets(part.column("text_b"))):
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= 75 * (len(x) + len(y) - both))
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column("a").filter(ok), part.column("b").filter(ok)],
                                             names=["a", "b"])


def links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts' full sets are similar enough."""
    ta = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    tb = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(ta, "a").join(tb, "b").select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long")


def written(labels: DataFrame, rows: int) -> DataFrame:
    """``labels``, of about ``rows`` rows, as a table of no more files than they need."""
    return materialize(labels.coalesce(1 + rows // LABELS), "labels")


def roots(parents: DataFrame) -> DataFrame:
    """node, label (root of its tree) for every node of a forest.

    ``parents`` (a, b): a is b's only parent, and a < b, so a root is its
    tree's smallest node. Every label becomes its label's label until none
    changes: rounds grow with the logarithm of the depth, and a round costs
    one join."""
    lab, n = parents.select(F.col("b").alias("node"), F.col("a").alias("label")), parents.count()
    while True:
        jump = lab.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = written(lab.join(jump, "label", "left")
                       .select("node", F.coalesce("further", "label").alias("label"),
                               F.col("further").isNotNull().alias("moved")), n)
        lab = step.select("node", "label")
        if step.where("moved").isEmpty():
            return lab.union(lab.select(F.col("label").alias("node"), "label").distinct())


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node reachable) for every node of ``edges``.

    Labels pass along edges and then jump to their label's label, until none
    changes; each round is written in the shared folder."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    n = both.count()
    lab = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), n)
    while True:
        near = (both.join(lab, both.b == lab.node).groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        step = (lab.join(near, "node")
                .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jump = lab.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = written(step.join(jump, "label", "left")
                       .select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), n)
        if step.where("old <> label").isEmpty():
            return step.select("node", "label")
        lab = step.select("node", "label")


def joined(label: DataFrame, found: DataFrame) -> DataFrame:
    """``label`` after the further links ``found``: only the labels that these
    bring together get a new one."""
    if found.isEmpty():
        return label
    own = label.select(F.col("node").alias("x"), "label")
    ends = found.select("a", "b")
    for end in ("a", "b"):
        ends = (ends.join(own, ends[end] == own.x, "left")
                .withColumn(end, F.coalesce("label", end)).select("a", "b"))
    ends = ends.where("a <> b").distinct()
    new = components(ends).toDF("old", "new")
    every = label.union(found.select("a").union(found.select("b")).distinct().toDF("node")
                        .join(label, "node", "left_anti").select("node", F.col("node").alias("label")))
    return written(every.join(new, every.label == new.old, "left")
                   .select("node", F.coalesce("new", "label").alias("label")), label.count() + found.count())


def _open_pairs(t: pa.Table, which: np.ndarray):
    """(i, members j) of one pair of blocks: ``which`` (label) differs, sizes
    and estimate pass, and this bucket is the first that i and j share. The
    caller may change ``which`` on the way."""
    side, size = (t.column(c).to_numpy() for c in ("block", "n_shingles"))
    bi, bj, here = (t.column(c)[0].as_py() for c in ("bi", "bj", "band"))
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(len(t), -1)
    keys = t.column("keys").combine_chunks().flatten().to_numpy().reshape(len(t), -1)
    right = np.flatnonzero(side == bj)
    for i in np.flatnonzero(side == bi):
        j = right[(which[right] != which[i]) & ((right > i) if bi == bj else True)]
        j = j[100 * np.minimum(size[i], size[j]) >= 75 * np.maximum(size[i], size[j])]
        j = j[estimate(sig[i][None, :], sig[j]) >= ESTIMATE_CUT]
        if len(j):
            j = j[keys[i][(keys[j] == keys[i]).argmax(axis=1)] == here >> 32]
        if len(j):
            yield i, j


def _involved(batches):
    """Rows arrive sorted by (band, bi, bj): those that have an open pair."""
    def members(t):
        has = np.zeros(len(t), bool)
        for i, j in _open_pairs(t, t.column("label").to_numpy()):
            has[i] = True
            has[j] = True
        yield from t.filter(pa.array(has)).combine_chunks().to_batches()

    yield from _by_key(batches, ["band", "bi", "bj"], members)


def _joining(batches):
    """Rows with texts arrive sorted by (band, bi, bj): links between members
    of different labels, fewer than labels that meet in the task."""
    def found(t):
        node = t.column("node").to_numpy()
        which = np.unique(t.column("label").to_numpy(), return_inverse=True)[1]
        sets = []
        for _, _, h, rows in hashed_words(t.column("text"), LOWER):
            sets += [shingle_set(h[x:y]) for x, y in zip(rows[:-1], rows[1:])]
        size = np.array([len(x) for x in sets])
        ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
        ids = np.split(ids, np.cumsum(size)[:-1])
        seen = np.zeros(sum(size), bool)
        out_a, out_b = [], []
        for i, j in _open_pairs(t, which):
            seen[ids[i]] = True
            starts = np.cumsum(size[j]) - size[j]
            both = np.add.reduceat(seen[np.concatenate([ids[k] for k in j])], starts, dtype=np.int64)
            seen[ids[i]] = False
            for k in j[100 * both >= 75 * (size[i] + size[j] - both)]:
                if which[k] != which[i]:
                    out_a.append(min(node[i], node[k]))
                    out_b.append(max(node[i], node[k]))
                    which[which == which[k]] = which[i]
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    yield from _by_key(batches, ["band", "bi", "bj"], found)


def _nearest(batches):
    """Rows arrive sorted by (band, block): every member outside the block's
    commonest label, with the best-estimated member of another label."""
    def choices(t):
        node, label = (t.column(c).to_numpy() for c in ("node", "label"))
        names, which, count = np.unique(label, return_inverse=True, return_counts=True)
        if len(names) == 1:
            return
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(len(node), -1)
        own, other, best = [], [], []
        for i in np.flatnonzero(which != np.argmax(count)):
            e = np.where(which != which[i], estimate(sig[i][None, :], sig), -1.0)
            j = int(np.argmax(e))
            if e[j] >= ESTIMATE_CUT:
                own.append(node[i])
                other.append(node[j])
                best.append(e[j])
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(other, pa.int64()), pa.array(best, pa.float64())],
                                         names=["node", "other", "estimate"])

    yield from _by_key(batches, ["band", "block"], choices)


def _by_key(batches, names, work):
    """``work`` on each run of rows with equal values of the columns ``names``."""
    held = []
    for batch in batches:
        t = pa.Table.from_batches([*held, batch])
        if len(t) == 0:
            continue
        key = np.stack([t.column(c).to_numpy() for c in names])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        edges = [0, *cuts.tolist()]
        for x, y in zip(edges[:-1], edges[1:]):
            yield from work(t.slice(x, y - x))
        held = t.slice(edges[-1]).to_batches()
    if held:
        yield from work(pa.Table.from_batches(held))


def dealt(members: DataFrame) -> DataFrame:
    """``members`` (band, node, label and their bucket's size, shingles and top:
    its commonest label with count and shingles) with block, bi and bj: a row
    for each pair of blocks that a member takes part in. A bucket of one block
    is one. In others the commonest label's blocks come last and meet those of
    the other members alone."""
    def parts(size: Column, shingles: Column) -> Column:
        return F.ceil(F.greatest(size / TEXT_BLOCK, shingles / TEXT_SHINGLES)).cast("long")

    size, shingles, top = F.col("size"), F.col("shingles"), F.col("top")
    one = parts(size, shingles) == 1
    others = F.when(one, 1).otherwise(parts(size - top["c"], shingles - top["s"]))
    apart = ~one & (F.col("label") == top["label"])
    own = F.pmod(F.xxhash64("node", "band"), F.when(apart, parts(top["c"], top["s"])).otherwise(F.col("others")))
    last = F.col("others") + F.when(one | apart, 0).otherwise(parts(top["c"], top["s"])) - 1
    return (members.withColumn("others", others).withColumn("block", F.when(apart, F.col("others")).otherwise(0) + own)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
            .withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id
    of its group), kept (doc_id = component_id), and th, first (it is the
    group's smallest (doc_id, th); th is the hash of the text)."""
    rows = materialize(sketches(docs), "sketches")
    nodes = materialize(rows.where("n_shingles > 0").groupBy("node")
                        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "th")).alias("row"),
                             F.first("sig").alias("sig"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles"))
                        .select("node", "row.doc_id", "row.th", "sig", "bands", "n_shingles"), "nodes")

    members = nodes.select("node", F.explode("bands").alias("band"))
    buckets = members.groupBy("band").agg(F.min("node").alias("center"), F.count("*").alias("size")).where("size > 1")
    members = materialize(members.join(buckets, "band"), "members")      # shared buckets only

    sig = nodes.select("node", "sig")
    wanted = members.select("node").distinct().join(nodes.select("node", "doc_id", "th"), "node")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("th"),
                        text_of().alias("text"))
    texts = texts.alias("t").join(wanted.alias("w"), F.expr("t.th = w.th and t.doc_id <=> w.doc_id")) \
        .select("w.node", "t.text").dropDuplicates(["node"])
    texts = materialize(texts, "texts")

    def close(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose estimate passes."""
        return materialize(pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
                           .mapInArrow(_close, "a long, b long"), "close")

    def mixed(label: DataFrame) -> DataFrame:
        """Members, with their labels, of the buckets that span several."""
        own = members.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        spans = own.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
        return materialize(own.join(spans.select("band"), "band", "left_semi"), "mixed")

    # 1. each node against the smallest node of all its buckets
    tested = close(members.where("node <> center").groupBy(F.col("node").alias("b")).agg(F.min("center").alias("a")).select("a", "b"))
    label = roots(materialize(links(tested, texts), "links"))

    # 2. in buckets of several components, members against the smallest node
    member = mixed(label)
    first = member.groupBy("band").agg(F.min(F.struct("node", "label")).alias("f")).select("band", F.col("f.node").alias("a"), F.col("f.label").alias("other"))
    star = member.join(first, "band").where("label <> other").select("a", F.col("node").alias("b")).distinct()
    star = close(star.join(tested, ["a", "b"], "left_anti"))
    tested = tested.union(star)
    label = joined(label, materialize(links(star, texts), "links"))

    # of the buckets that stay mixed, the members and all that is compared
    # (a key's upper half is enough to tell the first bucket that two share)
    keys = nodes.select("node", "n_shingles", "sig", F.transform("bands", lambda k: F.shiftright(k, 32).cast("int")).alias("keys"))
    unsettled = materialize(mixed(label).where("size > 2").select("band", "node").join(keys, "node"), "unsettled")

    def spanning(label: DataFrame) -> DataFrame:
        """``unsettled`` with labels, of the buckets that span several."""
        own = unsettled.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        spans = own.groupBy("band", "label").agg(F.count("*").alias("c"), F.sum("n_shingles").alias("s")) \
            .groupBy("band").agg(F.sum("c").alias("size"), F.sum("s").alias("shingles"),
                                 F.max(F.struct("c", "s", "label")).alias("top"), F.count("*").alias("labels"))
        return own.join(spans.where("labels > 1").drop("labels"), "band")

    # 3. members outside their block's commonest label, against the nearest other
    while True:
        near = (spanning(label).withColumn("block", F.pmod(F.xxhash64("node", "band"), F.ceil(F.col("size") / BLOCK).cast("long")))
                .select("band", "block", "node", "label", "sig")
                .repartition("band", "block").sortWithinPartitions("band", "block")
                .mapInArrow(_nearest, "node long, other long, estimate double")
                .groupBy("node").agg(F.max_by("other", F.struct("estimate", "other")).alias("other")))
        near = near.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        near = materialize(near.join(tested, ["a", "b"], "left_anti"), "near")
        found = materialize(links(near, texts), "links")
        tested = tested.union(near)
        if found.isEmpty():
            break
        label = joined(label, found)

    # 4. in buckets that still span several, their other pairs
    shape = "band long, bi long, bj long, block long, node long, label long, n_shingles long, sig binary, keys array<int>"
    names = [x.split()[0] for x in shape.split(", ")]
    member = (dealt(spanning(label)).select(*names)
              .repartition("band", "bi", "bj").sortWithinPartitions("band", "bi", "bj").mapInArrow(_involved, shape))
    rest = (materialize(member, "involved").join(texts, "node").select(*names, "text")
            .repartition("band", "bi", "bj").sortWithinPartitions("band", "bi", "bj")
            .mapInArrow(_joining, "a long, b long").distinct())
    label = joined(label, materialize(rest, "links"))

    rows = rows.select("doc_id", "th", "n_shingles", "node").join(label, "node", "left") \
        .withColumn("label", F.when(F.col("n_shingles") > 0, F.coalesce("label", "node")))
    # of nodes, and written: the join by label then splits a large group's rows
    least = F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "th")).alias("least")
    groups = materialize(nodes.select("node", "doc_id", "th").join(label, "node", "left")
                         .groupBy(F.coalesce("label", "node").alias("label")).agg(least), "groups")
    out = rows.join(groups, "label", "left")
    alone = F.col("label").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), "th",
        (alone | (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("th") == F.col("least.th")))).alias("first"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest doc_id
    (then text hash). Rows without words link with nothing, but of rows equal
    in doc_id and text one stays."""
    keep = near_duplicates(docs).where("first").select(F.col("doc_id").alias("keep_id"), F.col("th").alias("keep_th")).distinct()
    d = docs.alias("d")
    out = d.join(keep, F.expr("xxhash64(coalesce(cast(d.text as string), '')) = keep_th and cast(d.doc_id as bigint) <=> keep_id"))
    name = "keep_th"
    return out.dropDuplicates(["keep_id", name]).select("d.*")


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_shingles", "component_id", "kept")

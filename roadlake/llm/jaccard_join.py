"""N-gram Jaccard join by vertical partitioning.

Documents are sets of word 4-grams (64-bit hashes), equal sets are one node.
The global order of n-grams is that of their hashes; it is cut into fragments,
every set thereby into segments, and the fragments are counted one by one.

1. *Private n-grams.* Each fragment counts, for every node, the n-grams that
   no other node holds; the counts are summed per node. A node whose other
   n-grams are less than ``limit`` per cent of its set links with nothing: it
   leaves. Nodes go in deals, each a list of nodes and, a fragment, their
   n-grams with 16-bit owners; counts return by deal, packed likewise. A deal
   sends an n-gram that several of its nodes hold once, as shared, so n-grams
   of very many documents cost a place a deal. (Here hashes are cut to 32 bits
   below the fragment's number, and copies in two deals pass for two nodes;
   both can only keep a node too long.)
2. *Candidate groups.* With the rarest n-grams first (ties by hash), two
   linked sets share one of the first n - ceil(limit * n / 100) + 1 n-grams of
   either. Nodes that share such n-grams, directly or by others, form a group,
   found by one link of every node to the n-gram's smallest node. A node's
   private n-grams come first and link nothing, so a passage that many
   documents share makes no group of them.
3. *Partial overlaps.* A group's nodes meet in pairs of blocks. There the
   order of the n-grams that at least two of the block's nodes hold is cut
   into fragments again: each gives the partial overlaps of all pairs of the
   task (frequent n-grams by a product of 0/1 matrices, rare ones by their
   pairs), and partial overlaps are summed per pair. 100 * overlap >= limit *
   union is exact, on whole sets. Pairs do not leave the task: per node its
   number of links, and one link to its local component.
4. Components of these links.

A large group of copies is one node; one of near copies costs a block's
product for all pairs of 1,024 nodes, and a node is sent once for each block
of its group.

Defined cases: null, empty or blank texts have no n-grams, link with nothing
and are their own component; with fewer than four words the whole sequence is
the one n-gram; rows with a null ``doc_id`` take part, and a component's id is
its smallest non-null one (null if there is none); repeated rows all appear
and link with each other; other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import LOWER, U, hashed_words, materialize, mix, ngram_hashes, read, signed, text_of
from roadlake.llm.neardup import _by_key, components

NGRAM, LIMIT = 4, 85
#: About so many n-grams make a fragment, and so many are dealt at a time.
FRAGMENT, DEAL = 1 << 22, 1 << 19
#: Nodes of a block, n-grams of a fragment of its order, and the number of
#: nodes from which an n-gram's overlaps are counted by a matrix product.
BLOCK, COLUMNS, FREQUENT = 1024, 2048, 24
#: Most rows (of four longs) that are broadcast.
BROADCAST = 1 << 20
#: Most nodes of a deal (its owners are 16-bit numbers).
NODES = 65535


def ngram_set(h: np.ndarray) -> np.ndarray:
    """Sorted distinct n-gram hashes of a document's word hashes."""
    return np.unique(ngram_hashes(h, min(NGRAM, len(h)))) if len(h) else h


def node_of(grams: np.ndarray) -> int:
    """Hash of a set."""
    return int(mix(mix(grams).sum(dtype=U, keepdims=True) * U(3) + U(len(grams))).view(np.int64)[0])


def _sets(column):
    """The n-gram set of each row's text."""
    for _, _, h, rows in hashed_words(column, LOWER):
        for x, y in zip(rows[:-1], rows[1:]):
            yield ngram_set(h[x:y])


def _sizes(batches):
    for batch in batches:
        found = [(len(s), node_of(s)) for s in _sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), *(pa.array(c, pa.int64()) for c in zip(*found))]
                                         if found else [pa.array([], pa.int64())] * 4, names=["doc_id", "th", "n_shingles", "node"])


def _segments(sets: dict, bits: int):
    """One row for each fragment: its n-grams (32 bits of each hash below the
    fragment's number) and their owners, as places in the deal's list of nodes
    (the place after the last: several nodes). Owners are a list, or the n-grams
    are sorted by owner and counted, whichever is shorter. One of the rows
    brings the list of nodes."""
    nodes = np.fromiter(sets, np.int64, len(sets))
    grams = np.concatenate(list(sets.values()))
    owner = np.repeat(np.arange(len(nodes), dtype=np.uint16), [len(s) for s in sets.values()])
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    first = np.flatnonzero(new)
    several = np.diff(np.append(first, len(grams))) > 1
    grams, owner = grams[first], np.where(several, np.uint16(len(nodes)), owner[first])
    fragment = (grams >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(grams), np.int64)
    short = (grams << U(bits) >> U(32)).astype(np.uint32)
    deal = int(mix(nodes.view(U)).sum(dtype=U).view(np.int64))
    starts = np.flatnonzero(np.diff(fragment, prepend=-1))
    bearer = deal % len(starts)
    out = []
    for i, (x, y) in enumerate(zip(starts, np.append(starts[1:], len(grams)))):
        own, lengths = owner[x:y], None
        part = short[x:y]
        if 2 * (len(nodes) + 1) < y - x:
            part, own, lengths = part[np.argsort(own, kind="stable")], None, np.bincount(own, minlength=len(nodes) + 1).astype(np.uint32)
        out.append((int(fragment[x]), deal, nodes.tobytes() if i == bearer else None, len(nodes),
                    None if own is None else own.tobytes(), None if lengths is None else lengths.tobytes(), part.tobytes()))
    types = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                      names=["fragment", "deal", "nodes", "n", "owners", "lengths", "grams"])


def _deal(batches, bits: int):
    held, n = {}, 0
    for batch in batches:
        for s in _sets(batch.column("text")):
            if len(s) and (node := node_of(s)) not in held:
                held[node] = s
                n += len(s)
                if n >= DEAL or len(held) == NODES:
                    yield _segments(held, bits)
                    held, n = {}, 0
    if held:
        yield _segments(held, bits)


def _private(batches):
    """Rows arrive sorted by fragment: to each, the owners of its n-grams that
    no other deal has and no second node of its own (once for each n-gram)."""
    def counted(t):
        size = t.column("n").to_pylist()
        owners = [np.frombuffer(x, np.uint16) if x is not None else np.repeat(np.arange(n + 1), np.frombuffer(y, np.uint32)).astype(np.uint16)
                  for x, y, n in zip(t.column("owners").to_pylist(), t.column("lengths").to_pylist(), size)]
        grams = np.concatenate([np.frombuffer(x, np.uint32) for x in t.column("grams").to_pylist()])
        order = np.argsort(grams, kind="stable")
        grams = grams[order]
        alone = np.ones(len(grams), bool)
        alone[1:] &= grams[1:] != grams[:-1]
        alone[:-1] &= grams[1:] != grams[:-1]
        private = np.zeros(len(grams), bool)
        private[order[alone]] = True
        end = np.cumsum([len(x) for x in owners])
        own = [x[private[e - len(x):e] & (x != n)] for x, e, n in zip(owners, end, size)]
        yield pa.RecordBatch.from_arrays([t.column("deal").combine_chunks(), t.column("nodes").combine_chunks(), *_counted(own, size)],
                                         names=["deal", "nodes", "counts", "owners"])

    yield from _by_key(batches, ["fragment"], counted)


def _counted(own: list, n: list):
    """Owners as a list, or as counts of all of them, whichever is shorter."""
    full = [len(x) > k for x, k in zip(own, n)]
    counts = [np.bincount(x, minlength=k).astype(np.uint16).tobytes() if f else None for x, k, f in zip(own, n, full)]
    return pa.array(counts, pa.binary()), pa.array([None if f else x.tobytes() for x, f in zip(own, full)], pa.binary())


def _summed(batches):
    """Rows arrive sorted by deal: each of its nodes with its private n-grams."""
    def total(t):
        nodes = np.frombuffer(next(x for x in t.column("nodes").to_pylist() if x is not None), np.int64)
        n = np.zeros(len(nodes), np.int64)
        for counts, owners in zip(t.column("counts").to_pylist(), t.column("owners").to_pylist()):
            if counts is not None:
                n += np.frombuffer(counts, np.uint16)
            else:
                n += np.bincount(np.frombuffer(owners, np.uint16), minlength=len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(n)], names=["node", "private"])

    yield from _by_key(batches, ["deal"], total)


def _grams(batches):
    for batch in batches:
        sets = list(_sets(batch.column("text")))
        offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
        flat = signed(np.concatenate([np.empty(0, U), *sets]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("weight"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
            names=["node", "weight", "grams"])


def overlaps(sets: list, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``sets[i]`` (i in left) and ``sets[j]``
    (j in right): partial overlaps of the fragments of their n-grams' order,
    summed per pair."""
    size = np.array([len(s) for s in sets])
    _, gram, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size)
    shared = held[gram] > 1
    gram, owner = gram[shared], owner[shared]
    order = np.argsort(gram, kind="stable")
    gram, owner, held = gram[order], owner[order], held[gram[order]]
    total = np.zeros((len(left), len(right)), np.int64)
    row, col = (np.full(len(sets), -1) for _ in range(2))
    row[left], col[right] = np.arange(len(left)), np.arange(len(right))
    # frequent n-grams: fragments of COLUMNS of them as 0/1 matrices
    often = held > FREQUENT
    g, o = np.unique(gram[often], return_inverse=True)[1], owner[often]
    for a in range(0, int(g.max(initial=-1)) + 1, COLUMNS):
        x, y = np.searchsorted(g, [a, a + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[o[x:y], g[x:y] - a] = 1
        total += (part[left] @ part[right].T).astype(np.int64)
    # rare ones: each with the next ones of its n-gram, to the last
    g, o = gram[~often], owner[~often]
    for step in range(0, FREQUENT):
        same = np.ones(len(g), bool) if step == 0 else g[step:] == g[:-step]
        if not same.any():
            break
        i, j = (o, o) if step == 0 else (o[:-step][same], o[step:][same])
        for p, q in ((i, j), (j, i))[:1 if step == 0 else 2]:
            ok = (row[p] >= 0) & (col[q] >= 0)
            np.add.at(total, (row[p[ok]], col[q[ok]]), 1)
    return total


def _links(batches, limit: int):
    """Rows arrive sorted by (label, bi, bj): for each member with links in the
    pair of blocks, the smallest node of its local component and its number of
    links."""
    def found(t):
        if len(t) < 2:
            return
        node, weight, block = (t.column(c).to_numpy() for c in ("node", "weight", "block"))
        bi, bj = (t.column(c)[0].as_py() for c in ("bi", "bj"))
        left, right = np.flatnonzero(block == bi), np.flatnonzero(block == bj)
        if not len(left) or not len(right):
            return
        grams = t.column("grams").combine_chunks()
        offsets = grams.offsets.to_numpy()
        flat = grams.values.to_numpy()
        sets = [flat[x:y] for x, y in zip(offsets[:-1], offsets[1:])]
        size = np.array([len(s) for s in sets])
        both = overlaps(sets, left, right)
        link = 100 * both >= limit * (size[left][:, None] + size[right][None, :] - both)
        link &= node[left][:, None] != node[right][None, :]
        n = np.zeros(len(t), np.int64)
        n[left] += link @ weight[right]
        if bi != bj:
            n[right] += weight[left] @ link
        root = np.arange(len(t))
        done = np.zeros(len(t), bool)
        for i in left[link.any(axis=1)]:
            if not done[i]:
                member = np.zeros(len(t), bool)
                member[i] = True
                while True:                                # grow the component from both sides
                    grown = member.copy()
                    grown[right] |= link[member[left]].any(axis=0)
                    grown[left] |= link[:, member[right]].any(axis=1)
                    if (grown == member).all():
                        break
                    member = grown
                done |= member
                own = np.flatnonzero(member)
                root[own] = own[np.argmin(node[own])]
        has = np.flatnonzero(n > 0)
        yield pa.RecordBatch.from_arrays([pa.array(node[root[has]]), pa.array(node[has]), pa.array(n[has])], names=["a", "b", "links"])

    yield from _by_key(batches, ["label", "bi", "bj"], found)


def ngram_join(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id
    reachable by links), n_links (documents that it is linked with)."""
    whole = lambda x: F.lit(x).cast("long")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("th"), text_of().alias("text"))
    rows = materialize(docs.mapInArrow(_sizes, "doc_id long, th long, n_shingles long, node long"), "sets")
    nodes = materialize(rows.where("n_shingles > 0").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "th")).alias("row"), F.first("n_shingles").alias("n"),
        F.count("*").alias("weight")).select("node", "n", "weight", "row.doc_id", "row.th"), "nodes")
    grams = nodes.agg(F.sum("n")).first()[0] or 0
    bits = min(32, max(0, int(grams // FRAGMENT).bit_length()))

    # 1. nodes with enough n-grams that others have
    dealt = docs.select("text").mapInArrow(lambda b: _deal(b, bits), "fragment long, deal long, nodes binary, n long, owners binary, lengths binary, grams binary")
    private = (dealt.repartition(1 << bits, "fragment").sortWithinPartitions("fragment")
               .mapInArrow(_private, "deal long, nodes binary, counts binary, owners binary")
               .repartition("deal").sortWithinPartitions("deal").mapInArrow(_summed, "node long, private long")
               .groupBy("node").agg(F.sum("private").alias("private")))
    left = materialize(nodes.join(private, "node", "left")
                       .where(100 * (F.col("n") - F.coalesce("private", whole(0))) >= limit * F.col("n")).drop("private"), "left")

    # 2. their sets, and groups that share one of their first n-grams
    same = F.expr("t.th = w.th and t.doc_id <=> w.doc_id")
    wanted = left.select("node", "weight", "doc_id", "th")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST else wanted      # else the texts are shuffled once
    texts = docs.alias("t").join(wanted.alias("w"), same).select("w.node", "w.weight", "t.text").dropDuplicates(["node"])
    sets = materialize(texts.mapInArrow(_grams, "node long, weight long, grams array<long>"), "grams")
    held = sets.select("node", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    shared = held.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1")
    ranked = (held.join(shared, "gram").groupBy("node").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("c", "gram"))).alias("by_rank")))
    least = F.expr(f"(n * {int(limit)} + 99) div 100")                  # private n-grams have come before
    ranked = ranked.withColumn("most", F.size("by_rank") - least + 1).where("most > 0")
    first = materialize(ranked.select("node", F.explode(F.expr("slice(by_rank, 1, int(most))")).alias("g"))
                        .select("node", F.col("g.gram").alias("gram")), "first")
    centers = first.groupBy("gram").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("gram", "a")
    edges = first.join(centers, "gram").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    group = components(edges)

    # 3. partial overlaps within each group, by pairs of blocks
    sized = group.join(group.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).alias("n")), "label")
    member = (sized.withColumn("block", F.pmod(F.xxhash64("node"), F.col("n")))
              .withColumn("other", F.explode(F.sequence(whole(0), F.col("n") - 1)))
              .select("label", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block", "node"))
    links = materialize(member.join(sets.select("node", "weight", "grams"), "node")
                        .repartition("label", "bi", "bj").sortWithinPartitions("label", "bi", "bj")
                        .mapInArrow(lambda b: _links(b, limit), "a long, b long, links long"), "links")

    # 4. components of the links
    label = components(links.where("a <> b").select("a", "b"))
    count = links.groupBy(F.col("b").alias("node")).agg(F.sum("links").alias("links"))
    known = materialize(nodes.join(label, "node", "left").join(count, "node", "left")
                        .select("node", "doc_id", F.coalesce("label", "node").alias("label"),
                                (F.col("weight") - 1 + F.coalesce("links", whole(0))).alias("n_links")), "known")
    smallest = known.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    known = materialize(known.join(smallest, "label").select("node", "component_id", "n_links"), "components")
    out = rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node")).join(known, "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.coalesce("n_links", whole(0)).alias("n_links"))


def query(spark, sf_dir: str) -> DataFrame:
    return ngram_join(read(spark, sf_dir, "documents").select("doc_id", "text"))


#: Exact: intersections from a join on n-grams, components by repeated reach.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS g
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), reach AS (
  SELECT a AS doc_id, a AS r FROM both_ways
  UNION
  SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a
), c AS (
  SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id
), l AS (
  SELECT a AS doc_id, count(*) AS n_links FROM both_ways GROUP BY a
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.r, w.doc_id) AS component_id, coalesce(l.n_links, 0) AS n_links
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)
"""

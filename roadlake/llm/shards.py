"""Sharding by sampled splitters. DataFrame functions only.

Records are ordered by a key (a hash of the text, then doc_id, so equal texts
lie together). A sample drawn with a chance in proportion to each record's
share of all bytes and of all rows gives splitters at its quantiles; they cut
the key range into pieces of nearly equal size. The bytes and rows of every
piece are then counted over all records, a piece that is still too large (one
key's repeats) is subdivided, and running totals, inside the pieces and over
them, give each record's place in bytes and rows. Shard ``k`` holds the records that begin in the k-th of equal
parts of all bytes: law ``bytes``, shard sizes differ by less than the largest
record or so. Slots count rows from 0 in each shard.

The sample's expected size (``SAMPLE``) and the number of pieces are fixed, so
what reaches the driver does not grow with the table.

Defined cases: a null text has size 1; null doc_ids come first among equal
texts; records equal in text and doc_id are interchangeable and spread over
the pieces' subdivisions; an empty table gives no rows; other columns are
carried along, clashing result columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadlake.llm.common import drop_clashing, materialize, read, text_of

SHARDS = 8
SAMPLE = 20_000
PIECES = 512
LEAST_ID = -(1 << 63)
RESULT = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with size, text_crc32 and the key (k_text, k_id)."""
    text = text_of()
    return drop_clashing(docs, [*RESULT, "k_text", "k_id"]).withColumns({
        "size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text.cast("binary")),
        "k_text": F.md5(text.cast("binary")), "k_id": F.col("doc_id").cast("long")})


def splitters(rows: DataFrame) -> list[tuple[str, int]]:
    """Quantiles of a weighted sample of (k_text, k_id)."""
    n, total = rows.agg(F.count("*"), F.sum("size")).first()
    if not n:
        return []
    chance = SAMPLE / 2 * (F.col("size") / float(total) + 1.0 / n)
    # a hash of the record stands for the random draw: the same in every attempt
    draw = F.pmod(F.xxhash64("k_text", "k_id", F.lit("draw")), F.lit(1 << 40)) / float(1 << 40)
    got = sorted(map(tuple, rows.where(draw < chance).select("k_text", F.coalesce("k_id", F.lit(LEAST_ID))).distinct().collect()))
    pieces = min(PIECES, len(got))
    return [got[i * len(got) // pieces] for i in range(1, pieces)]


def piece_of(cuts: list[tuple[str, int]]):
    """Column: how many splitters are not above the record's key (binary search)."""
    if not cuts:
        return F.lit(0)
    table = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).cast("long").alias("i")) for t, i in cuts])
    widths = [1 << b for b in reversed(range(len(cuts).bit_length()))]
    own_id = F.coalesce("k_id", F.lit(LEAST_ID).cast("long"))

    def step(at, w):
        cut = F.get(table, at + w - 1)
        fits = (cut["t"] < F.col("k_text")) | ((cut["t"] == F.col("k_text")) & (cut["i"] <= own_id))
        return F.when(F.coalesce(fits, F.lit(False)), at + w).otherwise(at)

    return F.aggregate(F.array(*[F.lit(w) for w in widths]), F.lit(0), step)


def assign(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows of ``keyed`` with law, shard, slot, grown_shard."""
    spark = rows.sparkSession
    # written: the positions below must not change when a task is run again
    rows = materialize(rows.withColumn("piece", piece_of(splitters(rows))), "pieces")
    counts = {r[0]: r[1] for r in rows.groupBy("piece").count().collect()}          # at most PIECES rows
    fair = sum(counts.values()) / max(1, len(counts))
    part = F.lit(0)
    if many := [F.lit(x) for p, n in sorted(counts.items()) if n > 4 * fair for x in (p, int(n // fair) + 1)]:
        dealt = F.pmod(F.monotonically_increasing_id(), F.element_at(F.create_map(*many), F.col("piece")).cast("long"))
        part = F.coalesce(dealt.cast("int"), F.lit(0))
    rows = materialize(rows.withColumn("part", part), "parts")

    totals = sorted(map(tuple, rows.groupBy("piece", "part").agg(F.sum("size"), F.count("*")).collect()))
    before, n_before, offsets = 0, 0, []
    for p, q, size, n in totals:
        offsets.append((p, q, before, n_before))
        before, n_before = before + size, n_before + n
    offsets = spark.createDataFrame(offsets, "piece int, part int, bytes_before long, rows_before long")

    run = W.partitionBy("piece", "part").orderBy("k_text", "k_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rows.withColumn("run_bytes", F.sum("size").over(run)).withColumn("run_rows", F.count("*").over(run))
    placed = placed.join(F.broadcast(offsets), ["piece", "part"])
    start = F.col("bytes_before") + F.col("run_bytes") - F.col("size")
    placed = materialize(
        placed.withColumn("shard", F.floor(start.cast("decimal(38,0)") * shards / F.lit(max(1, before)).cast("decimal(20,0)")).cast("int"))
        .withColumn("place", F.col("rows_before") + F.col("run_rows") - 1)
        .drop("piece", "part", "run_bytes", "run_rows", "bytes_before", "rows_before"), "placed")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))              # one row a shard
    return (placed.join(F.broadcast(first), "shard")
            .withColumns({"law": F.lit("bytes"), "slot": F.col("place") - F.col("first"), "grown_shard": F.lit(None).cast("int")})
            .drop("place", "first", "k_text", "k_id"))


def query(spark, sf_dir: str) -> DataFrame:
    rows = keyed(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return assign(rows).select("doc_id", *RESULT)


def oracle() -> str:
    """The same order and running totals as one window over all records."""
    import zlib
    # state change of a byte, from the checksums of single bytes
    step = [zlib.crc32(bytes([255 ^ i])) ^ 0xFF000000 for i in range(256)]
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), b AS (
  SELECT doc_id, t, octet_length(encode(t)) + 1 AS size, md5(t) AS h,
         list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes
  FROM d
), c AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
         lambda a, x: xor(a >> 8, CAST({step} AS BIGINT[])[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM b
), w AS (
  SELECT doc_id, size::BIGINT AS size, text_crc32,
         sum(size) OVER (ORDER BY h, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS start,
         row_number() OVER (ORDER BY h, doc_id NULLS FIRST) AS place, sum(size) OVER () AS total
  FROM c
), s AS (
  SELECT *, floor(start::DECIMAL(38,0) * {SHARDS} / total)::INT AS shard FROM w
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       place - min(place) OVER (PARTITION BY shard) AS slot, NULL::INT AS grown_shard
FROM s
"""

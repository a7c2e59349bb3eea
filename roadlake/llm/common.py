"""Helpers shared by the operators: intermediate tables, Arrow column
conversion, and vectorised word hashing.

A *word* is a maximal run of characters other than space and ``\\t\\n\\v\\f\\r``.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"
U = np.uint64
#: Odd multipliers of the polynomial hashes (arbitrary fixed values).
BYTE_BASE = 0x9E6C63D0676A9A99
WORD_BASE = 0xD6E8FEB86659FD93
#: Most bytes of text that are hashed at a time (one longer text is hashed alone).
SLICE_BYTES = 1 << 21


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(col: str | Column = "text") -> Column:
    """The text as a string; null is the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def materialize(df: DataFrame, name: str = "part") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, survives lost executors. The folder goes when the application
    ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that clash with none of ``df``'s (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def drop_clashing(df: DataFrame, names) -> DataFrame:
    """``df`` without columns that an operator is about to add."""
    gone = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in gone])


# --- vectorised hashing over Arrow string columns ---------------------------

def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64 (short tables are kept)."""
    p = _powers.get(base)
    if p is None or len(p) < n:
        p = np.full(max(n, 1 << 16), base, U)
        p[0] = 1
        p = np.cumprod(p, dtype=U)
        if n <= SLICE_BYTES + 1:
            _powers[base] = p
    return p[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value (splitmix64 steps)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: As LOWER, with every ASCII character but letters and digits as a space.
PLAIN = np.array([c if c > 127 or chr(c).isalnum() else 32 for c in range(256)], np.uint8)[LOWER]
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string or binary column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        width = np.int64
    else:
        width = np.int32
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, width)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return b[o[0]:o[-1]], o - o[0]


def slices(offsets: np.ndarray):
    """(first row, end row) of runs of rows of about SLICE_BYTES bytes."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, "right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """Start and end byte of every word, and the words before each row (n + 1)."""
    space = SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True                      # a row's border also ends a word
    first = first[:-1]
    before = np.empty(len(data), bool)
    before[:1] = True
    before[1:] = space[:-1]
    starts = np.flatnonzero(~space & (before | first))
    after = np.empty(len(data), bool)
    after[-1:] = True
    after[:-1] = space[1:] | first[1:]
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    p = powers(BYTE_BASE, len(data))
    total = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * p, dtype=U, out=total[1:])
    back = powers(_inverse(BYTE_BASE), len(data))
    return mix((total[ends] - total[starts]) * back[starts])


def hashed_words(col: pa.Array, fold: np.ndarray | None = None):
    """For slices of a string column: (first row, end row, hash of each word,
    words before each row of the slice). ``fold`` maps bytes (LOWER, PLAIN)."""
    data, offsets = utf8(col)
    for a, b in slices(offsets):
        part = data[offsets[a]:offsets[b]]
        part = part if fold is None else fold[part]
        starts, ends, rows = word_spans(part, offsets[a:b + 1] - offsets[a])
        yield a, b, word_hashes(part, starts, ends), rows


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive values of ``h`` (row borders ignored)."""
    if len(h) < n:
        return np.empty(0, U)
    total = np.zeros(len(h) + 1, U)
    np.cumsum(h * powers(WORD_BASE, len(h)), dtype=U, out=total[1:])
    return mix((total[n:] - total[:-n]) * powers(_inverse(WORD_BASE), len(h) - n + 1) + U(n))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def schema_with(df: DataFrame, ddl: str) -> str:
    """DDL of ``df``'s columns followed by ``ddl``."""
    own = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return f"{own}, {ddl}" if own else ddl

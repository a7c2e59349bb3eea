"""File scans: landing JSON lines, whole snapshot documents, zone tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_landing_lines(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited JSON landing files (plain or gzip) at any folder
    depth under ``path`` -> one row per line, column ``value``.

    gzip is decoded by file suffix and is not splittable, so parallelism is
    the number of files; downstream operators are narrow until their first
    shuffle, which re-spreads the rows."""
    return (spark.read.option("recursiveFileLookup", "true")
            .text(path).select("value"))


def read_landing_range(spark: SparkSession, path: str, since=None, until=None) -> DataFrame:
    """Landing lines that arrived in ``since`` <= hour < ``until`` (timestamps
    or ISO text, UTC; None: open end), as :func:`read_landing_lines`.

    The arrival folders ``y=/m=/d=/h=`` are partition columns here and the
    range is a filter on them alone, so only the files of its hours are read."""
    parts = ("y", "m", "d", "h")
    lines = spark.read.text(path)
    if not set(parts) <= set(lines.columns):
        raise ValueError(f"{path} has no arrival folders {'/'.join(p + '=' for p in parts)}")
    at = F.make_timestamp(*[F.col(p).cast("int") for p in parts], F.lit(0), F.lit(0))
    if since is not None:
        lines = lines.where(at >= F.lit(since).cast("timestamp"))
    if until is not None:
        lines = lines.where(at < F.lit(until).cast("timestamp"))
    return lines.select("value")


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Whole feed snapshot documents (one JSON/GeoJSON/XML document per file)
    -> ``snapshot`` (file path), ``snapshot_ms`` (file modification time,
    epoch ms), ``value`` (document text).  One task reads one document; a file
    of no bytes gives none."""
    df = (spark.read.option("recursiveFileLookup", "true")
          .option("wholetext", "true").text(path))
    return df.select(
        F.col("_metadata.file_path").alias("snapshot"),
        F.unix_millis(F.col("_metadata.file_modification_time")).alias("snapshot_ms"),
        "value")


def read_table(spark: SparkSession, path_or_name: str,
               schema: StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """A clean/curated zone table: catalog name or folder path.

    With a path, an explicit schema avoids inference and keeps the string
    partition key ``dt`` a string (inference would make it a date)."""
    if "/" not in path_or_name and ":" not in path_or_name:
        return spark.table(path_or_name)
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path_or_name)

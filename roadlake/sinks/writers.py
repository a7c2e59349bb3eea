"""Zone writers: landing JSON lines, partitioned Parquet tables, CSV export,
catalog registration.

Write modes:

* ``replace_partitions`` (default for clean tables and summaries): dynamic
  partition overwrite — a re-run replaces exactly the days it produced and
  leaves the others, so re-runs are idempotent;
* ``overwrite``: replace the whole table (latest-state tables);
* ``append``: add files (snapshot history).

Before a partitioned write the rows are rebalanced on the partition columns
(``REBALANCE`` hint): AQE sizes the write tasks from runtime statistics and
splits an oversized (skewed) day across several tasks instead of funnelling
it through one, so files stay few per partition without a hot-day straggler.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.session import shared_dir

MODES = {"replace_partitions": "overwrite", "overwrite": "overwrite", "append": "append"}


def run_folder(spark: SparkSession, kind: str = "run") -> str:
    """A fresh folder for one run under the shared (checkpoint) directory."""
    return f"{shared_dir(spark)}/roadlake/{kind}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, partition_by=("dt",),
                mode: str = "replace_partitions", fmt: str = "parquet",
                rebalance: bool = True) -> None:
    """Write a zone table, partitioned by ``partition_by``."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {sorted(MODES)}")
    parts = list(partition_by or [])
    if parts and rebalance:
        df = df.hint("rebalance", *parts)
    w = df.write.format(fmt).mode(MODES[mode])
    if parts:
        w = w.partitionBy(*parts)
    if mode == "replace_partitions":
        w = w.option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        w = w.option("partitionOverwriteMode", "static")
    w.save(path)


def write_landing(records: DataFrame, path: str, arrival_ms=None,
                  compression: str = "gzip", mode: str = "append") -> None:
    """Landing sink: one JSON line per record, gzip text files laid out by
    arrival time ``y=/m=/d=/h=`` (the delivery layout).

    ``arrival_ms`` is the arrival stamp (epoch ms column or constant); by
    default the records' ``ingest_ts`` or ``ts``, else now."""
    if arrival_ms is None:
        cols = records.columns
        arrival_ms = (F.col("ingest_ts") if "ingest_ts" in cols else
                      F.col("ts") if "ts" in cols else
                      F.unix_millis(F.current_timestamp()))
    elif not hasattr(arrival_ms, "alias"):
        arrival_ms = F.lit(int(arrival_ms))
    at = F.timestamp_millis(arrival_ms)
    lines = records.select(
        F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("value"),
        F.date_format(at, "yyyy").alias("y"), F.date_format(at, "MM").alias("m"),
        F.date_format(at, "dd").alias("d"), F.date_format(at, "HH").alias("h"))
    # no rebalance: a poll's records come from one document, so they already
    # sit together in one task; each task writes one file per arrival hour
    (lines.write.mode(MODES[mode])
     .partitionBy("y", "m", "d", "h").option("compression", compression).text(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Export a (small, report-sized) result as CSV with a header."""
    df.write.mode(MODES[mode]).option("header", True).csv(path)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                   partitioned: bool = True, database: str | None = None,
                   schema=None, partition_by=None) -> DataFrame:
    """Register a written zone folder as a catalog table (in ``database``,
    created when missing) and discover its partitions (the crawler's job).
    With ``schema`` (the written table's schema) partition columns keep
    their type, e.g. the ``dt`` day key stays a string instead of being
    inferred as a date from the folder names."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        name = f"{database}.{name}"
    else:
        # a temp view of the same name would shadow the table (and absorb the
        # DROP below), so it goes first
        spark.catalog.dropTempView(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if schema is not None:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = list(partition_by or [])
        part_clause = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})" if parts else ""
        spark.sql(f"CREATE TABLE {name} ({cols}) USING {fmt}{part_clause} LOCATION '{path}'")
        partitioned = partitioned and bool(parts)
    else:
        spark.catalog.createTable(name, path=path, source=fmt)
    if partitioned:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)

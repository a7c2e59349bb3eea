"""Incremental runs: one delivery of landing lines at a time.

A delivery is what one run brings: a micro-batch of new landing files
(:func:`roadlake.plans.jobs.run_feed_incremental`) or the landing folders of a
range of arrival hours (:func:`run_feed_arrivals`). :func:`apply_delivery`

1. parses its lines **once**, into a staged table of clean rows and malformed
   lines;
2. drops lines that the clean table already holds. Each clean file carries two
   64-bit hashes of its rows' landing lines beside the clean columns: the
   table is its own ledger of delivered lines, day by day, and consulting it
   reads only these two columns of the days that the delivery touches;
3. writes the rest to the clean table and the malformed lines to the
   quarantine, both partitioned by day and **batch**. A batch's partitions are
   replaced when it runs again, so a run that was cut off anywhere can be
   repeated: nothing is lost or counted twice;
4. rebuilds the day summaries of the touched days and merges the new rows into
   the latest-state table (:func:`merge_latest`).

An identical line is a re-delivery: pollers re-send whole polls, and records
that differ in anything (a later poll's ingest stamp included) differ as
lines. Malformed lines are kept as often as they come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake import schemas
from roadlake.operators import clean, curate
from roadlake.plans.jobs import CLEAN_TABLES
from roadlake.session import path_exists, remove_path
from roadlake.sinks import write_table
from roadlake.sources import read_landing_range, read_table
from roadlake.streaming.incremental import DAY_SUMMARIES, SCHEMAS

#: Latest-state table, its builder and its key, by feed.
LATEST = {"rwis": ("rwis_latest_per_station", curate.rwis_latest_per_station, "station_id"),
          "wzdx": ("wzdx_current_events", curate.wzdx_current_events, "road_event_id"),
          "incidents": ("inc_current_events", curate.inc_current_events, "event_id")}
#: Buckets of a latest-state table (fixed for the life of a table).
BUCKETS = 64
#: What the second of a line's two hashes starts from (any fixed number).
SECOND = 2
LEDGER = T.StructType([T.StructField("_k1", T.LongType()), T.StructField("_k2", T.LongType()),
                       T.StructField("dt", T.StringType()), T.StructField("batch", T.StringType())])


def clean_lines(feed: str, lines: DataFrame, run_ts=None, carry=()) -> DataFrame:
    """Clean rows of one feed's landing lines, with the helper columns of
    ``carry``."""
    if feed == "rwis":
        return clean.clean_rwis(lines, run_ts=run_ts, carry=carry)
    if feed == "wzdx":
        return clean.clean_wzdx(lines, run_ts=run_ts, carry=carry)
    return clean.clean_incidents(lines, carry=carry)


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("batch", T.StringType())])


def read_clean(spark: SparkSession, feed: str, zones, batch: str | None = None,
               days=None) -> DataFrame:
    """Clean rows of an incremental zone root, of one batch and of some days
    where given (partition filters)."""
    rows = read_table(spark, zones.clean(CLEAN_TABLES[feed]), _with_batch(SCHEMAS[feed]))
    if batch is not None:
        rows = rows.where(F.col("batch") == batch)
    if days is not None:
        rows = rows.where(in_days(days))
    return rows.select(*SCHEMAS[feed].fieldNames())


def in_days(days, day_col: str = "dt"):
    """Condition that ``day_col`` is one of ``days`` (None: no day)."""
    known = [d for d in days if d is not None]
    cond = F.col(day_col).isin(known) if known else F.lit(False)
    return (cond | F.col(day_col).isNull()) if None in days else cond


def ledger(spark: SparkSession, feed: str, zones, days, batch: str) -> DataFrame:
    """Line hashes that the touched days of the clean table hold from other
    batches (a repeated run must not see its own rows)."""
    held = read_table(spark, zones.clean(CLEAN_TABLES[feed]), LEDGER)
    return held.where(in_days(days) & (F.col("batch") != batch)).select("dt", "_k1", "_k2")


def apply_delivery(spark: SparkSession, feed: str, zones, lines: DataFrame, batch: str,
                   run_ts=None, drop_redelivered: bool = True, buckets: int = BUCKETS) -> None:
    """Bring one delivery of landing lines through clean to curated (see the
    module's text). ``batch`` names it: the same batch again replaces itself."""
    table, schema = CLEAN_TABLES[feed], SCHEMAS[feed]
    staging = f"{zones.root}/_staging/{feed}"
    rows = clean_lines(feed, lines, run_ts, ("_malformed", "_line"))
    rows = rows.select(*schema.fieldNames(), "_malformed", F.when(F.col("_malformed"), F.col("_line")).alias("value"),
                       F.xxhash64("_line").alias("_k1"), F.xxhash64(F.lit(SECOND), F.col("_line")).alias("_k2"))
    write_table(rows, staging, None, "overwrite")
    staged = spark.read.schema(rows.schema).parquet(staging)

    malformed = staged.where("_malformed").select("value", F.lit(batch).alias("batch"))
    if not malformed.isEmpty() or path_exists(spark, f"{zones.quarantine(feed)}/batch={batch}"):
        (malformed.write.mode("overwrite").partitionBy("batch").option("partitionOverwriteMode", "dynamic")
         .option("compression", "gzip").text(zones.quarantine(feed)))

    good = staged.where(~F.col("_malformed")).drop("_malformed", "value")
    days = [r[0] for r in good.select("dt").distinct().collect()]          # bounded by the calendar
    if not days:
        return
    if drop_redelivered:
        keys = ["dt", "_k1", "_k2"]
        good = good.dropDuplicates(keys)
        if path_exists(spark, zones.clean(table)) is not False:
            held = ledger(spark, feed, zones, days, batch).toDF("_day", "_h1", "_h2")
            good = good.join(held, F.col("dt").eqNullSafe(F.col("_day")) & (F.col("_k1") == F.col("_h1"))
                             & (F.col("_k2") == F.col("_h2")), "left_anti")
    write_table(good.withColumn("batch", F.lit(batch)), zones.clean(table), ["dt", "batch"], "replace_partitions")

    for name, build in DAY_SUMMARIES[feed].items():
        write_table(build(read_clean(spark, feed, zones, days=days)), zones.curated(name), ["dt"], "replace_partitions")
    name, build, key = LATEST[feed]
    current = merge_latest(spark, zones.curated(name), read_clean(spark, feed, zones, batch, days), build,
                           key, schemas.PARTITIONS[name][0], buckets)
    if feed == "incidents" and current is not None:
        # counts follow the current table, whose rows may move between days
        write_table(curate.inc_daily_summary(current.select(*schemas.INCIDENT_CURRENT_COLS)), zones.curated("inc_daily_summary"),
                    schemas.PARTITIONS["inc_daily_summary"], "overwrite")


def merge_latest(spark: SparkSession, path: str, new_rows: DataFrame, build, key: str,
                 day_col: str, buckets: int = BUCKETS) -> DataFrame | None:
    """Latest-state table := latest(its rows + new clean rows), bucket by bucket.

    The table is partitioned by a hash bucket of its key, and a run reads and
    rewrites only the buckets that hold one of its keys. Latest-per-key has a
    total order, so this equals a rebuild over the whole history. The buckets'
    new rows are committed beside the table before they replace the old ones:
    a run that stops in between leaves that copy, and the next one finishes
    it. The merged table, or None without new rows."""
    beside = path.rstrip("/") + ".next"
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    shape = build(new_rows).withColumn("bucket", bucket).schema

    def publish():
        write_table(read_table(spark, beside, shape), path, ["bucket"], "replace_partitions")
        remove_path(spark, beside)

    if path_exists(spark, f"{beside}/_SUCCESS"):
        publish()
    clean_cols = new_rows.columns
    touched = [r[0] for r in new_rows.select(bucket.alias("b")).distinct().collect()]      # at most `buckets`
    if not touched:
        return None
    rows = new_rows
    if path_exists(spark, path):
        held = read_table(spark, path, shape).where(F.col("bucket").isin(touched))
        rows = held.withColumn("dt", F.col(day_col).cast("string")).select(*clean_cols).unionByName(rows)
    write_table(build(rows).withColumn("bucket", bucket), beside, ["bucket"], "overwrite")
    publish()
    return read_table(spark, path, shape)


# ------------------------------------------------------------ arrival ranges
def _mark_path(zones, feed: str) -> str:
    return f"{zones.root}/_marks/{feed}"


def arrival_mark(spark: SparkSession, feed: str, zones) -> str | None:
    """Arrival hour (ISO text) up to which the landing has been processed."""
    path = _mark_path(zones, feed)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return None
    return spark.read.schema("until string").json(path).first()[0]


def run_feed_arrivals(spark: SparkSession, feed: str, zones, until: str, since: str | None = None,
                      run_ts=None, **options) -> bool:
    """Process the landing folders of arrival hours ``since`` (default: the
    stored mark, or the beginning) up to ``until`` (ISO text, exclusive), and
    move the mark. Only the folders of the range are read. False when the
    range is empty; overlapping ranges are safe, as delivered lines are known."""
    mark = arrival_mark(spark, feed, zones)
    start = since if since is not None else mark
    if start is not None and start >= until:
        return False
    lines = read_landing_range(spark, zones.landing(feed), start, until)
    name = "arrivals-" + "-".join("".join(c for c in x if c.isalnum()) for x in (start or "start", until))
    apply_delivery(spark, feed, zones, lines, name, run_ts, **options)
    if mark is None or mark < until:
        spark.createDataFrame([(until,)], "until string").coalesce(1).write.mode("overwrite").json(_mark_path(zones, feed))
    return True

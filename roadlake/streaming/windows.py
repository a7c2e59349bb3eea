"""Hourly station windows that late readings still reach.

A watermark in the state store drops what comes later than it allows. Here the
state of a window is what can be added up: sums and counts of each measure.
Every micro-batch writes its own partial sums, keyed by (day, station, hour)
and partitioned by (day, batch); a window's value is the sum over batches. So

* a reading of any age reaches its window;
* a replayed batch replaces its own partitions and counts once;
* a batch touches only its readings' days.

A window is *closed* when the latest reading so far is ``lateness`` past its
end. After each batch the closed windows of the touched days, and of the days
in which windows closed, are published (again, if they changed); :func:`drain`
publishes the ones that are still open at the end.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadlake.functions.time import hour_bucket
from roadlake.schemas import RWIS_HOURLY
from roadlake.session import path_exists
from roadlake.sinks import write_table
from roadlake.sources import read_table

MEASURES = {"avg_air_temp_f": "air_temp_f", "avg_pavement_temp_f": "pavement_temp_f", "avg_wind_mph": "wind_mph"}
SURFACES = {"cnt_dry": "dry", "cnt_wet": "wet", "cnt_icy": "icy"}
KEYS = ["dt", "station_id", "event_hour"]
_STATE = ("dt string, station_id int, event_hour timestamp, "
          + ", ".join(f"sum_{m} double, n_{m} long" for m in MEASURES.values())
          + ", cnt_dry long, cnt_wet long, cnt_icy long, obs_count long, batch string")


def partial_windows(rows: DataFrame) -> DataFrame:
    """Partial sums of clean readings per (dt, station, hour)."""
    sums = [f(c) for m in MEASURES.values() for f, c in ((lambda x: F.sum(x).alias(f"sum_{x}"), m),
                                                         (lambda x: F.count(x).alias(f"n_{x}"), m))]
    counts = [F.count_if(F.col("surface_status") == s).alias(c) for c, s in SURFACES.items()]
    return (rows.where(F.col("dt").isNotNull())
            .groupBy("dt", "station_id", hour_bucket(F.col("event_time")).alias("event_hour"))
            .agg(*sums, *counts, F.count(F.lit(1)).alias("obs_count")))


def windows_of(partials: DataFrame) -> DataFrame:
    """Hourly summary rows from partial sums of any number of batches."""
    means = [(F.sum(f"sum_{m}") / F.nullif(F.sum(f"n_{m}"), F.lit(0))).alias(c) for c, m in MEASURES.items()]
    counts = [F.sum(c).alias(c) for c in (*SURFACES, "obs_count")]
    return partials.groupBy(*KEYS).agg(*means, *counts).select(*RWIS_HOURLY.fieldNames())


def _state(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(_STATE).parquet(f"{base}/partials")


def latest_reading(spark: SparkSession, base: str, before: str | None = None) -> datetime | None:
    """Time of the latest reading of all batches (or of those ``before`` one)."""
    if not path_exists(spark, f"{base}/latest"):
        return None
    seen = spark.read.schema("latest timestamp, batch string").parquet(f"{base}/latest")     # a row a batch
    if before is not None:
        seen = seen.where(F.col("batch") < before)
    return seen.agg(F.max("latest")).first()[0]


def _days(start: datetime, end: datetime) -> list[str]:
    n = (end.date() - start.date()).days
    return [(start.date() + timedelta(days=i)).isoformat() for i in range(n + 1)]


def publish(spark: SparkSession, base: str, table: str, days, closed_at: datetime | None = None) -> None:
    """Write the windows of ``days`` to the summary table: all, or those that
    end by ``closed_at``."""
    out = windows_of(_state(spark, base).where(F.col("dt").isin(list(days))))
    if closed_at is not None:
        out = out.where(F.col("event_hour") + F.expr("INTERVAL 1 HOUR") <= F.lit(closed_at))
    write_table(out, table, ["dt"], "replace_partitions")


def start_hourly_state(rows: DataFrame, base: str, table: str, lateness: timedelta = timedelta(hours=1),
                       available_now: bool = True) -> StreamingQuery:
    """Keep the hourly summary of a stream of clean readings: state below
    ``base``, closed windows in ``table`` (partitioned by ``dt``)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"{batch_id:09d}"
        write_table(partial_windows(batch).withColumn("batch", F.lit(name)), f"{base}/partials", ["dt", "batch"],
                    "replace_partitions")
        if not path_exists(spark, f"{base}/partials"):
            return
        # at most a row a day, with the hour of the day's latest reading
        touched = (_state(spark, base).where(F.col("batch") == name).groupBy("dt").agg(F.max("event_hour")).collect())
        if not touched:
            return
        before = latest_reading(spark, base, name)
        newest = batch.agg(F.max("event_time").alias("latest")).withColumn("batch", F.lit(name))
        write_table(newest, f"{base}/latest", ["batch"], "replace_partitions", rebalance=False)
        now = latest_reading(spark, base)
        days = {r[0] for r in touched}
        if before is not None:                             # days in which windows have closed meanwhile
            days.update(_days(before - lateness - timedelta(hours=1), now - lateness))
        publish(spark, base, table, days, now - lateness)

    w = rows.writeStream.foreachBatch(run).option("checkpointLocation", f"{base}/_checkpoint")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def drain(spark: SparkSession, base: str, table: str, lateness: timedelta = timedelta(hours=1)) -> None:
    """Publish the windows that are still open (no more readings will come)."""
    latest = latest_reading(spark, base)
    if latest is not None:
        publish(spark, base, table, _days(latest - lateness - timedelta(hours=1), latest))


def read_windows(spark: SparkSession, table: str) -> DataFrame:
    return read_table(spark, table, RWIS_HOURLY)

"""Incremental (Structured Streaming) variants of the batch jobs.

* :func:`clean_stream` — landing folder as a file stream -> clean rows (K1);
  the same clean expressions as batch, so results are identical.
* :func:`start_clean` — clean stream -> clean table (file sink, exactly
  once through its commit log and checkpoint), ``availableNow`` by default.
* :func:`hourly_windows` — tumbling one-hour windows with a watermark,
  append mode: a window is emitted once the watermark passes its end (K2).
* :func:`dedupe` — duplicate deliveries dropped within the watermark (K3);
  :func:`start_dedupe` — repeats dropped against the days that a micro-batch
  touches in the clean table, so first-time readings are kept however late.
* :func:`latest_state` — latest row per key kept in the state store with
  ``max_by`` (``row_number`` is not allowed on streams) (K4).
* :func:`start_curate` — ``foreachBatch`` that recomputes, from the clean
  table, only the days touched by each micro-batch and replaces those
  partitions: exact daily summaries (distinct counts included, which a
  streaming aggregate cannot do) and idempotent replays (K5).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadlake import schemas
from roadlake.functions.time import day_key
from roadlake.operators import clean, curate
from roadlake.sinks import write_table
from roadlake.sources import read_table


def clean_stream(spark: SparkSession, feed: str, landing_path: str, run_ts=None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming clean rows of one feed from its landing folder."""
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    lines = r.load(landing_path).select("value")
    if feed == "rwis":
        return clean.clean_rwis(lines, run_ts=run_ts)
    if feed == "wzdx":
        return clean.clean_wzdx(lines, run_ts=run_ts)
    return clean.clean_incidents(lines)


def start_clean(df: DataFrame, table_path: str, checkpoint: str,
                partition_by=("dt",), available_now: bool = True,
                processing_time: str | None = None) -> StreamingQuery:
    """Append a clean stream to its day-partitioned Parquet table."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy(*partition_by))
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=processing_time or "1 minute")
    return w.start(table_path)


def start_quarantine(spark: SparkSession, feed: str, landing_path: str, path: str,
                     checkpoint: str) -> StreamingQuery:
    """Append the malformed lines of new landing files to the quarantine."""
    lines = (spark.readStream.format("text").option("recursiveFileLookup", "true")
             .load(landing_path).select("value"))
    return (clean.quarantine(lines, LANDING[feed]).writeStream.format("text").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))


def hourly_windows(clean_rows: DataFrame, watermark: str | None = "1 hour") -> DataFrame:
    """Streaming hourly station summary over tumbling event-time windows.
    ``watermark=None`` keeps a watermark defined upstream (e.g. by
    :func:`dedupe`)."""
    if watermark is not None:
        clean_rows = clean_rows.withWatermark("event_time", watermark)
    g = (clean_rows
         .groupBy(F.window("event_time", "1 hour").alias("w"), "station_id")
         .agg(F.avg("air_temp_f").alias("avg_air_temp_f"),
              F.avg("pavement_temp_f").alias("avg_pavement_temp_f"),
              F.avg("wind_mph").alias("avg_wind_mph"),
              F.count_if(F.col("surface_status") == "dry").alias("cnt_dry"),
              F.count_if(F.col("surface_status") == "wet").alias("cnt_wet"),
              F.count_if(F.col("surface_status") == "icy").alias("cnt_icy"),
              F.count(F.lit(1)).alias("obs_count")))
    return g.select(day_key(F.col("w.start")).alias("dt"), "station_id",
                    F.col("w.start").alias("event_hour"), "avg_air_temp_f",
                    "avg_pavement_temp_f", "avg_wind_mph", "cnt_dry", "cnt_wet",
                    "cnt_icy", "obs_count")


def dedupe(rows: DataFrame, keys, watermark: str = "1 hour",
           time_col: str = "event_time") -> DataFrame:
    """Drop repeated deliveries of the same record within the watermark."""
    return rows.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(list(keys))


def start_dedupe(spark: SparkSession, rows: DataFrame, keys, table_path: str, schema,
                 checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append to the clean table, partitioned by ``dt``, the rows of each
    micro-batch that it does not hold yet. Equal ``keys`` must lie in the same
    day, so only the touched days are read; a replayed batch adds nothing."""
    keys = list(keys)
    write_table(spark.createDataFrame([], schema), table_path, ["dt"], "append")

    def run(batch: DataFrame, batch_id: int) -> None:
        days = _touched_days(batch)
        if not days:
            return
        held = read_table(spark, table_path, schema).where(F.col("dt").isin(days)) \
            .select(*[F.col(k).alias(f"_held_{k}") for k in keys])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys])
        fresh = batch.dropDuplicates(keys).join(held, same, "left_anti")
        write_table(fresh, table_path, ["dt"], "append")

    w = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def latest_state(rows: DataFrame, keys, order_col: str) -> DataFrame:
    """Latest row per key as a streaming aggregate (use ``update`` or
    ``complete`` output mode); ties on ``order_col`` go to the greatest
    remaining columns, as in the batch :func:`latest_per_key`."""
    keys = list(keys)
    rest = curate.tie_break_columns(rows, keys, [order_col])
    order = F.struct(F.col(order_col), *[F.col(c) for c in rest])
    payload = F.struct(*[F.col(c) for c in rows.columns if c not in keys])
    agg = rows.groupBy(*keys).agg(F.max_by(payload, order).alias("_r"))
    return agg.select(*keys, "_r.*").select(*rows.columns)


def _touched_days(batch: DataFrame, day_col: str = "dt") -> list[str]:
    # one row per day in the micro-batch: bounded by the number of days
    return [r[0] for r in batch.select(day_col).where(F.col(day_col).isNotNull())
            .distinct().collect()]


def start_curate(spark: SparkSession, feed_clean_stream: DataFrame, clean_path: str,
                 clean_schema, summaries: dict, checkpoint: str,
                 available_now: bool = True, on_batch=None) -> StreamingQuery:
    """For every micro-batch of new clean rows, rebuild each summary for the
    days the batch touched from the whole clean table and replace those day
    partitions.  ``summaries`` maps output path -> ``clean_df -> summary_df``
    (the summary must be keyed by ``dt``); ``on_batch(batch)`` runs after
    (e.g. to merge the new rows into a latest-state table)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        days = _touched_days(batch)
        if not days:
            return
        c = read_table(spark, clean_path, clean_schema).where(F.col("dt").isin(days))
        for out_path, build in summaries.items():
            write_table(build(c), out_path, ["dt"], "replace_partitions")
        if on_batch is not None:
            on_batch(batch)

    w = feed_clean_stream.writeStream.foreachBatch(run) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


# Day-keyed summaries each feed can rebuild per touched day, and clean schemas.
DAY_SUMMARIES = {"rwis": {"rwis_hourly_summary": curate.rwis_hourly_summary},
                 "wzdx": {"wzdx_daily_summary": curate.wzdx_daily_summary},
                 "incidents": {}}
LANDING = {"rwis": schemas.RWIS_LANDING, "wzdx": schemas.WZDX_LANDING,
           "incidents": schemas.INCIDENT_LANDING}
SCHEMAS = {"rwis": schemas.RWIS_CLEAN, "wzdx": schemas.WZDX_CLEAN,
           "incidents": schemas.INCIDENT_CLEAN}

"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver tables and runs the real pipeline operators
over all of their rows: derived feed snapshots -> decode -> normalise ->
landing JSON lines -> clean -> curate -> questions.  Outputs carry naive
(``timestamp_ntz``) UTC timestamps so any engine compares them as written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake import schemas
from roadlake.operators import clean, curate, normalize, quality
from roadlake.plans import analytics, feeds
from roadlake.plans.feeds import GEOFENCE, RUN_MS, RUN_TS, table
from roadlake.session import ensure_compiled, ensure_utc
from roadlake.sinks import run_folder, write_landing
from roadlake.sources import read_landing_lines


def naive(df: DataFrame) -> DataFrame:
    """Session-zone timestamps -> naive UTC timestamps (output convention)."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


# ------------------------------------------------------------ feed chains
def landed(spark: SparkSession, records: DataFrame, feed: str) -> DataFrame:
    """Deliver landing records to a fresh landing folder (gzip JSON lines in
    the shared folder, arrival = run time) and scan them back: the zone
    boundary of the pipeline, which also cuts the plan's lineage."""
    path = run_folder(spark, f"landing-{feed}")
    write_landing(records, path, arrival_ms=RUN_MS)
    return read_landing_lines(spark, path)


def landed_records(spark, records: DataFrame, schema, name: str) -> DataFrame:
    """Landing records written once, to be delivered in several parts."""
    path = run_folder(spark, f"records-{name}")
    records.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def rwis_landing(spark, d) -> DataFrame:
    docs = feeds.rwis_snapshots(table(spark, d, "events"))
    lat, lon, r = GEOFENCE
    return normalize.normalize_rwis(docs, run_ts=RUN_TS, center_lat=lat,
                                    center_lon=lon, radius_km=r)


def rwis_geofence_distance(spark, d) -> DataFrame:
    """Decoded readings kept by the geofence with their coordinates and the
    great-circle distance to the centre (km, 6 decimals)."""
    from roadlake.functions import haversine_km
    docs = feeds.rwis_snapshots(table(spark, d, "events"))
    lat, lon, r = GEOFENCE
    recs = normalize.normalize_rwis(docs, run_ts=RUN_TS, center_lat=lat, center_lon=lon,
                                    radius_km=r, keep_coords=True)
    return recs.select("station_id", "ts", "lat", "lon", F.round(
        haversine_km(lat, lon, F.col("lat"), F.col("lon")), 6).alias("distance_km"))


def rwis_clean(spark, d) -> DataFrame:
    return clean.clean_rwis(landed(spark, rwis_landing(spark, d), "rwis"), run_ts=RUN_TS)


def incident_landing(spark, d) -> DataFrame:
    docs = feeds.incident_snapshots(table(spark, d, "events"), table(spark, d, "nation"))
    return normalize.normalize_incidents(docs, run_ts=RUN_TS)


def incident_xml_edges(spark, d) -> DataFrame:
    """Every incident document with a repeated county, an incident inside a
    comment and an incident's end inside CDATA after each county: the records
    are those of the plain documents."""
    docs = feeds.incident_snapshots(table(spark, d, "events"), table(spark, d, "nation"))
    noise = ("</county><county>second</county><!-- <Incident><id>no</id></Incident> -->"
             "<note><![CDATA[</Incident><Incident><id>no</id>]]></note>")
    return normalize.normalize_incidents(
        docs.withColumn("value", F.replace("value", F.lit("</county>"), F.lit(noise))), run_ts=RUN_TS)


def incident_clean(spark, d) -> DataFrame:
    return clean.clean_incidents(landed(spark, incident_landing(spark, d), "incidents"))


def wzdx_landing(spark, d) -> DataFrame:
    docs = feeds.wzdx_snapshots(table(spark, d, "orders"))
    return normalize.normalize_wzdx(docs, ingest_col="snapshot_ms")


def wzdx_snapshot_check(spark, d) -> DataFrame:
    """Shape check of work-zone snapshots: every derived document plus a
    truncated copy (invalid JSON) and a copy whose ``features`` is not a
    list, classified and counted per kind."""
    from roadlake.sources import problem_kind
    docs = feeds.wzdx_snapshots(table(spark, d, "orders"))
    v = F.col("value")
    wrong_shape = F.concat(F.lit('{"type":"FeatureCollection","features":{"length":'),
                           F.length(v).cast("string"), F.lit("}}"))
    fixed = docs.select(F.explode(F.array(v, F.substring(v, 1, 40), wrong_shape))
                        .alias("value"))
    return fixed.groupBy(problem_kind(F.col("value")).alias("kind")) \
        .agg(F.count(F.lit(1)).alias("documents"))


def _with_damage(docs: DataFrame, other: str) -> DataFrame:
    """Every document, a truncated copy of it, and ``other`` followed by its
    length (a readable document of another shape, or one more damaged one)."""
    v = F.col("value")
    copies = F.array(v, F.substring(v, 1, 40), F.concat(F.lit(other), F.length(v).cast("string"), F.lit("}")))
    return docs.withColumn("value", F.explode(copies))


def ingest_dead_letters(spark, d) -> DataFrame:
    """All three feeds ingested with damaged documents among the sound ones:
    landed records by feed, dead letters by feed and kind, and the counts that
    the ingest reported."""
    from roadlake.plans import jobs
    z = _zones(spark)
    lat, lon, r = GEOFENCE
    docs = {"rwis": feeds.rwis_snapshots(table(spark, d, "events")),
            "wzdx": feeds.wzdx_snapshots(table(spark, d, "orders")),
            "incidents": feeds.incident_snapshots(table(spark, d, "events"), table(spark, d, "nation"))}
    options = {"rwis": {"center_lat": lat, "center_lon": lon, "radius_km": r}, "wzdx": {}, "incidents": {"ingest_col": None}}
    out = []
    for feed, own in docs.items():
        report = jobs.RunReport()
        jobs.ingest_documents(spark, feed, _with_damage(own, '{"other": '), z, RUN_TS, report, **options[feed])
        counts = report.metrics[f"{feed}_ingest"]
        lines = read_landing_lines(spark, z.landing(feed))
        out.append(lines.agg(F.lit(feed).alias("feed"), F.lit("landing").alias("sink"), F.lit("record").alias("kind"),
                             F.count(F.lit(1)).alias("n"), F.lit(counts["sent"]).cast("long").alias("reported")))
        dead = jobs.read_dead_letters(spark, feed, z).where(F.length("snippet") == F.least(F.col("n_chars"), F.lit(400)))
        out.append(dead.groupBy("feed", F.lit("dead_letter").alias("sink"), "kind")
                   .agg(F.count(F.lit(1)).alias("n")).withColumn("reported", F.lit(counts["damaged"]).cast("long")))
    from functools import reduce
    return reduce(DataFrame.unionByName, out)


def wzdx_clean(spark, d) -> DataFrame:
    return clean.clean_wzdx(landed(spark, wzdx_landing(spark, d), "wzdx"), run_ts=RUN_TS)


def rwis_hourly(spark, d):
    return curate.rwis_hourly_summary(rwis_clean(spark, d))


def wz_daily(spark, d):
    return curate.wzdx_daily_summary(wzdx_clean(spark, d))


def inc_daily(spark, d):
    return curate.inc_daily_summary(curate.inc_current_events(incident_clean(spark, d)))


# ------------------------------------------------------- zone-level chains
def _zones(spark):
    from roadlake.plans.jobs import Zones
    return Zones(run_folder(spark, "zones"))


def _land_feed(spark, d, zones, feed):
    recs = {"rwis": rwis_landing, "incidents": incident_landing,
            "wzdx": wzdx_landing}[feed](spark, d)
    write_landing(recs, zones.landing(feed), arrival_ms=RUN_MS)


def zones_county_performance(spark, d):
    """Incidents through the zones: landing files -> clean table (catalog)
    -> current + daily tables -> Q3 over the curated table read back."""
    from roadlake.plans import jobs
    z = _zones(spark)
    _land_feed(spark, d, z, "incidents")
    jobs.run_feed(spark, "incidents", z, run_ts=RUN_TS)
    return analytics.county_performance(jobs.read_curated(spark, z, "inc_daily_summary"))


def zones_incremental_county_performance(spark, d):
    """Incidents through incremental zone runs: a delivery and a run, then a
    re-delivery of the same poll and a second run (which processes only the
    new files); current-state semantics absorb the repeat, so Q3 equals the
    one-delivery answer."""
    from roadlake.plans import jobs
    z = _zones(spark)
    recs = landed_records(spark, incident_landing(spark, d), schemas.INCIDENT_LANDING, "polled")
    for attempt in range(2):
        write_landing(recs, z.landing("incidents"), arrival_ms=RUN_MS + attempt * 3600000)
        jobs.run_feed_incremental(spark, "incidents", z, run_ts=RUN_TS)
    return analytics.county_performance(jobs.read_curated(spark, z, "inc_daily_summary"))


def zones_redelivered_hourly(spark, d):
    """RWIS through incremental zone runs: a part of the readings, then a
    delivery of all of them (the first ones again), then the same once more.
    Lines that were delivered before count once, so the hourly summary is the
    one-delivery summary."""
    from roadlake.plans import jobs
    z = _zones(spark)
    recs = landed_records(spark, rwis_landing(spark, d), schemas.RWIS_LANDING, "again")
    for n, part in enumerate((F.pmod(F.xxhash64(*recs.columns), F.lit(2)) == 0, F.lit(True), F.lit(True))):
        write_landing(recs.where(part), f"{z.landing('rwis')}/{n}", arrival_ms=RUN_MS + n * 3600000)
        jobs.run_feed_incremental(spark, "rwis", z, run_ts=RUN_TS)
    return jobs.read_curated(spark, z, "rwis_hourly_summary").select(*schemas.RWIS_HOURLY.fieldNames())


def zones_incremental_latest(spark, d):
    """Latest reading per station from two incremental runs: the second
    rewrites only the buckets of the stations that it brings."""
    from roadlake.plans import jobs
    z = _zones(spark)
    recs = landed_records(spark, rwis_landing(spark, d), schemas.RWIS_LANDING, "latest")
    first = (F.col("station_id") % 10 != 0) | (F.pmod(F.xxhash64(*recs.columns), F.lit(2)) == 0)
    for n, part in enumerate((first, ~first)):
        write_landing(recs.where(part), f"{z.landing('rwis')}/{n}", arrival_ms=RUN_MS + n * 3600000)
        jobs.run_feed_incremental(spark, "rwis", z, run_ts=RUN_TS)
    return jobs.read_curated(spark, z, "rwis_latest_per_station").select(*schemas.RWIS_LATEST_COLS)


#: Arrival ranges of ``zones_arrival_range_hourly`` (start, then the marks).
ARRIVALS = ("2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00")


def zones_arrival_range_hourly(spark, d):
    """RWIS readings landed by the day they were taken, processed for a range
    of arrival days in two runs: the second starts at the stored mark."""
    from roadlake.plans import deliveries, jobs
    z = _zones(spark)
    day = 86400000
    write_landing(rwis_landing(spark, d), z.landing("rwis"), arrival_ms=F.floor(F.col("ts") / day) * day)
    start, middle, end = ARRIVALS
    deliveries.run_feed_arrivals(spark, "rwis", z, middle, since=start, run_ts=RUN_TS)
    deliveries.run_feed_arrivals(spark, "rwis", z, end, run_ts=RUN_TS)
    return jobs.read_curated(spark, z, "rwis_hourly_summary").select(*schemas.RWIS_HOURLY.fieldNames())


def zones_daily_coverage(spark, d):
    """All three feeds through the zones, curated tables registered in the
    catalog, Q1 over the catalog tables."""
    from roadlake.plans import jobs
    z = _zones(spark)
    database = "roadlake_" + z.root.rsplit("-", 1)[-1]          # this run's own
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def feed_job(feed):
        def run(spark, d):
            _land_feed(spark, d, z, feed)
            jobs.landing_to_clean(spark, feed, z, run_ts=RUN_TS)
            return jobs.clean_to_curated(spark, feed, z, register=True, database=database)
        return run

    together(spark, d, *(feed_job(f) for f in ("rwis", "wzdx", "incidents")))
    tables = ("rwis_hourly_summary", "wzdx_daily_summary", "inc_daily_summary")
    return analytics.daily_coverage(*(spark.table(f"{database}.{t}") for t in tables))


def junk_lines(spark, d):
    """One malformed line per poll: junk text or an empty object, in turn."""
    return feeds.rwis_snapshots(table(spark, d, "events")).select(
        F.when(F.col("snapshot") % 2 == 0, F.concat(F.lit("garbage-"), F.col("snapshot")))
        .otherwise(F.lit("{}")).alias("value"))


def quality_metrics(spark, d):
    """Landing -> clean metrics of the RWIS feed with one malformed
    delivery per poll (alternately junk text and an empty object)."""
    recs = rwis_landing(spark, d)
    junk = junk_lines(spark, d)
    path = run_folder(spark, "landing-rwis-q")
    write_landing(recs, path, arrival_ms=RUN_MS)
    junk.write.mode("append").option("compression", "gzip").text(path + "/junk")
    lines = read_landing_lines(spark, path)
    flagged = clean.clean_rwis(lines, run_ts=RUN_TS, flag_malformed=True)
    return quality.clean_run_metrics(flagged)


def stream_quarantine(spark, d):
    """Malformed lines kept by an incremental RWIS run: one per poll, in a
    second delivery."""
    from roadlake.plans import jobs
    z = _zones(spark)
    write_landing(rwis_landing(spark, d), z.landing("rwis"), arrival_ms=RUN_MS)
    jobs.run_feed_incremental(spark, "rwis", z, run_ts=RUN_TS)
    junk_lines(spark, d).write.mode("append").option("compression", "gzip").text(z.landing("rwis") + "/junk")
    jobs.run_feed_incremental(spark, "rwis", z, run_ts=RUN_TS)
    return spark.read.text(z.quarantine("rwis")).select("value")


def csv_export_roundtrip(spark, d):
    """Q3 exported as CSV and read back with its schema."""
    from roadlake.sinks import write_csv
    q3 = analytics.county_performance(inc_daily(spark, d))
    path = run_folder(spark, "export-q3")
    write_csv(q3, path)
    return spark.read.schema(q3.schema).option("header", True).csv(path)


# ---------------------------------------------------------------- streaming
def _rwis_stream(spark, d):
    from roadlake import streaming
    lines_path = run_folder(spark, "landing-rwis-s")
    write_landing(rwis_landing(spark, d), lines_path, arrival_ms=RUN_MS)
    return streaming.clean_stream(spark, "rwis", lines_path, run_ts=RUN_TS)


def stream_clean_hourly(spark, d):
    """Incremental landing -> clean stream (file sink, availableNow), then
    the hourly summary over the streamed clean table."""
    from roadlake import streaming
    from roadlake.sources import read_table
    base = run_folder(spark, "stream-clean")
    q = streaming.start_clean(_rwis_stream(spark, d), base + "/table", base + "/_chk")
    q.awaitTermination()
    return curate.rwis_hourly_summary(read_table(spark, base + "/table", schemas.RWIS_CLEAN))


def stream_county_performance(spark, d):
    """Incidents through the incremental clean stream (file sink,
    availableNow), then current incidents, daily summary and Q3."""
    from roadlake import streaming
    from roadlake.sources import read_table
    lines_path = run_folder(spark, "landing-incidents-s")
    write_landing(incident_landing(spark, d), lines_path, arrival_ms=RUN_MS)
    base = run_folder(spark, "stream-incidents")
    q = streaming.start_clean(streaming.clean_stream(spark, "incidents", lines_path),
                              base + "/table", base + "/_chk")
    q.awaitTermination()
    cleaned = read_table(spark, base + "/table", schemas.INCIDENT_CLEAN)
    return analytics.county_performance(
        curate.inc_daily_summary(curate.inc_current_events(cleaned)))


def stream_dedupe_hourly(spark, d):
    """Every reading delivered twice, each delivery in its own trigger; repeats
    are dropped against the touched days of the clean table, so the hourly
    summary equals the single-delivery one."""
    from roadlake import streaming
    from roadlake.sources import read_table
    lines_path = run_folder(spark, "landing-rwis-dup")
    recs = rwis_landing(spark, d)
    base = run_folder(spark, "stream-dedupe")
    for delivery in ("/first", "/again"):
        write_landing(recs, lines_path + delivery, arrival_ms=RUN_MS)
        rows = streaming.clean_stream(spark, "rwis", lines_path, run_ts=RUN_TS)
        q = streaming.start_dedupe(spark, rows, schemas.RWIS_CLEAN.fieldNames(), base + "/table",
                                   schemas.RWIS_CLEAN, base + "/_chk")
        q.awaitTermination()
    return curate.rwis_hourly_summary(read_table(spark, base + "/table", schemas.RWIS_CLEAN))


def stream_hourly_late(spark, d):
    """Hourly windows of a stream in three triggers; every third reading comes
    late, in the second or third, when its window has long closed. A final
    drain publishes the open windows: the whole hourly summary."""
    from roadlake import streaming
    landing, base = run_folder(spark, "landing-rwis-late"), run_folder(spark, "stream-late")
    recs = landed_records(spark, rwis_landing(spark, d), schemas.RWIS_LANDING, "late")
    lateness = F.pmod(F.xxhash64(*recs.columns), F.lit(9))
    for n, part in enumerate((lateness > 2, lateness == 2, lateness < 2)):
        write_landing(recs.where(part), f"{landing}/{n}", arrival_ms=RUN_MS + n * 3600000)
        rows = streaming.clean_stream(spark, "rwis", landing, run_ts=RUN_TS)
        streaming.start_hourly_state(rows, base, base + "/hourly").awaitTermination()
    streaming.drain(spark, base, base + "/hourly")
    return streaming.read_windows(spark, base + "/hourly")


def stream_latest_per_station(spark, d):
    """Latest reading per station kept as streaming state (max_by), the
    complete result of each micro-batch replacing the output table."""
    from roadlake import streaming
    base = run_folder(spark, "stream-latest")
    latest = streaming.latest_state(_rwis_stream(spark, d), ["station_id"], "event_time")
    q = (latest.writeStream.outputMode("complete")
         .foreachBatch(lambda b, _id: b.write.mode("overwrite").parquet(base + "/table"))
         .option("checkpointLocation", base + "/_chk").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.schema(schemas.RWIS_CLEAN).parquet(base + "/table")
    return out.withColumn("snapshot_dt", F.col("dt")).select(*schemas.RWIS_LATEST_COLS)


def stream_curate_hourly(spark, d):
    """Clean stream whose micro-batches rebuild the hourly summary of the
    days they touch (foreachBatch, exact and idempotent)."""
    from roadlake import streaming
    base = run_folder(spark, "stream-curate")
    q1 = streaming.start_clean(_rwis_stream(spark, d), base + "/clean", base + "/_chk1")
    q1.awaitTermination()
    clean_stream = (spark.readStream.schema(schemas.RWIS_CLEAN)
                    .parquet(base + "/clean"))
    q2 = streaming.start_curate(spark, clean_stream, base + "/clean", schemas.RWIS_CLEAN,
                                {base + "/hourly": curate.rwis_hourly_summary},
                                base + "/_chk2")
    q2.awaitTermination()
    from roadlake.sources import read_table
    return read_table(spark, base + "/hourly", schemas.RWIS_HOURLY)


def together(spark, d, *chains):
    """Build independent feed chains concurrently: each one's landing delivery
    is its own Spark job, and jobs submitted from separate driver threads run
    side by side on the cluster instead of one after another."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(len(chains)) as pool:
        return list(pool.map(lambda f: f(spark, d), chains))


# ---------------------------------------------------------------- registry
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rwis_decode": rwis_landing,
    "rwis_geofence_distance": rwis_geofence_distance,
    "rwis_clean": rwis_clean,
    "rwis_hourly_summary": rwis_hourly,
    "rwis_latest_per_station":
        lambda s, d: curate.rwis_latest_per_station(rwis_clean(s, d)),
    "incident_decode": incident_landing,
    "incident_xml_edges": incident_xml_edges,
    "incident_clean": incident_clean,
    "inc_current_events": lambda s, d: curate.inc_current_events(incident_clean(s, d)),
    "inc_daily_summary": inc_daily,
    "wzdx_decode": wzdx_landing,
    "wzdx_snapshot_check": wzdx_snapshot_check,
    "ingest_dead_letters": ingest_dead_letters,
    "rwis_day_counts": lambda s, d: quality.day_counts(rwis_clean(s, d)),
    "wzdx_clean": wzdx_clean,
    "wzdx_current_events": lambda s, d: curate.wzdx_current_events(wzdx_clean(s, d)),
    "wzdx_daily_summary": wz_daily,
    "daily_coverage": lambda s, d: analytics.daily_coverage(
        *together(s, d, rwis_hourly, wz_daily, inc_daily)),
    "daily_coverage_all": lambda s, d: analytics.daily_coverage(
        *together(s, d, rwis_hourly, wz_daily, inc_daily), limit=None),
    "weather_vs_incidents_all": lambda s, d: analytics.weather_vs_incidents(
        *together(s, d, rwis_hourly, inc_daily), limit=None),
    "county_performance_all": lambda s, d: analytics.county_performance(
        inc_daily(s, d), limit=None),
    "weather_vs_incidents": lambda s, d: analytics.weather_vs_incidents(
        *together(s, d, rwis_hourly, inc_daily)),
    "county_performance": lambda s, d: analytics.county_performance(inc_daily(s, d)),
    "coverage_gaps": lambda s, d: analytics.coverage_gaps(
        *together(s, d, rwis_hourly, wz_daily, inc_daily)),
    "zones_county_performance": zones_county_performance,
    "zones_daily_coverage": zones_daily_coverage,
    "zones_incremental_county_performance": zones_incremental_county_performance,
    "zones_redelivered_hourly": zones_redelivered_hourly,
    "zones_incremental_latest": zones_incremental_latest,
    "zones_arrival_range_hourly": zones_arrival_range_hourly,
    "quality_metrics": quality_metrics,
    "stream_quarantine": stream_quarantine,
    "csv_export_roundtrip": csv_export_roundtrip,
    "stream_clean_hourly": stream_clean_hourly,
    "stream_hourly_late": stream_hourly_late,
    "stream_dedupe_hourly": stream_dedupe_hourly,
    "stream_county_performance": stream_county_performance,
    "stream_latest_per_station": stream_latest_per_station,
    "stream_curate_hourly": stream_curate_hourly,
}


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        ensure_compiled(spark)
        return naive(fn(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _wrap(v) for k, v in _QUERIES.items()}

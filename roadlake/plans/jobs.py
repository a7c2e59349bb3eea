"""Batch jobs over the zones: snapshots -> landing -> clean -> curated.

Zone layout under one root folder (any Hadoop file system path)::

    <root>/landing/<feed>/y=/m=/d=/h=/part-*.txt.gz
    <root>/clean/<table>/dt=.../part-*.parquet
    <root>/curated/<table>/<partition>=.../part-*.parquet
    <root>/quarantine/<feed>/...                 malformed landing lines
    <root>/dead_letters/<feed>/y=/m=/d=/h=/...   damaged snapshot documents

Each job is one Spark action per output: metrics ride on the write through
``observe`` (no extra counting passes), the non-empty guard is an
``isEmpty`` probe, and writes are idempotent (dynamic partition overwrite
for day-partitioned tables, full overwrite for latest-state tables).
Reading a written zone back is the lineage cut between jobs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from roadlake import schemas
from roadlake.operators import clean, curate, normalize, quality
from roadlake.session import path_exists
from roadlake.sinks import register_table, write_landing, write_table
from roadlake.sources import read_landing_lines, read_snapshots, read_table

CLEAN_TABLES = {"rwis": "rwis_validated", "incidents": "incident_validated",
                "wzdx": "wzdx_validated"}
CLEAN_SCHEMAS = {"rwis_validated": schemas.RWIS_CLEAN,
                 "incident_validated": schemas.INCIDENT_CLEAN,
                 "wzdx_validated": schemas.WZDX_CLEAN}
LANDING_SCHEMAS = {"rwis": schemas.RWIS_LANDING, "incidents": schemas.INCIDENT_LANDING,
                   "wzdx": schemas.WZDX_LANDING}


@dataclass
class Zones:
    root: str

    def landing(self, feed):
        return f"{self.root}/landing/{feed}"

    def clean(self, table):
        return f"{self.root}/clean/{table}"

    def curated(self, table):
        return f"{self.root}/curated/{table}"

    def quarantine(self, feed):
        return f"{self.root}/quarantine/{feed}"

    def dead_letters(self, feed):
        return f"{self.root}/dead_letters/{feed}"


@dataclass
class RunReport:
    metrics: dict = field(default_factory=dict)

    def add(self, name, obs):
        self.metrics[name] = dict(obs.get) if obs is not None else {}


# ------------------------------------------------------------------ ingest
def ingest_snapshots(spark: SparkSession, feed: str, snapshots_path: str, zones: Zones,
                     run_ts=None, report: RunReport | None = None,
                     fail_on_invalid: bool = False, **options) -> None:
    """Raw snapshot files (ArcGIS JSON / GeoJSON / XML) -> landing lines.

    As :func:`ingest_documents`, one document a file; ``xml_reader="spark"``
    reads large incident files with Spark's XML reader instead (split across
    tasks; it skips what it cannot parse, so such files have no dead
    letters)."""
    if feed == "incidents" and options.pop("xml_reader", "text") == "spark":
        from roadlake.sources import read_incident_xml
        attempted = Observation("incidents_attempted") if report is not None else None
        recs = normalize.incident_records(read_incident_xml(spark, snapshots_path), run_ts,
                                          options.pop("ingest_col", "snapshot_ms"), attempted)
        _land(recs, feed, zones, run_ts, report, attempted)
        return
    ingest_documents(spark, feed, read_snapshots(spark, snapshots_path), zones, run_ts, report,
                     fail_on_invalid, **options)


def ingest_documents(spark: SparkSession, feed: str, docs: DataFrame, zones: Zones,
                     run_ts=None, report: RunReport | None = None,
                     fail_on_invalid: bool = False, **options) -> None:
    """Snapshot documents (column ``value``, others as ``read_snapshots``
    gives them) -> landing lines and dead letters.

    ``options`` go to the feed's normaliser (geofence centre/radius, caps,
    ...).  ``mode="raw"`` lands RWIS items un-normalised.  Landing files are
    laid out by arrival (the run time), as a delivery stream does.

    Damaged documents (:mod:`roadlake.sources.damaged`) go to the feed's dead
    letters with their kind and first 400 characters, or, with
    ``fail_on_invalid``, the first one raises before anything is written.  The
    pass that writes the landing counts them; only when there are some are the
    documents read again.  With ``report``, decoded items ("attempted"),
    landed records ("sent") and damaged documents are counted in that pass,
    in every mode."""
    from roadlake.sources import damaged_documents, document_problem, require_sound
    if fail_on_invalid:
        require_sound(docs, feed)
    damage = Observation(f"{feed}_documents")
    checked = docs.withColumn("_problem", document_problem(feed, F.col("value")))
    checked = checked.observe(damage, F.count_if(F.col("_problem").isNotNull()).alias("damaged"))
    sound = checked.where(F.col("_problem").isNull()).drop("_problem")
    attempted = Observation(f"{feed}_attempted") if report is not None else None
    if feed == "rwis" and options.pop("mode", "normalized") == "raw":
        recs = normalize.rwis_raw_records(sound, observation=attempted)
    elif feed == "rwis":
        recs = normalize.normalize_rwis(sound, run_ts=run_ts, observation=attempted, **options)
    elif feed in ("wzdx", "incidents"):
        build = normalize.normalize_wzdx if feed == "wzdx" else normalize.normalize_incidents
        ingest_col = options.pop("ingest_col", "snapshot_ms")
        recs = build(sound, run_ts=run_ts, ingest_col=ingest_col, observation=attempted, **options)
    else:
        raise ValueError(f"unknown feed {feed!r}")
    _land(recs, feed, zones, run_ts, report, attempted)
    damaged = damage.get.get("damaged", 0)
    if damaged:
        write_landing(damaged_documents(docs, feed), zones.dead_letters(feed), arrival_ms=_arrival(run_ts))
    if report is not None:
        report.metrics[f"{feed}_ingest"]["damaged"] = damaged


def _arrival(run_ts) -> int:
    import time
    from roadlake.functions.time import run_ms_of
    return run_ms_of(run_ts) or int(time.time() * 1000)


def _land(recs: DataFrame, feed: str, zones: Zones, run_ts, report, attempted) -> None:
    """Write landing records (or raw lines); count them in the same pass."""
    sent = Observation(f"{feed}_sent") if report is not None else None
    if sent is not None:
        recs = recs.observe(sent, F.count(F.lit(1)).alias("sent"))
    if recs.columns == ["value"]:
        recs.write.mode("append").option("compression", "gzip").text(zones.landing(feed))
    else:
        write_landing(recs, zones.landing(feed), arrival_ms=_arrival(run_ts))
    if report is not None:
        report.metrics[f"{feed}_ingest"] = {"attempted": attempted.get.get("attempted", 0),
                                            "sent": sent.get.get("sent", 0)}


def read_dead_letters(spark: SparkSession, feed: str, zones: Zones) -> DataFrame:
    """Dead letters of a feed: snapshot, snapshot_ms, feed, kind, snippet,
    n_chars."""
    return (spark.read.option("recursiveFileLookup", "true")
            .schema("snapshot string, snapshot_ms long, feed string, kind string, snippet string, n_chars long")
            .json(zones.dead_letters(feed)))


# --------------------------------------------------------- landing -> clean
def landing_to_clean(spark: SparkSession, feed: str, zones: Zones, run_ts=None,
                     require_rows: bool = True, write_mode: str = "replace_partitions",
                     keep_malformed: bool = False, register: bool = False,
                     drop_duplicates: bool = False, database: str | None = None,
                     report: RunReport | None = None) -> str:
    """Clean one feed's whole landing history into its clean table.

    ``drop_duplicates`` removes exact repeated records (re-deliveries); it is
    a hash aggregate with map-side combining, so heavily repeated records
    collapse inside each map task before the shuffle."""
    lines = read_landing_lines(spark, zones.landing(feed))
    schema = LANDING_SCHEMAS[feed]
    line_obs = Observation(f"{feed}_lines")

    def cleaned(observation=None):
        if feed == "rwis":
            return clean.clean_rwis(lines, run_ts=run_ts, keep_malformed=keep_malformed,
                                    observation=observation)
        if feed == "wzdx":
            return clean.clean_wzdx(lines, run_ts=run_ts, keep_malformed=keep_malformed,
                                    observation=observation)
        return clean.clean_incidents(lines, keep_malformed=keep_malformed,
                                     observation=observation)

    if require_rows:
        # probe an un-observed plan: the early-stopping check must not fill
        # the observation that the full write pass reports
        quality.require_rows(cleaned(), f"{feed} clean")
    out = cleaned(line_obs)
    if drop_duplicates:
        out = out.dropDuplicates()
    out, obs = quality.observe_clean(out, f"{feed}_clean")
    table = CLEAN_TABLES[feed]
    write_table(out, zones.clean(table), schemas.PARTITIONS[table], write_mode)
    # the write pass counted the malformed lines; only when there are some
    # is the landing scanned again to keep them aside, and when there are none
    # those of an earlier run go
    if not keep_malformed:
        aside = clean.quarantine(lines, schema)
        if line_obs.get.get("malformed_lines", 0) == 0:
            aside = aside.limit(0) if path_exists(spark, zones.quarantine(feed)) else None
        if aside is not None:
            aside.write.mode("overwrite").option("compression", "gzip").text(zones.quarantine(feed))
    if report is not None:
        report.add(table, obs)
        report.add(f"{feed}_landing", line_obs)
    if register:
        register_table(spark, table, zones.clean(table), database=database,
                       schema=CLEAN_SCHEMAS[table], partition_by=schemas.PARTITIONS[table])
    return zones.clean(table)


# --------------------------------------------------------- clean -> curated
def _read_clean(spark, zones, table):
    return read_table(spark, zones.clean(table), CLEAN_SCHEMAS[table])


def clean_to_curated(spark: SparkSession, feed: str, zones: Zones,
                     history: bool = False, register: bool = False,
                     database: str | None = None,
                     report: RunReport | None = None) -> dict[str, str]:
    """Build one feed's two curated tables from its clean table.

    Latest-state tables are replaced (one row per key) unless ``history``
    appends a snapshot per run; summaries replace the days they cover."""
    latest_mode = "append" if history else "overwrite"
    if feed == "rwis":
        c = _read_clean(spark, zones, "rwis_validated")
        outs = {"rwis_hourly_summary": (curate.rwis_hourly_summary(c), "replace_partitions"),
                "rwis_latest_per_station": (curate.rwis_latest_per_station(c), latest_mode)}
    elif feed == "wzdx":
        c = _read_clean(spark, zones, "wzdx_validated")
        outs = {"wzdx_current_events": (curate.wzdx_current_events(c), latest_mode),
                "wzdx_daily_summary": (curate.wzdx_daily_summary(c), "replace_partitions")}
    else:
        c = _read_clean(spark, zones, "incident_validated")
        cur_path = zones.curated("inc_current_events")
        current = curate.inc_current_events(c)
        write_table(current, cur_path, schemas.PARTITIONS["inc_current_events"], latest_mode)
        # the summary reads the written current table, so both agree exactly
        cur = read_table(spark, cur_path).select(*schemas.INCIDENT_CURRENT_COLS)
        outs = {"inc_daily_summary": (curate.inc_daily_summary(cur), "overwrite")}
    paths, table_schemas = {}, {}
    for name, (df, mode) in outs.items():
        df, obs = quality.observe_clean(df, name) if "dt" in df.columns else (df, None)
        write_table(df, zones.curated(name), schemas.PARTITIONS[name], mode)
        if report is not None and obs is not None:
            report.add(name, obs)
        paths[name], table_schemas[name] = zones.curated(name), df.schema
    if feed == "incidents":
        paths["inc_current_events"] = zones.curated("inc_current_events")
        table_schemas["inc_current_events"] = current.schema
    if register:
        for name, p in paths.items():
            register_table(spark, name, p, database=database, schema=table_schemas[name],
                           partition_by=schemas.PARTITIONS[name])
    return paths


def read_curated(spark: SparkSession, zones: Zones, name: str) -> DataFrame:
    """A curated table read back with its day/snapshot key kept as text."""
    df = read_table(spark, zones.curated(name)).drop("bucket")
    part = schemas.PARTITIONS[name][0]
    return df.withColumn(part, df[part].cast("string"))


def run_feed(spark: SparkSession, feed: str, zones: Zones, run_ts=None,
             report: RunReport | None = None, register: bool = False,
             database: str | None = None, **kw) -> dict[str, str]:
    """landing -> clean -> curated for one feed (clean first, as triggered)."""
    landing_to_clean(spark, feed, zones, run_ts=run_ts, report=report, register=register,
                     database=database, **kw)
    return clean_to_curated(spark, feed, zones, report=report, register=register,
                            database=database)


def run_feed_incremental(spark: SparkSession, feed: str, zones: Zones, run_ts=None,
                         drop_redelivered: bool = True, buckets: int | None = None) -> None:
    """Incremental run: only landing files not seen before are processed.

    An ``availableNow`` stream over the landing folder hands each micro-batch
    of new files to :func:`roadlake.plans.deliveries.apply_delivery`, which
    parses it once and brings it to the clean table, the quarantine, the
    touched days' summaries and the touched buckets of the latest-state table.
    Lines that were delivered before are dropped (``drop_redelivered=False``
    keeps them), and a batch that is replayed replaces itself. A zone root is
    run either incrementally (or by arrival ranges) or with :func:`run_feed`,
    not both: the layouts of their clean and latest-state tables differ."""
    from roadlake.plans.deliveries import BUCKETS, apply_delivery
    lines = (spark.readStream.format("text").option("recursiveFileLookup", "true")
             .load(zones.landing(feed)).select("value"))

    def run(batch, batch_id):
        apply_delivery(spark, feed, zones, batch, f"stream-{batch_id:09d}", run_ts, drop_redelivered,
                       buckets or BUCKETS)

    (lines.writeStream.foreachBatch(run).option("checkpointLocation", f"{zones.root}/_checkpoints/{feed}/deliveries")
     .trigger(availableNow=True).start().awaitTermination())

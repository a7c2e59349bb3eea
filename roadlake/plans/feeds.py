"""Feed snapshots derived from the driver tables.

The driver data set has no transport feeds, so these builders *derive*
them with Spark from its tables — RWIS station readings from ``events``,
incidents from ``events`` + ``nation``, work zones from ``orders`` — as the
raw documents the pollers receive: ArcGIS FeatureSet JSON, GeoJSON
FeatureCollections and CHART incident XML.  Every value is a fixed rule of
the source row, so an independent SQL engine can compute the expected
decoded rows straight from the tables (see :mod:`roadlake.plans.oracle`).
The rules deliberately cover the feeds' quirks: alternative spellings,
numbers vs. text, empty strings, epoch seconds vs. milliseconds vs. ISO
text, missing coordinates, 3-D positions, tag case.

A document holds the rows of one block of consecutive ids (ids are unique),
so its size is bounded by the block whatever the data volume or skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.session import expr_cache, parallelism
from roadlake.sources.xml import xml_escape

# ---- fixed parameters of the derived feeds and of the runs over them -------
RUN_TS = "2024-02-01T00:00:00Z"          # injected processing time
RUN_MS = 1706745600000
WZ_EPOCH_MS = 1704067200000             # 2024-01-01T00:00:00Z, first WZDx poll
GEOFENCE = (39.29, -76.61, 80.0)        # centre lat, centre lon, radius km
RWIS_BLOCK = 256                        # events per ArcGIS snapshot
INCIDENT_BLOCK = 256                    # events per XML snapshot
WZDX_BLOCK = 16                         # orders per GeoJSON snapshot (= 1 poll)
# Precipitation word per event type.
PRECIP_BY_TYPE = {"view": "None", "click": "Rain", "purchase": "Snow",
                  "signup": "Sleet", "error": "Freezing Rain"}
DIRECTIONS_WZ = ["northbound", "southbound", "eastbound", "westbound"]
DIRECTIONS_INC = ["north", "South", "east", "West"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _num(key: str, c: Column) -> Column:
    """``"key":<number>``, or null when c is null (key left out)."""
    return F.concat(F.lit(f'"{key}":'), c.cast("string"))


def _str(key: str, c: Column) -> Column:
    """``"key":"<text>"`` for text without quotes/backslashes (all texts
    generated here are words, numbers and ISO times); null -> left out."""
    return F.concat(F.lit(f'"{key}":"'), c, F.lit('"'))


def _arr(*items: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))


def _object(*members: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _raw(key: str, json_text: Column) -> Column:
    """``"key":<json_text>`` for already-serialised JSON."""
    return F.when(json_text.isNotNull(), F.concat(F.lit(f'"{key}":'), json_text))


def _case(c: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v)))
    return out


def _by_block(df: DataFrame, block: Column) -> DataFrame:
    """Hash-partition the source rows on their snapshot block before the
    per-row JSON building: the building runs on all task slots (a driver
    table may be one file of one row group, which scans as one task) and the
    per-block ``groupBy`` reuses this partitioning, so there is one shuffle.
    The width is the configured shuffle width (data-sized on a cluster);
    the explicit count keeps AQE from merging this CPU-heavy stage."""
    n = parallelism(df.sparkSession)
    return df.withColumn("snapshot", block).repartition(n, "snapshot")


def _in_id_order(id_col: str, item_col: str) -> Column:
    """A block's items listed in id order (blocks are bounded), so "the
    first N items of a snapshot" is well defined."""
    return F.transform(F.array_sort(F.collect_list(F.struct(id_col, item_col))),
                       lambda x: x[item_col])


def _station_lat(u: Column) -> Column:
    return F.lit(38.5) + (u % 30).cast("double") * F.lit(0.05)


def _station_lon(u: Column) -> Column:
    return F.lit(-77.5) + (u % 20).cast("double") * F.lit(0.07)


# ------------------------------------------------------------------ RWIS
def rwis_snapshots(events: DataFrame) -> DataFrame:
    """ArcGIS documents of station readings: ``snapshot`` (block id),
    ``value`` (document text).  Every tenth block is a bare JSON array of
    attribute objects instead of a FeatureSet."""
    item, doc = _rwis_exprs()
    blocks = (_by_block(events, F.floor(F.col("event_id") / RWIS_BLOCK))
              .select("snapshot", "event_id", item.alias("item"))
              .groupBy("snapshot")
              .agg(F.array_join(_in_id_order("event_id", "item"), ",").alias("items")))
    return blocks.select("snapshot", doc.alias("value"))


@expr_cache
def _rwis_exprs():
    i, u, v = F.col("event_id"), F.col("user_id"), F.col("value")
    ts = F.col("ts").cast("timestamp")
    ms = F.unix_millis(ts)
    m4 = i % 4
    report = (F.when(m4 == 0, ms.cast("string"))
              .when(m4 == 1, (ms / 1000).cast("long").cast("string"))
              .when(m4 == 2, F.concat(F.lit('"'), F.date_format(
                  ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit('Z"')))
              .otherwise(F.concat(F.lit('"'), F.date_format(
                  ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit('-05:00"'))))
    word = _case(F.col("event_type"), PRECIP_BY_TYPE)
    m5 = i % 5
    lat, lon = _station_lat(u), _station_lon(u)
    bare = (F.floor(i / RWIS_BLOCK) % 10) == 9
    attrs = _object(
        _num("rowid", i),
        _num("station_id", F.when(i % 3 == 0, u)),
        _str("StationID", F.when(i % 3 == 1, u.cast("string"))),
        _num("stationId", F.when(i % 3 == 2, u)),
        _raw("ReportTime", report),
        _str("AirTemperature", F.when(i % 11 == 0, F.lit(""))
             .when(i % 7 == 0, v.cast("string"))),
        _num("AirTemperature", F.when((i % 11 != 0) & (i % 7 != 0), v)),
        _num("MaxSurfaceTemperature", F.when(i % 6 != 0, v - F.lit(5.0))),
        _num("MinSurfaceTemperature", v - F.lit(8.0)),
        _str("PrecipiationType", F.when(m5 == 0, word).when(m5 == 1, F.lit(""))),
        _str("PrecipitationType", F.when(m5 == 1, word)),
        _str("precipType", F.when(m5 == 2, word).when(m5 == 3, F.lower(word))),
        _num("AvgWindSpeed", (u % 40).cast("double")),
        _num("WindGust", F.when(i % 2 == 0, (u % 40 + 5).cast("double"))),
        _num("LATITUDE", F.when(i % 9 != 0, lat)),
        _num("LONGITUDE", lon),
    )
    geom = _object(_num("x", lon), _num("y", lat))
    item = F.when(bare, attrs).otherwise(
        _object(_raw("attributes", attrs), _raw("geometry", geom)))
    doc = F.when(F.col("snapshot") % 10 == 9,
                 F.concat(F.lit("["), F.col("items"), F.lit("]"))) \
        .otherwise(F.concat(F.lit('{"features":['), F.col("items"), F.lit("]}")))
    return item, doc


# ------------------------------------------------------------- incidents
def _el(tag: str, text: Column) -> Column:
    """``<tag>text</tag>``, ``<tag/>`` for empty text, null for null."""
    return F.when(text.isNull(), F.lit(None)).when(text == "", F.lit(f"<{tag}/>")) \
        .otherwise(F.concat(F.lit(f"<{tag}>"), xml_escape(text), F.lit(f"</{tag}>")))


def incident_snapshots(events: DataFrame, nation: DataFrame) -> DataFrame:
    """CHART XML documents of incident versions (4 consecutive events = 4
    versions of one incident): ``snapshot``, ``value``."""
    e = _by_block(events, F.floor(F.col("event_id") / INCIDENT_BLOCK)).join(
        nation.select(F.col("n_nationkey").cast("long").alias("nk"), F.col("n_name")),
        (F.col("user_id") % 25) == F.col("nk"))
    elem, doc = _incident_exprs()
    blocks = (e.select("snapshot", "event_id", elem.alias("el"))
              .groupBy("snapshot")
              .agg(F.array_join(_in_id_order("event_id", "el"), "").alias("els")))
    return blocks.select("snapshot", doc.alias("value"))


@expr_cache
def _incident_exprs():
    i, u, t = F.col("event_id"), F.col("user_id"), F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    lat = _station_lat(u).cast("string")
    lon = _station_lon(u).cast("string")
    closed = (F.when(t == "purchase", F.when(i % 2 == 0, F.lit("true")).otherwise(F.lit(" Y ")))
              .when(t == "signup", F.lit("maybe")).when(t == "view", F.lit("0"))
              .when(t == "click", F.lit("F")).otherwise(F.lit("no")))
    direction = _case(F.floor(i / 4) % 4, dict(enumerate(DIRECTIONS_INC)))
    alert = F.when(t == "error", F.when(i % 2 == 0, F.lit("Yes")).otherwise(F.lit("1"))) \
        .otherwise(F.lit("N"))
    tag = (F.when(i % 17 == 0, F.lit("TrafficIncident"))
           .when(i % 19 == 0, F.lit("incident")).otherwise(F.lit("Incident")))
    body = F.concat_ws(
        "",
        _el("id", (i - i % 4).cast("string")),
        _el("createTime", F.when(i % 13 != 0, F.date_format(
            ts - F.expr("INTERVAL 1 HOUR"), iso))),
        _el("startDateTime", F.when(i % 3 != 0, F.date_format(ts, iso))
            .otherwise(F.lit("TBD"))),
        _el("closed", closed),
        _el("county", F.col("n_name")),
        _el("description", F.concat(t, F.lit(" near mile "), (i % 100).cast("string"))),
        _el("direction", direction),
        _el("incidentType", t),
        _el("latitude", F.when(i % 5 == 0, F.lit("")).otherwise(lat)),
        _el("lat", F.when(i % 5 == 0, lat)),
        _el("longitude", F.when(i % 7 != 0, lon)),
        _el("lon", F.when(i % 7 == 0, lon)),
        _el("lanesStatus", F.concat((i % 3).cast("string"), F.lit(" of 3 lanes closed"))),
        _el("trafficAlert", alert),
        _el("trafficAlertTextMsg", F.when(t == "error", F.concat(
            F.lit("Alert & notice "), i.cast("string")))),
    )
    elem = F.concat(F.lit("<"), tag, F.lit(">"), body, F.lit("</"), tag, F.lit(">"))
    doc = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><Incidents>'),
                   F.col("els"), F.lit("<Incident/></Incidents>"))
    return elem, doc


# ------------------------------------------------------------------ WZDx
def wzdx_snapshots(orders: DataFrame) -> DataFrame:
    """GeoJSON FeatureCollections of work zones, one per poll:
    ``snapshot``, ``snapshot_ms`` (poll time, hourly), ``value``."""
    feature, doc, snap_ms = _wzdx_exprs()
    blocks = (_by_block(orders, F.floor(F.col("o_orderkey") / WZDX_BLOCK))
              .select("snapshot", "o_orderkey", feature.alias("f"))
              .groupBy("snapshot")
              .agg(F.array_join(_in_id_order("o_orderkey", "f"), ",").alias("fs")))
    return blocks.select("snapshot", snap_ms.alias("snapshot_ms"), doc.alias("value"))


@expr_cache
def _wzdx_exprs():
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    od = F.col("o_orderdate").cast("timestamp")
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    rid = F.when(k % 50 != 0, c.cast("string"))
    m5 = k % 5
    names = F.concat(F.lit('["Route '), (c % 100).cast("string"), F.lit('"]'))
    empty = F.lit("[]")
    word = _case(c % 4, dict(enumerate(DIRECTIONS_WZ)))
    m3 = k % 3
    core = _object(
        _str("road_event_id", F.when(m5 == 0, rid).when(m5 == 1, F.lit(""))),
        _str("id", F.when(m5 == 1, rid)),
        _raw("road_names", F.when(k % 7 == 0, empty).when(k % 2 == 0, names)),
        _str("direction", F.when(m3 == 0, word)),
        _str("directionality", F.when(m3 == 2, word)),
    )
    end = od + F.make_dt_interval(hours=(k % 200).cast("int"))
    props = _object(
        _raw("core_details", core),
        _str("road_event_id", F.when(m5 == 2, rid)),
        _str("id", F.when(m5 == 3, rid)),
        _raw("road_names", F.when((k % 7 == 0) | (k % 2 == 1), names)),
        _str("direction", F.when(m3 == 1, word)),
        _str("start_date", F.concat(F.date_format(od, iso), F.lit("Z"))),
        _str("end_date", F.when(k % 23 == 0, F.lit("TBD"))
             .otherwise(F.concat(F.date_format(end, iso), F.lit("Z")))),
    )
    lat0 = F.lit(38.0) + (c % 100).cast("double") * F.lit(0.01)
    lon0 = F.lit(-77.0) - (c % 50).cast("double") * F.lit(0.01)
    p1 = _arr(lon0.cast("string"), lat0.cast("string"))
    p2 = _arr((lon0 - F.lit(0.03)).cast("string"), (lat0 + F.lit(0.02)).cast("string"))
    p3 = _arr((lon0 - F.lit(0.04)).cast("string"), (lat0 + F.lit(0.05)).cast("string"))
    p1z = _arr(lon0.cast("string"), lat0.cast("string"), F.lit("10.0"))
    gtype = (F.when(k % 11 == 0, F.lit("Point"))
             .when((k % 13 == 0) | (k % 3 != 0) & (k % 17 != 0), F.lit("LineString"))
             .otherwise(F.lit("MultiLineString")))
    coords = (F.when(k % 11 == 0, p1)
              .when(k % 13 == 0, _arr(p1z, p2, p3))
              .when(k % 17 == 0, _arr(F.lit("[]"), _arr(p2, p3)))
              .when(k % 3 == 0, _arr(_arr(p1, p2), _arr(p2, p3)))
              .otherwise(_arr(p1, p2, p3)))
    geom = _object(_str("type", gtype), _raw("coordinates", coords))
    feature = _object(_str("type", F.lit("Feature")),
                      _str("id", F.when(m5 == 4, rid)),
                      _raw("properties", props), _raw("geometry", geom))
    doc = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.col("fs"),
                   F.lit("]}"))
    snap_ms = (F.lit(WZ_EPOCH_MS) + (F.col("snapshot") % 720) * F.lit(3600000)).cast("long")
    return feature, doc, snap_ms

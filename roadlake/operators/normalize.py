"""Feed normalisers: raw snapshot documents -> landing records.

Each normaliser is a few staged projections over exploded feed items (pull
each field once, choose among spellings, then type), built from the
built-in expressions of :mod:`roadlake.functions`.  The expression lists are
built once per Spark context (:func:`roadlake.session.expr_cache`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.functions.enums import surface_status
from roadlake.functions.geo import line_endpoints, within_radius
from roadlake.functions.time import epoch_ms_of_value, now_ms, run_ms_of
from roadlake.functions.values import (digits_id, first_truthy, is_text,
                                       nonempty, text_to_float, to_bool,
                                       to_float, truthy, vdouble, vfield,
                                       vjson, vstring)
from roadlake.schemas import (INCIDENT_LANDING, NO_PRECIP_WORDS, RWIS_LANDING,
                              RWIS_PRECIP_KEYS, RWIS_STATION_KEYS,
                              WZDX_LANDING)
from roadlake.session import expr_cache
from roadlake.sources.arcgis import arcgis_explode
from roadlake.sources.geojson import geojson_explode
from roadlake.sources.xml import xml_explode


# --------------------------------------------------------------------- RWIS
def rwis_fields(items: DataFrame, run_ts=None, no_precip_as_none: bool = False,
                zero_wind_is_value: bool = False,
                report_time_zone: str = "UTC") -> DataFrame:
    """ArcGIS items (``attrs``, ``geom`` variants) -> normalised RWIS fields
    plus ``lat``/``lon`` (kept for the geofence).

    Defaults are faithful to the feed rules; options: ``no_precip_as_none``
    writes precipitation "None" for the no-precipitation spellings (which
    otherwise fall to "Unknown" at the clean clamp); ``zero_wind_is_value``
    keeps an average wind of 0 instead of falling through to the gust;
    ``report_time_zone`` is the zone of report times given as ISO text.

    Built as staged projections (pull each field once, choose among the
    spellings, then type) so no expression is repeated inside another."""
    keep = [c for c in items.columns if c not in ("attrs", "geom", "bare")]
    out = items
    for stage in _rwis_stages(run_ms_of(run_ts), no_precip_as_none, zero_wind_is_value,
                              report_time_zone):
        out = out.select(*keep, *stage)
    return out


@expr_cache
def _rwis_stages(run_ms, no_precip_as_none=False, zero_wind_is_value=False,
                 report_time_zone="UTC"):
    a, g, c = F.col("attrs"), F.col("geom"), F.col
    pulled = {f"st{n}": vfield(a, k) for n, k in enumerate(RWIS_STATION_KEYS)}
    pulled.update({f"pr{n}": vfield(a, k) for n, k in enumerate(RWIS_PRECIP_KEYS)})
    pulled.update(rt=vfield(a, "ReportTime"),
                  air_temp_f=vdouble(a, "AirTemperature"),
                  pavement_temp_f=F.coalesce(vdouble(a, "MaxSurfaceTemperature"),
                                             vdouble(a, "MinSurfaceTemperature")),
                  wa=vfield(a, "AvgWindSpeed"), wg=vfield(a, "WindGust"),
                  lat0=vdouble(a, "LATITUDE"), lon0=vdouble(a, "LONGITUDE"),
                  gx=vdouble(g, "x"), gy=vdouble(g, "y"))
    s1 = [col.alias(n) for n, col in pulled.items()]
    s2 = [
        first_truthy(*[c(f"st{n}") for n in range(len(RWIS_STATION_KEYS))]).alias("st"),
        first_truthy(*[c(f"pr{n}") for n in range(len(RWIS_PRECIP_KEYS))]).alias("pr"),
        (F.coalesce(c("wa"), c("wg")) if zero_wind_is_value
         else first_truthy(c("wa"), c("wg"))).alias("w"),
        epoch_ms_of_value(c("rt"), report_time_zone).alias("ms"),
        "air_temp_f", "pavement_temp_f", "lat0", "lon0", "gx", "gy"]
    need = c("lat0").isNull() | c("lon0").isNull()
    s3 = [
        F.when(truthy(c("st")), digits_id(c("st"))).otherwise(F.lit(-1))
        .cast("int").alias("station_id"),
        F.coalesce(F.nullif(c("ms"), F.lit(0)), now_ms(run_ms)).alias("ts"),
        "air_temp_f", "pavement_temp_f",
        F.when(truthy(c("pr")), vstring(c("pr"))).alias("precip_raw"),
        to_float(c("w")).alias("wind_mph"),
        F.when(need & (c("lat0").isNull() | (c("lat0") == 0)), c("gy"))
        .otherwise(c("lat0")).alias("lat"),
        F.when(need & (c("lon0").isNull() | (c("lon0") == 0)), c("gx"))
        .otherwise(c("lon0")).alias("lon")]
    precip = F.coalesce(c("precip_raw"), F.lit("None"))
    if no_precip_as_none:
        precip = F.when(F.lower(precip).isin(*NO_PRECIP_WORDS), F.lit("None")).otherwise(precip)
    s4 = [
        "station_id", "ts", "air_temp_f", "pavement_temp_f",
        precip.alias("precip_type"),
        "wind_mph",
        surface_status(c("precip_raw"), c("pavement_temp_f")).alias("surface_status"),
        "lat", "lon"]
    return s1, s2, s3, s4


def _attempted(items: DataFrame, observation) -> DataFrame:
    """Count decoded items (the poller's "attempted") in the same pass as
    whatever consumes them, when an ``Observation`` is given."""
    if observation is None:
        return items
    return items.observe(observation, F.count(F.lit(1)).alias("attempted"))


def geofence(df: DataFrame, center_lat: float, center_lon: float,
             radius_km: float, require_coords: bool = False) -> DataFrame:
    """Keep records within ``radius_km`` of the centre (see
    :func:`roadlake.functions.geo.within_radius`)."""
    return df.where(within_radius(F.col("lat"), F.col("lon"), center_lat,
                                  center_lon, radius_km, require_coords))


def normalize_rwis(docs: DataFrame, run_ts=None, center_lat: float = 0.0,
                   center_lon: float = 0.0, radius_km: float = 0.0,
                   value_col: str = "value",
                   keep_coords: bool = False, require_coords: bool = False,
                   no_precip_as_none: bool = False,
                   zero_wind_is_value: bool = False,
                   report_time_zone: str = "UTC", observation=None) -> DataFrame:
    """ArcGIS snapshot documents -> RWIS landing records.

    Decode, normalise, geofence (records without coordinates are kept unless
    ``require_coords``), then drop the coordinates
    (``keep_coords`` keeps them as extra columns)."""
    items = _attempted(arcgis_explode(docs, value_col), observation)
    recs = geofence(rwis_fields(items, run_ts, no_precip_as_none, zero_wind_is_value,
                                report_time_zone),
                    center_lat, center_lon, radius_km, require_coords)
    cols = [f.name for f in RWIS_LANDING.fields]
    return recs.select(*cols, *(["lat", "lon"] if keep_coords else []))


def rwis_raw_records(docs: DataFrame, value_col: str = "value", observation=None) -> DataFrame:
    """Raw pass-through mode: the un-normalised items as JSON lines, without
    geofence.  FeatureSet items are their attributes plus ``_geom``
    (the feature's geometry, ``{}`` when missing); bare-array items are
    written as they are."""
    items = _attempted(arcgis_explode(docs, value_col), observation)
    attrs = F.coalesce(F.to_json(F.col("attrs")), F.lit("{}"))
    attrs = F.when(~attrs.startswith("{"), F.lit("{}")).otherwise(attrs)
    geom = F.coalesce(F.to_json(F.col("geom")), F.lit("{}"))
    body = F.regexp_replace(F.regexp_replace(attrs, r"\}$", ""), r"^\{", "")
    body = F.regexp_replace(F.regexp_replace(
        body, r'(^|,)"_geom":(\{[^{}]*\}|[^,]*)', ""), "^,", "")
    sep = F.when(F.length(body) > 0, F.lit(",")).otherwise(F.lit(""))
    merged = F.concat(F.lit("{"), body, sep, F.lit('"_geom":'), geom, F.lit("}"))
    return items.select(F.when(F.col("bare"), attrs).otherwise(merged).alias("value"))


# --------------------------------------------------------------------- WZDx
def normalize_wzdx(docs: DataFrame, run_ts=None, ingest_col: str | None = None,
                   value_col: str = "value",
                   accept_altitude: bool = False, observation=None) -> DataFrame:
    """GeoJSON FeatureCollection documents -> work-zone landing records.

    ``ingest_ts`` is the poll stamp: column ``ingest_col`` of the documents
    (e.g. ``snapshot_ms``) when given, else the run time."""
    feats = _attempted(geojson_explode(docs, value_col), observation)
    out = feats
    for stage in _wzdx_stages(ingest_col, run_ms_of(run_ts), accept_altitude):
        out = out.select(*stage)
    return out


@expr_cache
def _wzdx_stages(ingest_col, run_ms, accept_altitude):
    f, c = F.col("feature"), F.col
    ingest = c(ingest_col).cast("long") if ingest_col else now_ms(run_ms)
    P, C = "properties", "properties.core_details"

    def leaf(path, kind="variant"):          # read a leaf straight from the feature
        return F.try_variant_get(f, f"$.{path}", kind)

    s3 = [ingest.alias("ingest_ts"),
          leaf(f"{C}.road_event_id").alias("r0"), leaf(f"{C}.id").alias("r1"),
          leaf(f"{P}.road_event_id").alias("r2"), leaf(f"{P}.id").alias("r3"),
          leaf("id").alias("r4"),
          leaf(f"{C}.road_names").alias("n0"), leaf(f"{P}.road_names").alias("n1"),
          leaf(f"{C}.direction").alias("d0"), leaf(f"{P}.direction").alias("d1"),
          leaf(f"{C}.directionality").alias("d2"), leaf(f"{P}.directionality").alias("d3"),
          leaf(f"{P}.start_date", "string").alias("start_date"),
          leaf(f"{P}.end_date", "string").alias("end_date"),
          leaf("geometry.type", "string").alias("gtype"),
          leaf("geometry.coordinates").alias("coords")]
    s4 = ["ingest_ts",
          first_truthy(*[c(f"r{n}") for n in range(5)]).alias("rid"),
          first_truthy(c("n0"), c("n1")).alias("names"),
          first_truthy(*[c(f"d{n}") for n in range(4)]).alias("dir"),
          "start_date", "end_date",
          line_endpoints(c("gtype"), c("coords"), accept_altitude).alias("ends")]
    s5 = ["ingest_ts",
          F.when(vjson(c("rid")) != "null", vstring(c("rid"))).alias("road_event_id"),
          F.try_variant_get(c("names"), "$", "array<string>").alias("road_names"),
          F.when(is_text(c("dir")), F.upper(vstring(c("dir"))))
          .otherwise(vstring(c("dir"))).alias("direction"),
          "start_date", "end_date",
          c("ends.begin_lat").alias("begin_lat"), c("ends.begin_lon").alias("begin_lon"),
          c("ends.end_lat").alias("end_lat"), c("ends.end_lon").alias("end_lon")]
    s6 = [F.col(x.name).cast(x.dataType) for x in WZDX_LANDING.fields]
    return s3, s4, s5, s6


# ---------------------------------------------------------------- incidents
def normalize_incidents(docs: DataFrame, run_ts=None, ingest_col: str | None = None,
                        value_col: str = "value", observation=None) -> DataFrame:
    """CHART XML documents -> incident landing records."""
    rows = _attempted(xml_explode(docs, value_col), observation)
    return incident_records(rows, run_ts, ingest_col)


def incident_records(rows: DataFrame, run_ts=None, ingest_col: str | None = None,
                     observation=None) -> DataFrame:
    """Parsed incident elements (struct column ``x`` of child texts, from
    :func:`xml_explode` or :func:`roadlake.sources.xml.read_incident_xml`)
    -> incident landing records."""
    out = _attempted(rows, observation)
    for stage in _incident_stages(ingest_col, run_ms_of(run_ts)):
        out = out.select(*stage)
    return out


@expr_cache
def _incident_stages(ingest_col, run_ms):
    def t(tag):
        return nonempty(F.col(f"x.{tag}"))

    ingest = F.col(ingest_col).cast("long") if ingest_col else now_ms(run_ms)
    s1 = [ingest.alias("ingest_ts"),
          t("id").alias("event_id"),
          t("createTime").alias("create_time"),
          t("startDateTime").alias("start_time"),
          to_bool(t("closed")).alias("closed"),
          t("county").alias("county"),
          t("description").alias("description"),
          F.upper(t("direction")).alias("direction"),
          t("incidentType").alias("incident_type"),
          text_to_float(F.coalesce(t("latitude"), t("lat"))).alias("lat"),
          text_to_float(F.coalesce(t("longitude"), t("lon"))).alias("lon"),
          t("lanesStatus").alias("lanes_status"),
          to_bool(t("trafficAlert")).alias("traffic_alert"),
          t("trafficAlertTextMsg").alias("traffic_alert_msg")]
    s2 = [F.col(x.name).cast(x.dataType) for x in INCIDENT_LANDING.fields]
    return s1, s2


# ------------------------------------------------------------------ landing
def to_landing_lines(records: DataFrame) -> DataFrame:
    """Landing records -> newline-delimited JSON text (``value``); null
    fields are written as JSON null so every line carries every key."""
    return records.select(F.to_json(F.struct(*records.columns),
                                    {"ignoreNullFields": "false"}).alias("value"))

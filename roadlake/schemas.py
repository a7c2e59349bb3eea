"""Table schemas of the landing, clean and curated zones, and enum values."""

from pyspark.sql import types as T

S, L, D, I, B, TS = (T.StringType(), T.LongType(), T.DoubleType(),
                     T.IntegerType(), T.BooleanType(), T.TimestampType())


def struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- fixed values (must equal the source feeds' vocabulary) ----------------
# Precipitation types kept by the clean job; anything else becomes "Unknown".
PRECIP_ALLOWED = ["None", "Rain", "Snow", "Sleet", "Unknown"]
PRECIP_DEFAULT = "Unknown"
# Surface states kept by the clean job; anything else becomes "unknown".
SURFACE_ALLOWED = ["dry", "wet", "icy", "unknown"]
SURFACE_DEFAULT = "unknown"
# Lower-cased precipitation words that mean "no precipitation" (status dry).
NO_PRECIP_WORDS = ["", "none", "no precip", "no precipitation"]
# Tolerant boolean spellings (after trim + lower-case).
TRUE_WORDS = ["true", "t", "1", "yes", "y"]
FALSE_WORDS = ["false", "f", "0", "no", "n"]
# Pavement temperature (deg F) at or below which a wet surface is icy.
FREEZING_F = 32.0
# Earth radius used by the geofence, km.
EARTH_RADIUS_KM = 6371.0
# Raw RWIS attribute spellings, in order of preference.
RWIS_STATION_KEYS = ["station_id", "StationID", "stationId"]
RWIS_PRECIP_KEYS = ["PrecipiationType", "PrecipitationType", "precipType"]
# CHART incident child tags -> landing field names.
INCIDENT_TAGS = [
    ("id", "event_id"), ("createTime", "create_time"),
    ("startDateTime", "start_time"), ("closed", "closed"),
    ("county", "county"), ("description", "description"),
    ("direction", "direction"), ("incidentType", "incident_type"),
    ("latitude", "latitude"), ("lat", "lat"), ("longitude", "longitude"),
    ("lon", "lon"), ("lanesStatus", "lanes_status"),
    ("trafficAlert", "traffic_alert"),
    ("trafficAlertTextMsg", "traffic_alert_msg"),
]

# ---- landing zone: newline-delimited JSON written by the normalisers --------
RWIS_LANDING = struct(
    ("station_id", I), ("ts", L), ("air_temp_f", D), ("pavement_temp_f", D),
    ("precip_type", S), ("wind_mph", D), ("surface_status", S))

WZDX_LANDING = struct(
    ("ingest_ts", L), ("road_event_id", S), ("road_names", T.ArrayType(S)),
    ("direction", S), ("start_date", S), ("end_date", S),
    ("begin_lat", D), ("begin_lon", D), ("end_lat", D), ("end_lon", D))

INCIDENT_LANDING = struct(
    ("ingest_ts", L), ("event_id", S), ("create_time", S), ("start_time", S),
    ("closed", B), ("county", S), ("description", S), ("direction", S),
    ("incident_type", S), ("lat", D), ("lon", D), ("lanes_status", S),
    ("traffic_alert", B), ("traffic_alert_msg", S))

# ---- clean zone --------------------------------------------------------------
RWIS_CLEAN = struct(
    ("station_id", I), ("event_time", TS), ("dt", S), ("air_temp_f", D),
    ("pavement_temp_f", D), ("precip_type", S), ("wind_mph", D),
    ("surface_status", S))

INCIDENT_CLEAN = struct(
    ("event_id", S), ("event_time", TS), ("dt", S), ("closed", B),
    ("county", S), ("description", S), ("direction", S),
    ("incident_type", S), ("lat", D), ("lon", D), ("lanes_status", S),
    ("traffic_alert", B), ("traffic_alert_msg", S))

WZDX_CLEAN = struct(
    ("road_event_id", S), ("ingest_time", TS), ("dt", S), ("start_time", TS),
    ("end_time", TS), ("road_names", T.ArrayType(S)), ("direction", S),
    ("begin_lat", D), ("begin_lon", D), ("end_lat", D), ("end_lon", D))

# ---- curated zone ------------------------------------------------------------
RWIS_HOURLY = struct(
    ("dt", S), ("station_id", I), ("event_hour", TS),
    ("avg_air_temp_f", D), ("avg_pavement_temp_f", D), ("avg_wind_mph", D),
    ("cnt_dry", L), ("cnt_wet", L), ("cnt_icy", L), ("obs_count", L))

WZDX_DAILY = struct(
    ("dt", S), ("direction", S), ("work_zone_count", L),
    ("min_start_time", TS), ("max_end_time", TS), ("avg_duration_hours", D),
    ("latest_ingest_time", TS))

INCIDENT_DAILY = struct(
    ("dt", S), ("county", S), ("direction", S), ("total_incidents", L),
    ("open_incidents", L), ("closed_incidents", L), ("alert_incidents", L),
    ("latest_event_time", TS))

# Column orders of the curated latest-state tables.
RWIS_LATEST_COLS = [f.name for f in RWIS_CLEAN.fields] + ["snapshot_dt"]
WZDX_CURRENT_COLS = ["snapshot_dt", "road_event_id", "ingest_time",
                     "start_time", "end_time", "road_names", "direction",
                     "begin_lat", "begin_lon", "end_lat", "end_lon"]
INCIDENT_CURRENT_COLS = ["event_id", "snapshot_dt", "event_time", "closed",
                         "county", "description", "direction",
                         "incident_type", "lat", "lon", "lanes_status",
                         "traffic_alert", "traffic_alert_msg"]

# Partition layouts of the zones (reference layout; see sinks).
PARTITIONS = {
    "rwis_validated": ["dt"],
    "incident_validated": ["dt"],
    "wzdx_validated": ["dt"],
    "rwis_hourly_summary": ["dt"],
    "rwis_latest_per_station": ["snapshot_dt"],
    "wzdx_current_events": ["snapshot_dt"],
    "wzdx_daily_summary": ["dt"],
    "inc_current_events": ["snapshot_dt"],
    "inc_daily_summary": ["dt"],
}

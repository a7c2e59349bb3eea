"""Independent SQL (DuckDB dialect) for every registered query.

The expected rows are computed straight from the driver tables with the
feed-derivation rules of :mod:`roadlake.plans.feeds` and the pipeline's
documented semantics — no decoding at all — so a match means the Spark
decoders, normalisers, clean and curate steps agree with plain SQL.
Timestamps are naive UTC; sums are cast to BIGINT (DuckDB widens them).
"""

from __future__ import annotations

from roadlake.plans.feeds import GEOFENCE, INCIDENT_BLOCK

_LAT0 = "(38.5::DOUBLE + CAST({u} % 30 AS DOUBLE) * 0.05::DOUBLE)"
_LON0 = "(-77.5::DOUBLE + CAST({u} % 20 AS DOUBLE) * 0.07::DOUBLE)"

CLAT, CLON, RADIUS = GEOFENCE

RWIS_CTE = f"""
rwis_src AS (
  SELECT event_id AS i, user_id AS u, value AS v, epoch_us(ts) // 1000 AS ms,
         {_LAT0.format(u="user_id")} AS lat0, {_LON0.format(u="user_id")} AS lon0,
         (event_id // 256) % 10 = 9 AS bare,
         CASE event_type WHEN 'view' THEN 'None' WHEN 'click' THEN 'Rain'
              WHEN 'purchase' THEN 'Snow' WHEN 'signup' THEN 'Sleet'
              ELSE 'Freezing Rain' END AS word
  FROM events),
rwis_fields AS (
  SELECT CAST(CASE WHEN i % 3 = 1 THEN u WHEN u = 0 THEN -1 ELSE u END AS INTEGER) AS station_id,
         CASE WHEN i % 4 = 0 THEN ms ELSE (ms // 1000) * 1000 END AS ts,
         CASE WHEN i % 11 = 0 THEN NULL ELSE v END AS air_temp_f,
         CASE WHEN i % 6 = 0 THEN v - 8.0::DOUBLE ELSE v - 5.0::DOUBLE END AS pavement_temp_f,
         CASE WHEN i % 5 = 4 THEN NULL WHEN i % 5 = 3 THEN lower(word) ELSE word END AS precip,
         CASE WHEN u % 40 <> 0 THEN CAST(u % 40 AS DOUBLE)
              WHEN i % 2 = 0 THEN 5.0::DOUBLE END AS wind_mph,
         CASE WHEN i % 9 = 0 AND bare THEN NULL ELSE lat0 END AS lat,
         lon0 AS lon, i
  FROM rwis_src),
rwis_kept AS (
  SELECT *, round(2 * 6371.0::DOUBLE * asin(sqrt(
          pow(sin(radians(lat - {CLAT}::DOUBLE) / 2), 2)
          + cos(radians({CLAT}::DOUBLE)) * cos(radians(lat))
            * pow(sin(radians(lon - ({CLON})::DOUBLE) / 2), 2))), 6) AS distance_km
  FROM rwis_fields
  WHERE lat IS NULL OR lon IS NULL
     OR 2 * 6371.0::DOUBLE * asin(sqrt(
          pow(sin(radians(lat - {CLAT}::DOUBLE) / 2), 2)
          + cos(radians({CLAT}::DOUBLE)) * cos(radians(lat))
            * pow(sin(radians(lon - ({CLON})::DOUBLE) / 2), 2))) <= {RADIUS}::DOUBLE),
rwis_norm AS (
  SELECT station_id, ts, air_temp_f, pavement_temp_f,
         coalesce(precip, 'None') AS precip_type, wind_mph,
         CASE WHEN lower(coalesce(precip, '')) IN ('', 'none', 'no precip', 'no precipitation')
              THEN 'dry' WHEN pavement_temp_f <= 32.0 THEN 'icy' ELSE 'wet' END AS surface_status
  FROM rwis_kept),
rwis_clean AS (
  SELECT station_id, make_timestamp((ts // 1000) * 1000000) AS event_time,
         strftime(make_timestamp((ts // 1000) * 1000000), '%Y-%m-%d') AS dt,
         air_temp_f, pavement_temp_f,
         CASE WHEN precip_type IN ('None', 'Rain', 'Snow', 'Sleet', 'Unknown')
              THEN precip_type ELSE 'Unknown' END AS precip_type,
         wind_mph,
         CASE WHEN surface_status IN ('dry', 'wet', 'icy', 'unknown')
              THEN surface_status ELSE 'unknown' END AS surface_status
  FROM rwis_norm),
rwis_hourly AS (
  SELECT dt, station_id, date_trunc('hour', event_time) AS event_hour,
         avg(air_temp_f) AS avg_air_temp_f, avg(pavement_temp_f) AS avg_pavement_temp_f,
         avg(wind_mph) AS avg_wind_mph,
         CAST(count(*) FILTER (WHERE surface_status = 'dry') AS BIGINT) AS cnt_dry,
         CAST(count(*) FILTER (WHERE surface_status = 'wet') AS BIGINT) AS cnt_wet,
         CAST(count(*) FILTER (WHERE surface_status = 'icy') AS BIGINT) AS cnt_icy,
         CAST(count(*) AS BIGINT) AS obs_count
  FROM rwis_clean WHERE dt IS NOT NULL
  GROUP BY dt, station_id, date_trunc('hour', event_time))"""

INC_CTE = f"""
inc_src AS (
  SELECT e.event_id AS i, e.user_id AS u, e.ts, e.event_type AS t, n.n_name AS county
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25),
inc_norm AS (
  SELECT CAST(i - i % 4 AS VARCHAR) AS event_id,
         CASE WHEN i % 13 <> 0 THEN strftime(date_trunc('second', ts) - INTERVAL 1 HOUR,
                                            '%Y-%m-%dT%H:%M:%S') END AS create_time,
         CASE WHEN i % 3 <> 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S')
              ELSE 'TBD' END AS start_time,
         CASE t WHEN 'purchase' THEN true WHEN 'signup' THEN NULL ELSE false END AS closed,
         county,
         t || ' near mile ' || CAST(i % 100 AS VARCHAR) AS description,
         CASE (i // 4) % 4 WHEN 0 THEN 'NORTH' WHEN 1 THEN 'SOUTH' WHEN 2 THEN 'EAST'
              ELSE 'WEST' END AS direction,
         t AS incident_type,
         {_LAT0.format(u="u")} AS lat, {_LON0.format(u="u")} AS lon,
         CAST(i % 3 AS VARCHAR) || ' of 3 lanes closed' AS lanes_status,
         t = 'error' AS traffic_alert,
         CASE WHEN t = 'error' THEN 'Alert & notice ' || CAST(i AS VARCHAR) END AS traffic_alert_msg,
         i, ts
  FROM inc_src),
inc_clean AS (
  SELECT event_id, event_time, strftime(event_time, '%Y-%m-%d') AS dt, closed, county,
         description, direction, incident_type, lat, lon, lanes_status, traffic_alert,
         traffic_alert_msg
  FROM (SELECT *, CASE WHEN i % 3 <> 0 THEN date_trunc('second', ts)
                       WHEN i % 13 <> 0 THEN date_trunc('second', ts) - INTERVAL 1 HOUR
                       ELSE TIMESTAMP '2024-02-01 00:00:00' END AS event_time
        FROM inc_norm)),
inc_current AS (
  SELECT event_id, strftime(event_time, '%Y-%m-%d') AS snapshot_dt, event_time, closed, county,
         description, direction, incident_type, lat, lon, lanes_status, traffic_alert,
         traffic_alert_msg
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY
          event_time DESC NULLS LAST, dt DESC NULLS LAST, closed DESC NULLS LAST,
          county DESC NULLS LAST, description DESC NULLS LAST, direction DESC NULLS LAST,
          incident_type DESC NULLS LAST, lat DESC NULLS LAST, lon DESC NULLS LAST,
          lanes_status DESC NULLS LAST, traffic_alert DESC NULLS LAST,
          traffic_alert_msg DESC NULLS LAST) AS rn
        FROM inc_clean WHERE event_id IS NOT NULL AND event_time IS NOT NULL)
  WHERE rn = 1),
inc_daily AS (
  SELECT strftime(event_time, '%Y-%m-%d') AS dt, county, direction,
         CAST(count(DISTINCT event_id) AS BIGINT) AS total_incidents,
         CAST(count(*) FILTER (WHERE closed = false) AS BIGINT) AS open_incidents,
         CAST(count(*) FILTER (WHERE closed = true) AS BIGINT) AS closed_incidents,
         CAST(count(*) FILTER (WHERE traffic_alert = true) AS BIGINT) AS alert_incidents,
         max(event_time) AS latest_event_time
  FROM inc_current GROUP BY 1, 2, 3)"""

WZ_CTE = """
wz_src AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS od,
         (38.0::DOUBLE + CAST(o_custkey % 100 AS DOUBLE) * 0.01::DOUBLE) AS lat0,
         (-77.0::DOUBLE - CAST(o_custkey % 50 AS DOUBLE) * 0.01::DOUBLE) AS lon0
  FROM orders),
wz_norm AS (
  SELECT 1704067200000 + ((k // 16) % 720) * 3600000 AS ingest_ts,
         CASE WHEN k % 50 <> 0 THEN CAST(c AS VARCHAR) END AS road_event_id,
         ['Route ' || CAST(c % 100 AS VARCHAR)] AS road_names,
         CASE c % 4 WHEN 0 THEN 'NORTHBOUND' WHEN 1 THEN 'SOUTHBOUND' WHEN 2 THEN 'EASTBOUND'
              ELSE 'WESTBOUND' END AS direction,
         strftime(od, '%Y-%m-%dT%H:%M:%S') || 'Z' AS start_date,
         CASE WHEN k % 23 = 0 THEN 'TBD'
              ELSE strftime(od + INTERVAL 1 HOUR * (k % 200), '%Y-%m-%dT%H:%M:%S') || 'Z'
         END AS end_date,
         CASE WHEN k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0 THEN NULL ELSE lat0 END AS begin_lat,
         CASE WHEN k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0 THEN NULL ELSE lon0 END AS begin_lon,
         CASE WHEN k % 11 = 0 OR k % 13 = 0 THEN NULL ELSE lat0 + 0.05::DOUBLE END AS end_lat,
         CASE WHEN k % 11 = 0 OR k % 13 = 0 THEN NULL ELSE lon0 - 0.04::DOUBLE END AS end_lon,
         k, od
  FROM wz_src),
wz_clean AS (
  SELECT road_event_id, make_timestamp(ingest_ts * 1000) AS ingest_time,
         strftime(make_timestamp(ingest_ts * 1000), '%Y-%m-%d') AS dt,
         od AS start_time,
         CASE WHEN k % 23 = 0 THEN NULL ELSE od + INTERVAL 1 HOUR * (k % 200) END AS end_time,
         road_names, direction, begin_lat, begin_lon, end_lat, end_lon
  FROM wz_norm),
wz_current AS (
  SELECT strftime(ingest_time, '%Y-%m-%d') AS snapshot_dt, road_event_id, ingest_time,
         start_time, end_time, road_names, direction, begin_lat, begin_lon, end_lat, end_lon
  FROM (SELECT *, row_number() OVER (PARTITION BY road_event_id ORDER BY
          ingest_time DESC NULLS LAST, dt DESC NULLS LAST, start_time DESC NULLS LAST,
          end_time DESC NULLS LAST, road_names DESC NULLS LAST, direction DESC NULLS LAST,
          begin_lat DESC NULLS LAST, begin_lon DESC NULLS LAST, end_lat DESC NULLS LAST,
          end_lon DESC NULLS LAST) AS rn
        FROM wz_clean WHERE dt IS NOT NULL)
  WHERE rn = 1),
wz_daily AS (
  SELECT dt, direction, CAST(count(DISTINCT road_event_id) AS BIGINT) AS work_zone_count,
         min(start_time) AS min_start_time, max(end_time) AS max_end_time,
         avg((epoch(end_time) - epoch(start_time)) / 3600.0) AS avg_duration_hours,
         max(ingest_time) AS latest_ingest_time
  FROM wz_clean WHERE dt IS NOT NULL GROUP BY dt, direction)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n"


#: Per day, straight from cleaned readings, work zones and current incidents.
DAYS = """
all_days AS (
  SELECT dt FROM rwis_clean UNION SELECT dt FROM wz_clean UNION SELECT snapshot_dt FROM inc_current),
facts AS (
  SELECT d.dt,
    (SELECT count(DISTINCT station_id) FROM rwis_clean x WHERE x.dt = d.dt) AS stations,
    (SELECT count(*) FROM rwis_clean x WHERE x.dt = d.dt) AS readings,
    (SELECT count(DISTINCT (road_event_id, coalesce(direction, ''))) FROM wz_clean x
      WHERE x.dt = d.dt AND road_event_id IS NOT NULL) AS zones,
    (SELECT count(*) FROM wz_clean x WHERE x.dt = d.dt) AS zone_rows,
    (SELECT count(*) FROM inc_current x WHERE x.snapshot_dt = d.dt) AS current,
    (SELECT count(*) FROM inc_current x WHERE x.snapshot_dt = d.dt AND traffic_alert) AS alerts
  FROM all_days d WHERE d.dt IS NOT NULL)"""

#: Readings by day, station and hour are averaged twice: the mean of hourly means.
WEATHER = """
means AS (
  SELECT dt, avg(air_temp_f) AS m FROM rwis_clean GROUP BY dt, station_id, date_trunc('hour', event_time)),
weather AS (
  SELECT r.dt, count(*) FILTER (WHERE surface_status = 'icy') AS icy,
         count(*) FILTER (WHERE surface_status = 'wet') AS wet,
         count(*) FILTER (WHERE surface_status = 'dry') AS dry,
         (SELECT avg(m) FROM means WHERE means.dt = r.dt) AS temp
  FROM rwis_clean r WHERE r.dt IS NOT NULL GROUP BY r.dt)"""


def oracle_sql() -> dict[str, str]:
    q = {}
    q["rwis_decode"] = _with(RWIS_CTE) + \
        "SELECT station_id, ts, air_temp_f, pavement_temp_f, precip_type, wind_mph, " \
        "surface_status FROM rwis_norm"
    q["rwis_geofence_distance"] = _with(RWIS_CTE) + \
        "SELECT station_id, ts, lat, lon, distance_km FROM rwis_kept"
    q["rwis_clean"] = _with(RWIS_CTE) + "SELECT * FROM rwis_clean"
    q["rwis_hourly_summary"] = _with(RWIS_CTE) + "SELECT * FROM rwis_hourly"
    q["rwis_latest_per_station"] = _with(RWIS_CTE) + """
SELECT station_id, event_time, dt, air_temp_f, pavement_temp_f, precip_type, wind_mph,
       surface_status, dt AS snapshot_dt
FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY
        event_time DESC NULLS LAST, dt DESC NULLS LAST, air_temp_f DESC NULLS LAST,
        pavement_temp_f DESC NULLS LAST, precip_type DESC NULLS LAST,
        wind_mph DESC NULLS LAST, surface_status DESC NULLS LAST) AS rn
      FROM rwis_clean WHERE dt IS NOT NULL)
WHERE rn = 1"""
    q["incident_decode"] = _with(INC_CTE) + """
SELECT 1706745600000 AS ingest_ts, event_id, create_time, start_time, closed, county,
       description, direction, incident_type, lat, lon, lanes_status, traffic_alert,
       traffic_alert_msg FROM inc_norm"""
    q["incident_xml_edges"] = q["incident_decode"]
    q["incident_clean"] = _with(INC_CTE) + "SELECT * FROM inc_clean"
    q["inc_current_events"] = _with(INC_CTE) + "SELECT * FROM inc_current"
    q["inc_daily_summary"] = _with(INC_CTE) + "SELECT * FROM inc_daily"
    q["wzdx_decode"] = _with(WZ_CTE) + """
SELECT ingest_ts, road_event_id, road_names, direction, start_date, end_date,
       begin_lat, begin_lon, end_lat, end_lon FROM wz_norm"""
    q["wzdx_snapshot_check"] = """
SELECT kind, CAST((SELECT count(DISTINCT o_orderkey // 16) FROM orders) AS BIGINT) AS documents
FROM (VALUES ('ok'), ('invalid_json'), ('unexpected_shape')) AS k(kind)"""
    # a truncated copy of each document is damaged everywhere; the other one is
    # JSON of another shape (no items for stations), and no XML
    q["ingest_dead_letters"] = _with(RWIS_CTE, WZ_CTE, INC_CTE) + f""",
docs AS (
  SELECT 'rwis' AS feed, (SELECT count(DISTINCT event_id // 256) FROM events) AS docs, (SELECT count(*) FROM rwis_norm) AS n
  UNION ALL SELECT 'wzdx', (SELECT count(DISTINCT o_orderkey // 16) FROM orders), (SELECT count(*) FROM wz_norm)
  UNION ALL SELECT 'incidents', (SELECT count(DISTINCT event_id // {INCIDENT_BLOCK}) FROM events), (SELECT count(*) FROM inc_norm))
SELECT feed, 'landing' AS sink, 'record' AS kind, n::BIGINT AS n, n::BIGINT AS reported FROM docs
UNION ALL SELECT feed, 'dead_letter', 'invalid_json', docs::BIGINT, docs::BIGINT FROM docs WHERE feed = 'rwis'
UNION ALL SELECT feed, 'dead_letter', k, docs::BIGINT, 2 * docs::BIGINT FROM docs, (VALUES ('invalid_json'), ('unexpected_shape')) AS v(k)
          WHERE feed = 'wzdx'
UNION ALL SELECT feed, 'dead_letter', 'invalid_xml', 2 * docs::BIGINT, 2 * docs::BIGINT FROM docs WHERE feed = 'incidents'"""
    q["rwis_day_counts"] = _with(RWIS_CTE) + \
        'SELECT dt, count(*) AS "rows" FROM rwis_clean WHERE dt IS NOT NULL GROUP BY dt'
    q["wzdx_clean"] = _with(WZ_CTE) + "SELECT * FROM wz_clean"
    q["wzdx_current_events"] = _with(WZ_CTE) + "SELECT * FROM wz_current"
    q["wzdx_daily_summary"] = _with(WZ_CTE) + "SELECT * FROM wz_daily"
    q["daily_coverage_all"] = _with(RWIS_CTE, WZ_CTE, INC_CTE, DAYS) + """
SELECT dt, stations AS rwis_stations, readings AS rwis_obs, zones AS work_zones, current AS incidents,
       alerts AS alert_incidents
FROM facts WHERE readings > 0 AND zone_rows > 0 AND current > 0"""
    q["daily_coverage"] = q["daily_coverage_all"] + " ORDER BY dt DESC LIMIT 365"
    q["weather_vs_incidents_all"] = _with(RWIS_CTE, INC_CTE, WEATHER) + """
SELECT w.dt, count(*) AS total_incidents, count(*) FILTER (WHERE traffic_alert) AS alert_incidents,
       count(*) FILTER (WHERE NOT closed) AS open_incidents, any_value(icy) AS icy_obs, any_value(wet) AS wet_obs,
       any_value(dry) AS dry_obs, any_value(temp) AS avg_air_temp_f
FROM weather w JOIN inc_current c ON c.snapshot_dt = w.dt GROUP BY w.dt"""
    q["weather_vs_incidents"] = q["weather_vs_incidents_all"] + " ORDER BY w.dt DESC LIMIT 60"
    q["county_performance_all"] = _with(INC_CTE) + """
SELECT snapshot_dt AS dt, county, count(*) AS total_incidents,
       count(*) FILTER (WHERE NOT closed) AS open_incidents, count(*) FILTER (WHERE closed) AS closed_incidents,
       count(*) FILTER (WHERE traffic_alert) AS alert_incidents,
       CAST(round(100.0 * count(*) FILTER (WHERE NOT closed) / count(*), 1) AS DOUBLE) AS pct_open_incidents
FROM inc_current GROUP BY snapshot_dt, county"""
    q["county_performance"] = q["county_performance_all"] + \
        " ORDER BY dt DESC, total_incidents DESC, county LIMIT 500"
    q["coverage_gaps"] = _with(RWIS_CTE, WZ_CTE, INC_CTE, DAYS) + """
SELECT dt, readings > 0 AS has_rwis, zone_rows > 0 AS has_wzdx, current > 0 AS has_incidents
FROM facts WHERE NOT (readings > 0 AND zone_rows > 0 AND current > 0)"""
    q["stream_clean_hourly"] = q["rwis_hourly_summary"]
    q["stream_curate_hourly"] = q["rwis_hourly_summary"]
    q["stream_dedupe_hourly"] = q["rwis_hourly_summary"]
    q["stream_county_performance"] = q["county_performance"]
    q["stream_hourly_late"] = q["rwis_hourly_summary"]
    q["zones_redelivered_hourly"] = q["rwis_hourly_summary"]
    q["zones_incremental_latest"] = q["rwis_latest_per_station"]
    q["zones_arrival_range_hourly"] = _with(RWIS_CTE) + """
SELECT * FROM rwis_hourly WHERE event_hour >= '2024-01-08 00:00:00'::TIMESTAMP AND event_hour < '2024-01-22 00:00:00'::TIMESTAMP"""
    q["stream_latest_per_station"] = q["rwis_latest_per_station"]
    q["zones_county_performance"] = q["county_performance"]
    q["zones_incremental_county_performance"] = q["county_performance"]
    q["zones_daily_coverage"] = q["daily_coverage"]
    q["csv_export_roundtrip"] = q["county_performance"]
    q["stream_quarantine"] = """
SELECT CASE WHEN s % 2 = 0 THEN 'garbage-' || s ELSE '{}' END AS value
FROM (SELECT DISTINCT event_id // 256 AS s FROM events)"""
    q["quality_metrics"] = _with(RWIS_CTE) + """
SELECT CAST((SELECT count(*) FROM rwis_norm)
            + (SELECT count(DISTINCT event_id // 256) FROM events) AS BIGINT) AS raw_lines,
       CAST((SELECT count(DISTINCT event_id // 256) FROM events) AS BIGINT) AS malformed_lines,
       CAST((SELECT count(*) FROM rwis_norm WHERE ts IS NULL OR ts = 0) AS BIGINT) AS null_ts_rows,
       CAST(count(*) AS BIGINT) AS "rows",
       CAST(count(*) FILTER (WHERE dt IS NULL) AS BIGINT) AS null_day_rows,
       CAST(count(DISTINCT dt) AS BIGINT) AS distinct_days,
       min(dt) AS first_day, max(dt) AS last_day
FROM rwis_clean"""
    return q

"""Feed normalisers against the edge rows of FIXTURES.md section 5."""

import json

import pytest

from datetime import datetime

from roadlake.operators import clean, normalize
from roadlake.operators.normalize import to_landing_lines
from roadlake.sources.xml import xml_explode

RUN = "2030-01-01T00:00:00Z"
RUN_MS = 1893456000000


def docs(spark, *payloads):
    rows = [(str(n), p if isinstance(p, str) else json.dumps(p)) for n, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "snapshot string, value string")


def featureset(*attrs, geom=None):
    return {"features": [{"attributes": a, "geometry": geom or {}} for a in attrs]}


def rwis(spark, *attrs, geom=None, **kw):
    out = normalize.normalize_rwis(docs(spark, featureset(*attrs, geom=geom)), run_ts=RUN,
                                   keep_coords=True, **kw)
    return [r.asDict() for r in out.collect()]


SAMPLE = {"rowid": 1, "collector_id": 1, "station_id": 2, "ReportTime": 1763359140000,
          "AirTemperature": 42, "MaxSurfaceTemperature": 45, "MinSurfaceTemperature": 32,
          "PrecipiationType": "None", "AvgWindSpeed": 3, "WindGust": 7,
          "LATITUDE": 39.27, "LONGITUDE": -77.32}


def test_docstring_sample(spark):
    r = rwis(spark, SAMPLE, geom={"x": -77.32, "y": 39.27})[0]
    assert r["station_id"] == 2 and r["ts"] == 1763359140000
    assert (r["air_temp_f"], r["pavement_temp_f"], r["wind_mph"]) == (42.0, 45.0, 3.0)
    assert (r["precip_type"], r["surface_status"]) == ("None", "dry")
    c = clean.clean_rwis(to_landing_lines(normalize.normalize_rwis(
        docs(spark, featureset(SAMPLE)), run_ts=RUN))).collect()[0]
    assert c["event_time"] == datetime(2025, 11, 17, 5, 59) and c["dt"] == "2025-11-17"


def test_pavement_wind_precip(spark):
    a = {"station_id": 5, "ReportTime": 1763359140000, "MinSurfaceTemperature": 31,
         "PrecipitationType": "Snow", "AvgWindSpeed": 0, "WindGust": 7}
    r = rwis(spark, a)[0]
    assert (r["pavement_temp_f"], r["precip_type"], r["surface_status"], r["wind_mph"]) == \
        (31.0, "Snow", "icy", 7.0)
    b = dict(a, WindGust=None)
    del b["WindGust"]
    assert rwis(spark, b)[0]["wind_mph"] is None


def test_station_ids(spark):
    vals = [0, "12", "2.0", "x", -5, "0", 12345678901]
    got = [r["station_id"] for r in rwis(spark, *[{"station_id": v, "rowid": i}
                                                 for i, v in enumerate(vals)])]
    assert sorted(got, key=lambda x: (x is None, x)) == [-1, -1, -1, -1, 0, 12, None]
    # falls through the spellings
    assert rwis(spark, {"station_id": 0, "StationID": "", "stationId": 9})[0]["station_id"] == 9


def test_station_id_float_literal(spark):
    # JSON 7.0 is a float (VARIANT DECIMAL(1,0)), printed "7.0": not an id
    assert rwis(spark, {"station_id": 7.0})[0]["station_id"] == -1
    assert rwis(spark, {"station_id": 7})[0]["station_id"] == 7
    # an integer too large for the id column is an integer, nulled by the cast
    assert rwis(spark, {"station_id": 123456789012345678901})[0]["station_id"] is None


def test_surface_rule_and_clamp(spark):
    rows = [{"rowid": 1, "PrecipiationType": "Rain", "MaxSurfaceTemperature": 32.0},
            {"rowid": 2, "PrecipiationType": "Rain", "MaxSurfaceTemperature": 32.1},
            {"rowid": 3, "PrecipiationType": "Rain"},
            {"rowid": 4},
            {"rowid": 5, "PrecipiationType": "rain", "MaxSurfaceTemperature": 50},
            {"rowid": 6, "PrecipiationType": "No Precip"}]
    for r in rows:
        r["ReportTime"] = 1763359140000 + r["rowid"]
    out = {r["ts"] - 1763359140000: r for r in rwis(spark, *rows)}
    assert [out[i]["surface_status"] for i in range(1, 7)] == \
        ["icy", "wet", "wet", "dry", "wet", "dry"]
    assert out[4]["precip_type"] == "None"
    lines = to_landing_lines(normalize.normalize_rwis(docs(spark, featureset(*rows)), run_ts=RUN))
    cl = {r["precip_type"] for r in clean.clean_rwis(lines).collect()}
    assert cl == {"Rain", "None", "Unknown"}


def test_air_temperature_text(spark):
    vals = ["", "null", "abc", "42", " 42 ", 42]
    got = sorted((r["air_temp_f"] for r in rwis(spark, *[
        {"rowid": i, "AirTemperature": v} for i, v in enumerate(vals)])),
        key=lambda x: (x is None, x))
    assert got == [42.0, 42.0, 42.0, None, None, None]


def test_epoch_forms(spark):
    forms = [1763359140000, 1763359140, "2025-11-17T05:59:00Z", "2025-11-17T05:59:00-05:00",
             "2025-11-17T05:59:00.9Z", 1000, "1763359140000", None]
    got = [r["ts"] for r in rwis(spark, *[{"rowid": i, "ReportTime": v}
                                          for i, v in enumerate(forms)])]
    want = [1763359140000] * 5 + [RUN_MS] * 3
    assert sorted(got) == sorted(want)


def test_coordinates_and_geofence(spark):
    a = {"rowid": 1, "LATITUDE": 38.90, "LONGITUDE": -77.04}
    assert len(rwis(spark, a, center_lat=39.29, center_lon=-76.61, radius_km=57)) == 0
    assert len(rwis(spark, a, center_lat=39.29, center_lon=-76.61, radius_km=58)) == 1
    assert len(rwis(spark, a, center_lat=39.29, center_lon=-76.61, radius_km=0)) == 1
    missing = {"rowid": 2, "LONGITUDE": -77.04}
    r = rwis(spark, missing, center_lat=39.29, center_lon=-76.61, radius_km=1)
    assert len(r) == 1 and r[0]["lat"] is None
    assert rwis(spark, missing, center_lat=39.29, center_lon=-76.61, radius_km=1,
                require_coords=True) == []
    # geometry fills the missing coordinate
    r = rwis(spark, missing, geom={"x": -1.0, "y": 38.9})[0]
    assert (r["lat"], r["lon"]) == (38.9, -77.04)


def test_bare_array_and_bad_docs(spark):
    d = docs(spark, [{"station_id": 3, "ReportTime": 1763359140000}], {"layers": []}, "not json")
    out = normalize.normalize_rwis(d, run_ts=RUN).collect()
    assert [r["station_id"] for r in out] == [3]


def test_raw_passthrough(spark):
    d = docs(spark, featureset({"station_id": 3, "_geom": 1}, geom={"x": 1, "y": 2}))
    line = normalize.rwis_raw_records(d).collect()[0]["value"]
    assert json.loads(line) == {"station_id": 3, "_geom": {"x": 1, "y": 2}}


# ------------------------------------------------------------------ WZDx
def wz(spark, *features, **kw):
    d = docs(spark, {"type": "FeatureCollection", "features": list(features)})
    return [r.asDict() for r in normalize.normalize_wzdx(d, run_ts=RUN, **kw).collect()]


def test_line_endpoints(spark):
    cases = [
        ("LineString", [[-77.1, 39.1], [-77.2, 39.2]], (39.1, -77.1, 39.2, -77.2)),
        ("MultiLineString", [[[-77.1, 39.1], [-77.2, 39.2]], [[-77.3, 39.3], [-77.4, 39.4]]],
         (39.1, -77.1, 39.4, -77.4)),
        ("MultiLineString", [[], [[1, 2], [3, 4]]], (None, None, 4.0, 3.0)),
        ("LineString", [[-77.1, 39.1, 5], [-77.2, 39.2]], (None, None, None, None)),
        ("LineString", [[-77.1, 39.1], [-77.2, 39.2, 5]], (39.1, -77.1, None, None)),
        ("LineString", [], (None, None, None, None)),
        ("Point", [-77.1, 39.1], (None, None, None, None)),
    ]
    feats = [{"id": str(n), "properties": {}, "geometry": {"type": t, "coordinates": c}}
             for n, (t, c, _) in enumerate(cases)]
    got = {r["road_event_id"]: (r["begin_lat"], r["begin_lon"], r["end_lat"], r["end_lon"])
           for r in wz(spark, *feats)}
    for n, (_, _, want) in enumerate(cases):
        assert got[str(n)] == want, (n, got[str(n)])
    alt = wz(spark, dict(feats[3]), accept_altitude=True)[0]
    assert (alt["begin_lat"], alt["end_lat"]) == (39.1, 39.2)


def test_work_zone_ids_names_direction(spark):
    f1 = {"properties": {"core_details": {"road_event_id": "", "id": "c1",
                                          "direction": "northbound", "road_names": []},
                         "road_names": ["I-95"], "start_date": "2025-01-01T00:00:00Z"}}
    f2 = {"id": "f1", "properties": {"core_details": {"road_event_id": ""},
                                     "directionality": "eastbound"}}
    f3 = {"properties": {}}
    rows = wz(spark, f1, f2, f3)
    by = {r["road_event_id"]: r for r in rows}
    assert set(by) == {"c1", "f1", None}
    assert by["c1"]["direction"] == "NORTHBOUND" and by["c1"]["road_names"] == ["I-95"]
    assert by["f1"]["direction"] == "EASTBOUND"
    assert by["c1"]["start_date"] == "2025-01-01T00:00:00Z"
    assert all(r["ingest_ts"] == RUN_MS for r in rows)


def test_wzdx_problem(spark):
    from pyspark.sql import functions as F
    from roadlake.sources import geojson_problem
    d = docs(spark, "{bad", {"type": "x"}, {"features": []})
    probs = [r[0] for r in d.select(geojson_problem(F.col("value"))).collect()]
    assert probs[0].startswith("invalid JSON") and probs[1].startswith("unexpected")
    assert probs[2] is None


# ------------------------------------------------------------- incidents
XML = """<?xml version="1.0"?><Incidents>
<Incident><id>1</id><closed> Y </closed><trafficAlert>1</trafficAlert>
  <latitude/><lat>39.1</lat><longitude>-76.5</longitude><direction>north</direction>
  <description>A &amp; B</description></Incident>
<incident><id>2</id><closed>no</closed><trafficAlert>maybe</trafficAlert></incident>
<TrafficIncident><id>3</id><closed>TRUE</closed><trafficAlert>F</trafficAlert></TrafficIncident>
<Incident/>
<Incident>text only</Incident>
</Incidents>"""


def test_incident_xml(spark):
    out = normalize.normalize_incidents(docs(spark, XML), run_ts=RUN).collect()
    by = {r["event_id"]: r for r in out}
    assert set(by) == {"1", "2", "3"}
    assert (by["1"]["closed"], by["1"]["traffic_alert"]) == (True, True)
    assert (by["1"]["lat"], by["1"]["lon"], by["1"]["direction"]) == (39.1, -76.5, "NORTH")
    assert by["1"]["description"] == "A & B"
    assert (by["2"]["closed"], by["2"]["traffic_alert"]) == (False, None)
    assert (by["3"]["closed"], by["3"]["traffic_alert"]) == (True, False)
    assert by["2"]["lat"] is None


def test_incident_time_preference(spark):
    lines = spark.createDataFrame([(json.dumps(r),) for r in [
        {"event_id": "a", "start_time": "bad", "create_time": "2025-11-17T05:59:00",
         "ingest_ts": 1},
        {"event_id": "b", "start_time": "bad", "create_time": "bad", "ingest_ts": 1763359140999},
        {"event_id": "c"},
    ]], "value string")
    out = {r["event_id"]: r for r in clean.clean_incidents(lines).collect()}
    assert out["a"]["event_time"] == datetime(2025, 11, 17, 5, 59)
    assert out["b"]["event_time"] == datetime(2025, 11, 17, 5, 59)
    assert out["c"]["event_time"] is None and out["c"]["dt"] is None


def test_bool_words(spark):
    from pyspark.sql import functions as F
    from roadlake.functions import to_bool
    words = [" Y ", "1", "TRUE", "t", "no", "0", "F", "maybe", "", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(to_bool(F.col("w"))).collect()]
    assert got == [True, True, True, True, False, False, False, None, None, None]


def test_non_object_items_skipped_and_counts(spark):
    from pyspark.sql import functions as F
    from roadlake.sources import arcgis_item_count, incident_count
    d = docs(spark, {"features": [5, {"attributes": {"station_id": 4}}, "x"]})
    assert [r["station_id"] for r in normalize.normalize_rwis(d, run_ts=RUN).collect()] == [4]
    assert d.select(arcgis_item_count(F.col("value"))).collect()[0][0] == 1
    assert docs(spark, XML).select(incident_count(F.col("value"))).collect()[0][0] == 3
    assert len(wz(spark, 7, {"id": "a", "properties": {}})) == 1


def test_ingest_and_run_feed(spark, tmp_dir):
    """Snapshot files -> landing -> clean -> curated, through the zone jobs."""
    import os
    from roadlake.plans import analytics, jobs
    raw = tmp_dir + "/raw"
    for feed, payload in [
        ("rwis", featureset(dict(SAMPLE), dict(SAMPLE, station_id=3))),
        ("wzdx", {"features": [{"id": "z", "properties": {
            "direction": "north", "start_date": "2025-11-17T00:00:00Z",
            "end_date": "2025-11-17T02:00:00Z"}}]}),
        ("incidents", "<Incidents><Incident><id>9</id><county>C</county>"
                      "<startDateTime>2025-11-17T08:00:00</startDateTime>"
                      "<closed>false</closed></Incident></Incidents>")]:
        os.makedirs(f"{raw}/{feed}")
        with open(f"{raw}/{feed}/snap1.txt", "w") as f:
            f.write(payload if isinstance(payload, str) else json.dumps(payload))
    z = jobs.Zones(tmp_dir + "/zones")
    rep = jobs.RunReport()
    for feed in ("rwis", "wzdx", "incidents"):
        stamp = {} if feed == "rwis" else {"ingest_col": None}   # poll time = run time
        jobs.ingest_snapshots(spark, feed, f"{raw}/{feed}", z,
                                  run_ts="2025-11-17T10:00:00Z", **stamp)
        jobs.run_feed(spark, feed, z, run_ts="2025-11-17T10:00:00Z", report=rep)
    assert rep.metrics["rwis_validated"]["out_rows"] == 2
    hourly = jobs.read_curated(spark, z, "rwis_hourly_summary")
    wz_daily = jobs.read_curated(spark, z, "wzdx_daily_summary")
    inc = jobs.read_curated(spark, z, "inc_daily_summary")
    q1 = analytics.daily_coverage(hourly, wz_daily, inc).collect()
    assert [(r["dt"], r["rwis_stations"], r["work_zones"], r["incidents"]) for r in q1] == \
        [("2025-11-17", 2, 1, 1)]
    # the same questions through the command line
    from roadlake.__main__ import main
    cli_q1 = main(["query", "q1", "--root", z.root], spark=spark).collect()
    assert [(r["dt"], r["rwis_obs"]) for r in cli_q1] == [("2025-11-17", 2)]
    cli_q2 = main(["query", "q2", "--root", z.root], spark=spark).collect()
    assert [(r["dt"], r["total_incidents"], r["dry_obs"]) for r in cli_q2] == \
        [("2025-11-17", 1, 2)]
    # re-running the clean job replaces its days: no duplicates
    jobs.run_feed(spark, "rwis", z, run_ts="2025-11-17T10:00:00Z")
    assert jobs.read_curated(spark, z, "rwis_hourly_summary") \
        .agg({"obs_count": "sum"}).collect()[0][0] == 2
    assert jobs.read_curated(spark, z, "rwis_latest_per_station").count() == 2
    # history mode appends one snapshot of the latest table per run
    jobs.clean_to_curated(spark, "rwis", z, history=True)
    assert jobs.read_curated(spark, z, "rwis_latest_per_station").count() == 4


def test_incident_xml_unknown_and_prefixed_children(spark):
    x = ("<r><Incident><foo>1</foo></Incident>"
         "<ns:Incident xmlns:ns='u'><ns:id>7</ns:id></ns:Incident></r>")
    out = normalize.normalize_incidents(docs(spark, x), run_ts=RUN).collect()
    # both elements have children, so both are records; neither child is a
    # known un-prefixed tag, so every field is null (dropped later at curate)
    assert len(out) == 2 and all(r["event_id"] is None for r in out)


def test_bare_items_geometry_and_raw(spark):
    bare = [{"station_id": 3, "_geom": {"x": -1.5, "y": 2.5}}, {"station_id": 4}]
    r = {x["station_id"]: x for x in normalize.normalize_rwis(
        docs(spark, bare), run_ts=RUN, keep_coords=True).collect()}
    assert (r[3]["lat"], r[3]["lon"]) == (2.5, -1.5) and r[4]["lat"] is None
    raw = [json.loads(x[0]) for x in normalize.rwis_raw_records(docs(spark, bare)).collect()]
    assert raw == bare
    fs = normalize.rwis_raw_records(docs(spark, {"features": [{"attributes": {"a": 1}}]}))
    assert json.loads(fs.collect()[0][0]) == {"a": 1, "_geom": {}}


def test_validate_geojson(spark):
    from roadlake.sources import FeedPayloadError, validate_geojson
    good = docs(spark, {"features": []})
    assert validate_geojson(good).count() == 1
    with pytest.raises(FeedPayloadError, match="first 400 chars: {oops"):
        validate_geojson(docs(spark, {"features": []}, "{oops"))


def test_incident_child_tags_exact_case(spark):
    x = "<r><Incident><ID>5</ID><id>6</id><County>X</County></Incident></r>"
    r = normalize.normalize_incidents(docs(spark, x), run_ts=RUN).collect()[0]
    assert (r["event_id"], r["county"]) == ("6", None)


def test_optional_precip_and_wind_rules(spark):
    a = {"station_id": 1, "ReportTime": 1763359140000, "PrecipiationType": "No Precip",
         "AvgWindSpeed": 0, "WindGust": 9}
    faithful = rwis(spark, a)[0]
    assert (faithful["precip_type"], faithful["wind_mph"]) == ("No Precip", 9.0)
    opt = rwis(spark, a, no_precip_as_none=True, zero_wind_is_value=True)[0]
    assert (opt["precip_type"], opt["surface_status"], opt["wind_mph"]) == ("None", "dry", 0.0)


def test_xml_reader_matches_text_decoder(spark, tmp_dir):
    from roadlake.sources import read_incident_xml, read_snapshots
    body = "".join(
        f"<Incident><id>{i}</id><closed>{'yes' if i % 2 else 'no'}</closed>"
        f"<county>C{i % 3}</county><latitude/><lat>39.{i}</lat>"
        f"<startDateTime>2025-11-17T0{i}:00:00</startDateTime></Incident>" for i in range(6))
    with open(f"{tmp_dir}/feed.xml", "w") as f:
        f.write(f"<Incidents>{body}<Incident/></Incidents>")
    via_reader = normalize.incident_records(read_incident_xml(spark, tmp_dir), run_ts=RUN)
    via_text = normalize.normalize_incidents(read_snapshots(spark, tmp_dir), run_ts=RUN)
    key = lambda r: r["event_id"]                                    # noqa: E731
    assert sorted(via_reader.collect(), key=key) == sorted(via_text.collect(), key=key)
    assert via_reader.count() == 6


def test_nested_incidents_both_count(spark):
    x = ("<r><Incident><id>1</id><county>A</county>"
         "<TrafficIncident><id>2</id><county>B</county></TrafficIncident></Incident>"
         "<Incident><id>3</id></Incident></r>")
    out = {r["event_id"]: r["county"] for r in
           normalize.normalize_incidents(docs(spark, x), run_ts=RUN).collect()}
    assert out == {"1": "A", "2": "B", "3": None}


def test_report_time_zone_and_fractional_epoch(spark):
    a = {"station_id": 1, "ReportTime": "2025-11-17T05:59:00"}
    assert rwis(spark, a)[0]["ts"] == 1763359140000
    ny = rwis(spark, a, report_time_zone="America/New_York")[0]["ts"]
    assert ny == 1763359140000 + 5 * 3600 * 1000
    assert rwis(spark, {"station_id": 1, "ReportTime": 1763359140.5})[0]["ts"] == 1763359140000


def test_incident_repeated_child_comment_and_cdata(spark):
    xml = ("<Incidents><Incident><id>1</id><county>a</county><county>b</county><direction/>"
           "<!-- <Incident><id>9</id></Incident> -->"
           "<description><![CDATA[x </Incident> & <b>]]> y</description></Incident>"
           "<Incident><id>2</id></Incident></Incidents>")
    rows = spark.createDataFrame([(xml,)], "value string")
    got = xml_explode(rows).select("x.id", "x.county", "x.direction", "x.description").collect()
    assert [r.id for r in got] == ["1", "2"]
    assert got[0].county == "a" and got[0].description == "x </Incident> & <b> y"
    assert not got[0].direction and got[1].county is None

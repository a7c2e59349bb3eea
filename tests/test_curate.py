"""Clean, curate, questions, sinks, plans and streaming."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roadlake import schemas
from roadlake.operators import clean, curate, quality
from roadlake.plans import analytics


def lines(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_malformed_lines_quarantined(spark):
    good = json.dumps({"station_id": 1, "ts": 1763359140000, "surface_status": "Icy"})
    ls = lines(spark, good, "garbage", "[1]", "{}", "", None)
    out = clean.clean_rwis(ls, run_ts="2030-01-01T00:00:00Z").collect()
    assert len(out) == 1 and out[0]["surface_status"] == "unknown"
    bad = sorted(r[0] for r in clean.quarantine(ls, schemas.RWIS_LANDING).collect())
    assert bad == ["[1]", "garbage", "{}"]
    kept = clean.clean_rwis(ls, run_ts="2030-01-01T00:00:00Z", keep_malformed=True).collect()
    assert len(kept) == 4
    assert {r["event_time"] for r in kept if r["station_id"] is None} == {datetime(2030, 1, 1)}
    m = quality.landing_metrics(clean.parse_landing(ls, schemas.RWIS_LANDING)).collect()[0]
    assert (m["raw_lines"], m["malformed_lines"], m["null_ts_rows"]) == (4, 3, 0)


def test_seconds_truncation(spark):
    ls = lines(spark, json.dumps({"station_id": 1, "ts": 1763359140999}))
    r = clean.clean_rwis(ls).collect()[0]
    assert r["event_time"] == datetime(2025, 11, 17, 5, 59, 0)


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"), (None, 5, "p"), (None, 6, "q"),
         (None, 7, "r")], "k string, t int, v string")
    got = {(r["k"], r["v"]) for r in curate.latest_per_key(df, ["k"], ["t"]).collect()}
    assert got == {("a", "y"), (None, "r")}
    shuffled = df.orderBy(F.rand(7)).repartition(3)
    assert {(r["k"], r["v"]) for r in curate.latest_per_key(shuffled, ["k"], ["t"]).collect()} == got
    keep = curate.latest_per_key(df, ["k"], ["t"], keep_null_keys=True).collect()
    assert len(keep) == 4


def test_latest_plan_prunes_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    plan = curate.latest_per_key(df, ["k"], ["t"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_incident_daily_three_valued(spark):
    cur = spark.createDataFrame(
        [("1", datetime(2025, 1, 1, 1), True, "C", "N", True),
         ("2", datetime(2025, 1, 1, 2), False, "C", "N", False),
         ("3", datetime(2025, 1, 1, 3), None, "C", "N", None)],
        "event_id string, event_time timestamp, closed boolean, county string, "
        "direction string, traffic_alert boolean")
    r = curate.inc_daily_summary(cur).collect()[0]
    assert (r["total_incidents"], r["open_incidents"], r["closed_incidents"],
            r["alert_incidents"]) == (3, 1, 1, 1)


def test_wzdx_duration(spark):
    c = spark.createDataFrame(
        [("z1", datetime(2025, 1, 1), "2025-01-01", datetime(2025, 1, 1, 0),
          datetime(2025, 1, 1, 1, 30), "N"),
         ("z2", datetime(2025, 1, 1), "2025-01-01", datetime(2025, 1, 1, 2),
          datetime(2025, 1, 1, 1), "N"),
         ("z3", datetime(2025, 1, 1), "2025-01-01", datetime(2025, 1, 1), None, "N")],
        "road_event_id string, ingest_time timestamp, dt string, start_time timestamp, "
        "end_time timestamp, direction string")
    r = curate.wzdx_daily_summary(c).collect()[0]
    assert r["work_zone_count"] == 3
    assert r["avg_duration_hours"] == pytest.approx((1.5 - 1.0) / 2)


def _hourly(spark, rows):
    return spark.createDataFrame(rows, "dt string, station_id int, avg_air_temp_f double, "
                                       "obs_count long, cnt_icy long, cnt_wet long, "
                                       "cnt_dry long")


def test_weather_unweighted_mean(spark):
    h = _hourly(spark, [("d", 1, 40.0, 3, 0, 0, 3), ("d", 1, 50.0, 1, 0, 0, 1)])
    inc = spark.createDataFrame([("d", "C", 1, 1, 0, 0)],
                                "dt string, county string, total_incidents long, "
                                "open_incidents long, closed_incidents long, "
                                "alert_incidents long")
    assert analytics.weather_vs_incidents(h, inc).collect()[0]["avg_air_temp_f"] == 45.0
    assert analytics.weather_vs_incidents(h, inc, weighted=True) \
        .collect()[0]["avg_air_temp_f"] == 42.5


def test_county_percent(spark):
    inc = spark.createDataFrame(
        [("d", "A", 8, 1, 0, 0), ("d", "B", 16, 1, 0, 0), ("d", "C", 2000, 1, 0, 0),
         ("d", "Z", 0, 0, 0, 0)],
        "dt string, county string, total_incidents long, open_incidents long, "
        "closed_incidents long, alert_incidents long")
    got = {r["county"]: r["pct_open_incidents"]
           for r in analytics.county_performance(inc).collect()}
    assert got == {"A": 12.5, "B": 6.3, "C": 0.1}


def test_coverage_gaps(spark):
    h = _hourly(spark, [("d1", 1, 1.0, 1, 0, 0, 1), ("d2", 1, 1.0, 1, 0, 0, 1)])
    w = spark.createDataFrame([("d1", 2)], "dt string, work_zone_count long")
    i = spark.createDataFrame([("d1", 1, 0), ("d3", 1, 0)],
                              "dt string, total_incidents long, alert_incidents long")
    g = {r["dt"]: (r["has_rwis"], r["has_wzdx"], r["has_incidents"])
         for r in analytics.coverage_gaps(h, w, i).collect()}
    assert g == {"d2": (True, False, False), "d3": (False, False, True)}
    assert [r["dt"] for r in analytics.daily_coverage(h, w, i).collect()] == ["d1"]


def test_partitioned_write_is_idempotent(spark, tmp_dir):
    from roadlake.sinks import write_table
    from roadlake.sources import read_table
    df = spark.createDataFrame([("2025-01-01", 1), ("2025-01-02", 2)], "dt string, v int")
    p = tmp_dir + "/t"
    write_table(df, p, ["dt"])
    write_table(df.where("dt = '2025-01-02'"), p, ["dt"])      # re-run of one day
    back = read_table(spark, p, df.schema)
    assert sorted((r["dt"], r["v"]) for r in back.collect()) == [("2025-01-01", 1),
                                                                ("2025-01-02", 2)]
    plan = back.where("dt = '2025-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    write_table(df.where("dt = '2025-01-02'"), p, ["dt"], mode="overwrite")
    assert read_table(spark, p, df.schema).count() == 1


def test_empty_guard(spark):
    with pytest.raises(quality.EmptyOutputError):
        quality.require_rows(spark.range(0), "x")


def test_stream_windows_and_dedupe(spark, tmp_dir):
    from roadlake import streaming
    from roadlake.sinks import write_landing
    recs = spark.createDataFrame(
        [(1, 1735689600000 + m * 600000, 40.0, 30.0, "None", 1.0, "dry") for m in range(13)] +
        [(1, 1735689600000, 40.0, 30.0, "None", 1.0, "dry")],          # a repeated delivery
        "station_id int, ts long, air_temp_f double, pavement_temp_f double, "
        "precip_type string, wind_mph double, surface_status string")
    write_landing(recs, tmp_dir + "/landing", arrival_ms=1735689600000)
    rows = streaming.clean_stream(spark, "rwis", tmp_dir + "/landing")
    win = streaming.hourly_windows(
        streaming.dedupe(rows, ["station_id", "event_time"], "10 minutes"), None)
    q = (win.writeStream.format("memory").queryName("rl_win").outputMode("append")
         .option("checkpointLocation", tmp_dir + "/chk").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT event_hour, obs_count FROM rl_win").collect()
    # 13 readings over 2 hours: the first hour (6 readings, duplicate dropped) is
    # closed by the watermark; the second (ends at 02:00) is still open.
    assert [(r["event_hour"], r["obs_count"]) for r in got] == [(datetime(2025, 1, 1, 0), 6)]


def test_late_first_readings_are_kept_and_repeats_dropped_over_triggers(spark, tmp_dir):
    from roadlake import schemas, streaming
    from roadlake.sinks import write_landing
    from roadlake.sources import read_table
    at = 1735732800000                                      # 12:00; the late reading is six hours older
    readings = [(1, at + m * 600000, 40.0) for m in range(6)]
    late = (1, at - 6 * 3600000, 39.0)
    for delivered in (readings, readings[:3] + [late, late], [late]):
        write_landing(spark.createDataFrame(delivered, "station_id int, ts long, air_temp_f double"),
                      tmp_dir + "/landing", arrival_ms=at)
        rows = streaming.clean_stream(spark, "rwis", tmp_dir + "/landing")
        streaming.start_dedupe(spark, rows, ["station_id", "event_time"], tmp_dir + "/table", schemas.RWIS_CLEAN,
                               tmp_dir + "/chk").awaitTermination()
    got = [(r["event_time"].hour, r["air_temp_f"]) for r in read_table(spark, tmp_dir + "/table", schemas.RWIS_CLEAN).collect()]
    assert sorted(got) == [(6, 39.0)] + [(12, 40.0)] * 6


def test_landing_to_clean_counts_and_quarantine(spark, tmp_dir):
    from roadlake.plans import jobs
    z = jobs.Zones(tmp_dir)
    good = json.dumps({"station_id": 1, "ts": 1763359140000})
    lines(spark, good, good, "garbage", "{}").write.text(z.landing("rwis"))
    rep = jobs.RunReport()
    jobs.landing_to_clean(spark, "rwis", z, report=rep)
    assert rep.metrics["rwis_landing"] == {"lines": 4, "malformed_lines": 2}
    assert rep.metrics["rwis_validated"]["out_rows"] == 2
    assert sorted(r[0] for r in spark.read.text(z.quarantine("rwis")).collect()) == \
        ["garbage", "{}"]


def test_incremental_runs(spark, tmp_dir):
    from roadlake.plans import jobs
    from roadlake.sinks import write_landing
    z = jobs.Zones(tmp_dir)
    schema = "station_id int, ts long, air_temp_f double, pavement_temp_f double, " \
             "precip_type string, wind_mph double, surface_status string"

    def deliver(rows, hour_ms):
        write_landing(spark.createDataFrame(rows, schema), z.landing("rwis"), arrival_ms=hour_ms)

    day1, day2 = 1735689600000, 1735776000000
    deliver([(1, day1 + 60000, 40.0, 30.0, "None", 1.0, "dry"),
             (2, day1 + 120000, 41.0, 31.0, "None", 1.0, "dry")], day1)
    jobs.run_feed_incremental(spark, "rwis", z)
    deliver([(1, day2 + 60000, 42.0, 32.0, "Rain", 1.0, "icy")], day2)
    jobs.run_feed_incremental(spark, "rwis", z)
    jobs.run_feed_incremental(spark, "rwis", z)          # nothing new: no change
    hourly = jobs.read_curated(spark, z, "rwis_hourly_summary")
    assert sorted((r["dt"], r["station_id"], r["obs_count"]) for r in hourly.collect()) == \
        [("2025-01-01", 1, 1), ("2025-01-01", 2, 1), ("2025-01-02", 1, 1)]
    latest = {r["station_id"]: r["dt"] for r in
              jobs.read_curated(spark, z, "rwis_latest_per_station").collect()}
    assert latest == {1: "2025-01-02", 2: "2025-01-01"}


def test_incremental_incident_versions_move_days(spark, tmp_dir):
    from roadlake.plans import jobs
    from roadlake.sinks import write_landing
    z = jobs.Zones(tmp_dir)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}"
                       for f in schemas.INCIDENT_LANDING.fields)

    def version(start, closed):
        return (0, "e1", None, start, closed, "C", "d", "N", "t", None, None, None, False, None)

    write_landing(spark.createDataFrame([version("2025-01-01T05:00:00", False)], schema),
                  z.landing("incidents"), arrival_ms=1735689600000)
    jobs.run_feed_incremental(spark, "incidents", z)
    write_landing(spark.createDataFrame([version("2025-01-02T05:00:00", True)], schema),
                  z.landing("incidents"), arrival_ms=1735776000000)
    jobs.run_feed_incremental(spark, "incidents", z)
    cur = jobs.read_curated(spark, z, "inc_current_events").collect()
    assert [(r["event_id"], r["snapshot_dt"], r["closed"]) for r in cur] == \
        [("e1", "2025-01-02", True)]
    daily = jobs.read_curated(spark, z, "inc_daily_summary").collect()
    assert [(r["dt"], r["total_incidents"], r["closed_incidents"]) for r in daily] == \
        [("2025-01-02", 1, 1)]


def test_command_line_jobs(spark, tmp_dir):
    import os
    from roadlake.__main__ import main
    raw = tmp_dir + "/raw/incidents"
    os.makedirs(raw)
    with open(raw + "/s.xml", "w") as f:
        f.write("<Incidents><Incident><id>1</id><county>C</county><closed>no</closed>"
                "<startDateTime>2025-11-17T08:00:00</startDateTime></Incident></Incidents>")
    root = tmp_dir + "/zones"
    main(["ingest", "--feed", "incidents", "--root", root, "--snapshots", raw], spark=spark)
    main(["run", "--feed", "incidents", "--root", root], spark=spark)
    main(["query", "q3", "--root", root, "--csv", tmp_dir + "/q3"], spark=spark)
    back = spark.read.option("header", True).csv(tmp_dir + "/q3").collect()
    assert [(r["dt"], r["county"], r["total_incidents"], r["pct_open_incidents"])
            for r in back] == [("2025-11-17", "C", "1", "100.0")]


def test_ingest_with_spark_xml_reader(spark, tmp_dir):
    import os
    from roadlake.plans import jobs
    raw = tmp_dir + "/raw"
    os.makedirs(raw)
    with open(raw + "/s.xml", "w") as f:
        f.write("<Incidents>" + "".join(
            f"<Incident><id>{i}</id><startDateTime>2025-11-17T0{i}:00:00</startDateTime>"
            f"</Incident>" for i in range(5)) + "</Incidents>")
    z = jobs.Zones(tmp_dir + "/zones")
    jobs.ingest_snapshots(spark, "incidents", raw, z, xml_reader="spark")
    jobs.run_feed(spark, "incidents", z)
    assert jobs.read_curated(spark, z, "inc_current_events").count() == 5


def test_table_metrics_and_day_counts(spark):
    df = spark.createDataFrame([("2025-01-0%d" % (i % 3 + 1),) for i in range(7)] + [(None,)],
                               "dt string")
    m = quality.table_metrics(df).collect()[0]
    assert (m["rows"], m["null_day_rows"], m["distinct_days"], m["first_day"], m["last_day"]) == \
        (8, 1, 3, "2025-01-01", "2025-01-03")
    assert sorted(map(tuple, quality.day_counts(df).collect())) == [
        ("2025-01-01", 3), ("2025-01-02", 2), ("2025-01-03", 2)]


def test_register_in_database(spark, tmp_dir):
    from roadlake.sinks import register_table, write_table
    df = spark.createDataFrame([("2025-01-01", 1), ("2025-01-02", 2)], "dt string, v int")
    write_table(df, tmp_dir + "/t", ["dt"])
    register_table(spark, "t_demo", tmp_dir + "/t", database="roads_curated_test")
    got = spark.sql("SELECT dt, v FROM roads_curated_test.t_demo WHERE dt = '2025-01-02'")
    assert [(str(r[0]), r[1]) for r in got.collect()] == [("2025-01-02", 2)]


def test_incremental_work_zones(spark, tmp_dir):
    from roadlake.plans import jobs
    from roadlake.sinks import write_landing
    z = jobs.Zones(tmp_dir)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}"
                       for f in schemas.WZDX_LANDING.fields)

    def poll(ms, direction):
        write_landing(spark.createDataFrame(
            [(ms, "z1", ["I-95"], direction, "2025-01-01T00:00:00Z", "2025-01-01T02:00:00Z",
              39.0, -77.0, 39.1, -77.1)], schema), z.landing("wzdx"), arrival_ms=ms)
        jobs.run_feed_incremental(spark, "wzdx", z)

    poll(1735689600000, "NORTHBOUND")          # 2025-01-01
    poll(1735776000000, "SOUTHBOUND")          # 2025-01-02: a newer poll of z1
    cur = jobs.read_curated(spark, z, "wzdx_current_events").collect()
    assert [(r["road_event_id"], r["snapshot_dt"], r["direction"]) for r in cur] == \
        [("z1", "2025-01-02", "SOUTHBOUND")]
    daily = sorted((r["dt"], r["direction"], r["work_zone_count"], r["avg_duration_hours"])
                   for r in jobs.read_curated(spark, z, "wzdx_daily_summary").collect())
    assert daily == [("2025-01-01", "NORTHBOUND", 1, 2.0), ("2025-01-02", "SOUTHBOUND", 1, 2.0)]


def test_register_replaces_shadowing_temp_view(spark, tmp_dir):
    from roadlake.sinks import register_table, write_table
    df = spark.createDataFrame([("2025-01-01", 1)], "dt string, v int")
    write_table(df, tmp_dir + "/t", ["dt"])
    register_table(spark, "t_shadow", tmp_dir + "/t", schema=df.schema, partition_by=["dt"])
    spark.createDataFrame([("x", 9)], "dt string, v int").createOrReplaceTempView("t_shadow")
    register_table(spark, "t_shadow", tmp_dir + "/t", schema=df.schema, partition_by=["dt"])
    assert [(r["dt"], r["v"]) for r in spark.table("t_shadow").collect()] == [("2025-01-01", 1)]

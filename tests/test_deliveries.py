"""Incremental deliveries: re-deliveries, replays, buckets, arrival ranges, late windows."""

import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roadlake import schemas
from roadlake.operators import curate
from roadlake.plans import deliveries, jobs
from roadlake.sinks import write_landing

RWIS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RWIS_LANDING.fields)
DAY = 86400000
START = 1735689600000                                       # 2025-01-01


def reading(station, ts, temp=40.0):
    return (station, ts, temp, 30.0, "None", 1.0, "dry")


def deliver(spark, z, rows, at, feed="rwis", schema=RWIS):
    write_landing(spark.createDataFrame(rows, schema), z.landing(feed), arrival_ms=at)


def hourly(spark, z):
    return sorted((r["station_id"], r["event_hour"], r["obs_count"], r["avg_air_temp_f"])
                  for r in jobs.read_curated(spark, z, "rwis_hourly_summary").collect())


def test_redelivered_polls_count_once_and_late_lines_still_come(spark, tmp_dir):
    z = jobs.Zones(tmp_dir)
    first = [reading(1, START + m * 600000) for m in range(4)]
    late = reading(1, START + 30000, 44.0)
    for n, rows in enumerate((first, first + first, [late] + first[:2], [late])):
        deliver(spark, z, rows, START + n * 3600000)
        jobs.run_feed_incremental(spark, "rwis", z)
    assert hourly(spark, z) == [(1, datetime(2025, 1, 1), 5, (4 * 40.0 + 44.0) / 5)]
    assert deliveries.read_clean(spark, "rwis", z).count() == 5


def test_lines_without_time_or_day_and_malformed_lines(spark, tmp_dir):
    z = jobs.Zones(tmp_dir)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.INCIDENT_LANDING.fields)
    rows = [(None, e, None, None, False, "C", "d", "N", "t", None, None, None, False, None) for e in ("e1", "e1", "e2")]
    for n in range(2):
        deliver(spark, z, rows, START + n, "incidents", schema)
        spark.createDataFrame([("junk",), ("{}",), ("{}",)], "value string").write.mode("append").text(z.landing("incidents"))
        jobs.run_feed_incremental(spark, "incidents", z)
    kept = deliveries.read_clean(spark, "incidents", z)
    assert sorted((r["event_id"], r["dt"]) for r in kept.collect()) == [("e1", None), ("e2", None)]
    assert sorted(r["value"] for r in spark.read.text(z.quarantine("incidents")).collect()) == ["junk"] * 2 + ["{}"] * 4


def test_redelivered_lines_are_kept_on_request(spark, tmp_dir):
    z = jobs.Zones(tmp_dir)
    for n in range(2):
        deliver(spark, z, [reading(1, START)], START + n * 3600000)
        jobs.run_feed_incremental(spark, "rwis", z, drop_redelivered=False)
    assert hourly(spark, z)[0][2] == 2


@pytest.mark.parametrize("stop", ["clean", "summary", "merge", "publish"])
def test_a_run_cut_off_anywhere_can_be_repeated(spark, tmp_dir, monkeypatch, stop):
    z = jobs.Zones(tmp_dir)
    lines = lambda rows: spark.createDataFrame(rows, RWIS).select(F.to_json(F.struct("*")).alias("value"))
    deliveries.apply_delivery(spark, "rwis", z, lines([reading(1, START), reading(2, START)]), "b0", buckets=2)
    second = lines([reading(1, START), reading(1, START + 60000, 41.0), reading(3, START + DAY)])
    write, n = deliveries.write_table, [0]
    last = {"clean": 2, "summary": 3, "merge": 4, "publish": 5}[stop]

    def failing(*args, **kw):
        n[0] += 1
        if n[0] == last:
            raise RuntimeError("lost")
        return write(*args, **kw)

    monkeypatch.setattr(deliveries, "write_table", failing)
    with pytest.raises(RuntimeError, match="lost"):
        deliveries.apply_delivery(spark, "rwis", z, second, "b1", buckets=2)
    monkeypatch.setattr(deliveries, "write_table", write)
    for _ in range(2):
        deliveries.apply_delivery(spark, "rwis", z, second, "b1", buckets=2)
    assert [x[:3] for x in hourly(spark, z)] == [(1, datetime(2025, 1, 1), 2), (2, datetime(2025, 1, 1), 1), (3, datetime(2025, 1, 2), 1)]
    latest = {r["station_id"]: r["air_temp_f"] for r in jobs.read_curated(spark, z, "rwis_latest_per_station").collect()}
    assert latest == {1: 41.0, 2: 40.0, 3: 40.0}


def test_the_ledger_reads_two_columns_of_the_touched_days(spark, tmp_dir):
    z = jobs.Zones(tmp_dir)
    deliver(spark, z, [reading(1, START + d * DAY) for d in range(5)], START)
    jobs.run_feed_incremental(spark, "rwis", z)
    held = deliveries.ledger(spark, "rwis", z, ["2025-01-02"], "other")
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_k1:bigint,_k2:bigint>" in plan
    assert "PartitionFilters: [isnotnull(dt" in plan and "(dt#" in plan and held.count() == 1
    assert [os.path.basename(os.path.dirname(os.path.dirname(f))) for f in held.inputFiles()].count("dt=2025-01-02") >= 1


def _files(path):
    return {f for f in glob.glob(path + "/bucket=*/*.parquet")}


def test_untouched_buckets_keep_their_files_and_all_equals_a_rebuild(spark, tmp_dir):
    z = jobs.Zones(tmp_dir)
    deliver(spark, z, [reading(s, START + s * 1000) for s in range(40)], START)
    jobs.run_feed_incremental(spark, "rwis", z, buckets=8)
    path = z.curated("rwis_latest_per_station")
    before = _files(path)
    deliver(spark, z, [reading(7, START + DAY, 50.0), reading(7, START, 1.0)], START + DAY)
    jobs.run_feed_incremental(spark, "rwis", z, buckets=8)
    after = _files(path)
    folder = lambda files: {os.path.dirname(f) for f in files}
    assert len(folder(before - after)) == 1 == len(folder(after - before)) and len(folder(before)) > 4
    rebuilt = curate.rwis_latest_per_station(deliveries.read_clean(spark, "rwis", z))
    got = jobs.read_curated(spark, z, "rwis_latest_per_station").select(*rebuilt.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rebuilt.collect())) and got.count() == 40


def test_arrival_ranges_prune_folders_and_move_the_mark(spark, tmp_dir):
    from roadlake.sources import read_landing_range
    z = jobs.Zones(tmp_dir)
    for d in range(6):
        deliver(spark, z, [reading(1, START + d * DAY + h * 3600000) for h in range(3)], START + d * DAY + 5 * 3600000)
    lines = read_landing_range(spark, z.landing("rwis"), "2025-01-02 00:00:00", "2025-01-03 05:00:00")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "make_timestamp" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert lines.count() == 3
    run = lambda until, **kw: deliveries.run_feed_arrivals(spark, "rwis", z, until, **kw)
    assert run("2025-01-03 00:00:00", since="2025-01-02 00:00:00") and len(hourly(spark, z)) == 3
    assert deliveries.arrival_mark(spark, "rwis", z) == "2025-01-03 00:00:00"
    assert run("2025-01-05 00:00:00") and len(hourly(spark, z)) == 9
    assert not run("2025-01-05 00:00:00")
    assert run("2025-01-04 00:00:00", since="2025-01-01 00:00:00")          # overlaps: only day 1 is new
    assert len(hourly(spark, z)) == 12 and all(x[2] == 1 for x in hourly(spark, z))
    assert deliveries.arrival_mark(spark, "rwis", z) == "2025-01-05 00:00:00"
    with pytest.raises(ValueError, match="arrival folders"):
        spark.createDataFrame([("x",)], "value string").write.text(tmp_dir + "/flat")
        read_landing_range(spark, tmp_dir + "/flat", None, None)


def test_late_readings_reach_closed_windows_and_the_drain_publishes_open_ones(spark, tmp_dir):
    from roadlake import streaming
    landing, base = tmp_dir + "/landing", tmp_dir + "/state"

    def trigger(rows):
        write_landing(spark.createDataFrame(rows, RWIS), landing, arrival_ms=START)
        streaming.start_hourly_state(streaming.clean_stream(spark, "rwis", landing), base, base + "/hourly").awaitTermination()
        return seen()

    def seen():
        return sorted((r["event_hour"].day, r["event_hour"].hour, r["obs_count"], r["avg_air_temp_f"])
                      for r in streaming.read_windows(spark, base + "/hourly").collect())

    hour = 3600000
    assert trigger([reading(1, START + h * hour, 40.0) for h in range(4)]) == [(1, h, 1, 40.0) for h in range(2)]
    late = reading(1, START + 60000, 42.0)                                  # hours late, its window is closed
    assert trigger([late]) == [(1, 0, 2, 41.0), (1, 1, 1, 40.0)]
    # a day later: the open windows close, though the batch does not touch their day
    assert trigger([reading(1, START + 30 * hour, 40.0)]) == [(1, 0, 2, 41.0)] + [(1, h, 1, 40.0) for h in (1, 2, 3)]
    streaming.drain(spark, base, base + "/hourly")
    assert seen() == [(1, 0, 2, 41.0)] + [(1, h, 1, 40.0) for h in (1, 2, 3)] + [(2, 6, 1, 40.0)]
    # a replayed batch counts once
    from roadlake.streaming import windows
    state = windows._state(spark, base)
    assert state.agg(F.sum("obs_count")).first()[0] == 6


# ------------------------------------------------------------------ ingest
def _snapshots(tmp_dir, texts):
    raw = tmp_dir + "/raw"
    os.makedirs(raw)
    for i, t in enumerate(texts):
        with open(f"{raw}/s{i}", "w") as f:
            f.write(t)
    return raw


WZ = '{"features": [{"id": "z%d", "properties": {"core_details": {"direction": "northbound"}}}]}'
XML = "<Incidents><Incident><id>%d</id></Incident></Incidents>"
ARC = '{"features": [{"attributes": {"StationID": %d, "ReportTime": 1735689600000}, "geometry": {}}]}'


@pytest.mark.parametrize("feed, good, damaged", [
    ("wzdx", [WZ % 1, WZ % 2, '{"features": []}'],
      {'{"features": [': "invalid_json", " ": "invalid_json", '{"features": {"a": 1}}': "unexpected_shape", "[]": "unexpected_shape"}),
    ("incidents", [XML % 1, "<a/>", "﻿" + XML % 2], {"<Incidents><Incident><id>1</id>": "invalid_xml", "x" * 900: "invalid_xml"}),
    ("rwis", [ARC % 1, ARC % 2, '{"other": 1}', "[]"], {"<html>": "invalid_json"}),
])
def test_damaged_documents_become_dead_letters(spark, tmp_dir, feed, good, damaged):
    raw, z, report = _snapshots(tmp_dir, good + list(damaged)), jobs.Zones(tmp_dir + "/zones"), jobs.RunReport()
    jobs.ingest_snapshots(spark, feed, raw, z, report=report)
    assert report.metrics[f"{feed}_ingest"] == {"attempted": 2, "sent": 2, "damaged": len(damaged)}
    letters = jobs.read_dead_letters(spark, feed, z).collect()
    assert sorted((r["snippet"], r["kind"], r["n_chars"]) for r in letters) == sorted((t[:400], k, len(t)) for t, k in damaged.items())
    assert all(r["feed"] == feed and "/raw/s" in r["snapshot"] and r["snapshot_ms"] > 0 for r in letters)


def test_fail_on_invalid_raises_before_anything_is_written(spark, tmp_dir):
    from roadlake.sources import FeedPayloadError
    raw, z = _snapshots(tmp_dir, [WZ % 1, "{broken"]), jobs.Zones(tmp_dir + "/zones")
    with pytest.raises(FeedPayloadError, match="invalid_json; first 400 chars: {broken"):
        jobs.ingest_snapshots(spark, "wzdx", raw, z, fail_on_invalid=True)
    assert not os.path.exists(z.landing("wzdx"))


def test_counts_of_raw_mode_and_of_the_xml_reader(spark, tmp_dir):
    z, report = jobs.Zones(tmp_dir + "/zones"), jobs.RunReport()
    jobs.ingest_snapshots(spark, "rwis", _snapshots(tmp_dir + "/a", [ARC % 1, ARC % 2, "oops"]), z, report=report, mode="raw")
    assert report.metrics["rwis_ingest"] == {"attempted": 2, "sent": 2, "damaged": 1}
    jobs.ingest_snapshots(spark, "incidents", _snapshots(tmp_dir + "/b", [XML % 1, XML % 2, XML % 3]), z, report=report, xml_reader="spark")
    assert report.metrics["incidents_ingest"] == {"attempted": 3, "sent": 3}
    assert len(spark.read.text(z.landing("rwis")).collect()) == 2

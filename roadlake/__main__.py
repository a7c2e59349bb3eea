"""Command line for the zone jobs and the three questions (spark-submit friendly).

    python -m roadlake ingest  --feed rwis --root R --snapshots PATH [--radius-km 80 ...]
    python -m roadlake clean   --feed rwis --root R
    python -m roadlake curate  --feed rwis --root R [--history]
    python -m roadlake run     --feed rwis --root R [--incremental]
    python -m roadlake query   q1|q2|q3 --root R [--csv OUT]

``--root`` is the zone root (any Hadoop file system path).  On a cluster the
master comes from spark-submit; ``--master local[8]`` runs locally.
"""

from __future__ import annotations

import argparse
import sys

FEEDS = ("rwis", "wzdx", "incidents")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="roadlake")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    def feed_cmd(name):
        c = sub.add_parser(name)
        c.add_argument("--feed", choices=FEEDS, required=True)
        c.add_argument("--root", required=True)
        c.add_argument("--run-ts", default=None, help="processing time (ISO), default now")
        return c

    i = feed_cmd("ingest")
    i.add_argument("--snapshots", required=True)
    i.add_argument("--center-lat", type=float, default=0.0)
    i.add_argument("--center-lon", type=float, default=0.0)
    i.add_argument("--radius-km", type=float, default=0.0)
    i.add_argument("--raw", action="store_true", help="RWIS raw pass-through mode")
    c = feed_cmd("clean")
    c.add_argument("--keep-malformed", action="store_true")
    c.add_argument("--drop-duplicates", action="store_true")
    u = feed_cmd("curate")
    u.add_argument("--history", action="store_true")
    r = feed_cmd("run")
    r.add_argument("--incremental", action="store_true")
    q = sub.add_parser("query")
    q.add_argument("question", choices=("q1", "q2", "q3"))
    q.add_argument("--root", required=True)
    q.add_argument("--csv", default=None)
    q.add_argument("--limit", type=int, default=None,
                   help="rows of the report, newest first (default: all)")
    return p


def main(argv=None, spark=None):
    args = _parser().parse_args(argv)
    from roadlake.plans import analytics, jobs
    from roadlake.session import build_session
    spark = spark or build_session(args.master)
    z = jobs.Zones(args.root.rstrip("/"))
    if args.cmd == "ingest":
        opts = {}
        if args.feed == "rwis":
            opts = dict(center_lat=args.center_lat, center_lon=args.center_lon,
                        radius_km=args.radius_km)
            if args.raw:
                opts = {"mode": "raw"}
        jobs.ingest_snapshots(spark, args.feed, args.snapshots, z, run_ts=args.run_ts, **opts)
    elif args.cmd == "clean":
        jobs.landing_to_clean(spark, args.feed, z, run_ts=args.run_ts,
                              keep_malformed=args.keep_malformed,
                              drop_duplicates=args.drop_duplicates)
    elif args.cmd == "curate":
        jobs.clean_to_curated(spark, args.feed, z, history=args.history)
    elif args.cmd == "run":
        if args.incremental:
            jobs.run_feed_incremental(spark, args.feed, z, run_ts=args.run_ts)
        else:
            jobs.run_feed(spark, args.feed, z, run_ts=args.run_ts)
    else:
        read = lambda name: jobs.read_curated(spark, z, name)
        if args.question == "q1":
            out = analytics.daily_coverage(read("rwis_hourly_summary"),
                                           read("wzdx_daily_summary"), read("inc_daily_summary"),
                                           limit=args.limit)
        elif args.question == "q2":
            out = analytics.weather_vs_incidents(read("rwis_hourly_summary"),
                                                 read("inc_daily_summary"), limit=args.limit)
        else:
            out = analytics.county_performance(read("inc_daily_summary"), limit=args.limit)
        if args.csv:
            from roadlake.sinks import write_csv
            write_csv(out, args.csv)
        else:
            out.show(50, truncate=False)
        return out
    return None


if __name__ == "__main__":
    main(sys.argv[1:])

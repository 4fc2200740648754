"""Command line: the job the reference schedules, as plain entry points.

    python -m opslake run    --tables /root/testdata/sf0.1 [--root DIR] [--layout range|curve|local|none] [--catalog]
    python -m opslake run    --flights 'VRA/*.csv' --references refs/ [--root DIR]
    python -m opslake stream --inbox VRA/ --references refs/ [--root DIR] [--max-files N]
    python -m opslake report NAME --root DIR [--rows 20] [--city '%Paulo%']
    python -m opslake gate   --root DIR

``--root`` defaults to a folder under ``spark.checkpoint.dir``. The session
comes from ``SparkSession.builder.getOrCreate()`` (spark-submit settings
apply); ``--local N`` starts a local session instead.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession

from opslake.session import apply_recommended, local_session, output_root


def _session(args) -> SparkSession:
    if args.local:
        return local_session(cores=args.local)
    spark = SparkSession.builder.appName("opslake").getOrCreate()
    apply_recommended(spark, cluster=not spark.sparkContext.master.startswith("local"))
    return spark


def _sources(spark, args):
    if args.tables:
        from opslake.plans.lakehouse import from_driver_tables
        return from_driver_tables(spark, args.tables).sources
    from opslake.sources.csv_landing import csv_sources
    return csv_sources(spark, args.flights, args.references)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="opslake")
    p.add_argument("--local", type=int, default=0, help="start a local[N] session")
    p.add_argument("--root", default=None, help="output root (default: under spark.checkpoint.dir)")
    sub = p.add_subparsers(dest="cmd", required=True)

    run = sub.add_parser("run", help="full refresh bronze → silver → contract → gold → gate")
    run.add_argument("--tables", help="driver tables folder (flight-shaped projection)")
    run.add_argument("--flights", help="glob of monthly flight CSV files")
    run.add_argument("--references", help="folder with the registry CSV files")
    run.add_argument("--layout", choices=["range", "curve", "local", "none"], default="range")
    run.add_argument("--catalog", action="store_true", help="register bronze/silver/gold tables by name")

    stream = sub.add_parser("stream", help="incremental load of new flight files")
    stream.add_argument("--inbox", required=True)
    stream.add_argument("--references", required=True)
    stream.add_argument("--max-files", type=int, default=None)

    rep = sub.add_parser("report", help="run one analyst report over the published OBT")
    rep.add_argument("name")
    rep.add_argument("--rows", type=int, default=20)
    rep.add_argument("--city", default="%", help="pattern of the origin city for delays_in_city")

    sub.add_parser("gate", help="run the quality gate over published tables")

    args = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = _session(args)
    root = args.root or output_root(spark)

    if args.cmd == "run":
        from opslake.plans.pipeline import run_full_refresh
        res = run_full_refresh(spark, _sources(spark, args), root,
                               layout=None if args.layout == "none" else args.layout, catalog=args.catalog)
        print(json.dumps({"root": root, "rows": {k: t.rows for k, t in res.tables.items()},
                          "contract": res.contract, "seconds": res.seconds}))
        return 0

    if args.cmd == "stream":
        from opslake.sources.csv_landing import csv_sources
        from opslake.streaming import incremental
        src = csv_sources(spark, f"{args.inbox}/*.csv", args.references)
        q = incremental.start(spark, args.inbox, src, root, max_files_per_trigger=args.max_files)
        q.awaitTermination()
        if q.exception() is not None:
            return 1

    from opslake.plans.lakehouse import Sources
    from opslake.plans.pipeline import published_lakehouse
    pub = published_lakehouse(spark, Sources(None, {}, None, None), root)
    if args.cmd in ("gate", "stream"):
        from opslake.plans.gate import GateFailed, run_gate
        try:
            for r in run_gate(pub):
                print(r)
        except GateFailed as e:
            print(e, file=sys.stderr)
            return 1
        return 0

    from opslake.plans import reports
    over_obt = ("recovery_analysis", "unjudgeable_by_status", "punctuality_by_airline", "top_routes", "top_cancellations",
                "monthly_trend", "hourly_cascade", "cancel_rate_by_route", "recovery_by_month", "worst_hour",
                "carrier_share", "top_carrier_share", "monthly_volume", "volume_span", "recent_routes")
    known = {name: lambda name=name: getattr(reports, name)(pub.obt) for name in over_obt} | {
        "delays_in_city": lambda: reports.delays_in_city(pub.obt, args.city),
        "foreign_cancellations": lambda: reports.foreign_cancellations(pub.fact),
        "registry_coverage": lambda: reports.registry_coverage(pub.marked),
        "quality_summary": lambda: reports.quality_summary(pub),
        "layer_reconcile": lambda: reports.layer_reconcile(pub),
    }
    if args.name not in known:
        print(f"unknown report {args.name}; known: {', '.join(sorted(known))}", file=sys.stderr)
        return 2
    df = known[args.name]()
    df.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())

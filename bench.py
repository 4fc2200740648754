"""Benchmark: prints ONE JSON line.

* ``pipeline_cold`` / ``pipeline_warm`` — full refresh bronze → silver →
  contract → gold → gate, published as Parquet (the headline value is the warm
  run; the reference reports its end-to-end pipeline time).
* ``obt_<report>`` — analyst reports over the published OBT: warm median of 5
  after one cold run (the reference reports OBT aggregation P50).
* ``e2e_<query>`` — catalog queries composed lazily from the raw tables
  (projection, dedup, joins, contract in one plan), executed with the noop
  sink so nothing is collected.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from opslake.plans import catalog, reports  # noqa: E402
from opslake.plans.lakehouse import from_driver_tables  # noqa: E402
from opslake.plans.pipeline import published_lakehouse, run_full_refresh  # noqa: E402
from opslake.session import local_session, shared_root  # noqa: E402

REPORTS = {
    "recovery_analysis": lambda lh: reports.recovery_analysis(lh.obt),
    "unjudgeable_by_status": lambda lh: reports.unjudgeable_by_status(lh.obt),
    "punctuality_by_airline": lambda lh: reports.punctuality_by_airline(lh.obt),
    "top_routes": lambda lh: reports.top_routes(lh.obt),
    "top_cancellations": lambda lh: reports.top_cancellations(lh.obt),
    "monthly_trend": lambda lh: reports.monthly_trend(lh.obt),
    "hourly_cascade": lambda lh: reports.hourly_cascade(lh.obt),
    "cancel_rate_by_route": lambda lh: reports.cancel_rate_by_route(lh.obt),
    "carrier_share": lambda lh: reports.carrier_share(lh.obt),
    "monthly_volume": lambda lh: reports.monthly_volume(lh.obt),
    "foreign_cancellations": lambda lh: reports.foreign_cancellations(lh.fact),
}
E2E = ["contract_metrics", "fact_flights", "obt_flights", "quality_summary", "punctuality_by_airline"]


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=max(2 * cpus, 8), app="opslake-bench")
    base = shared_root(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    os.makedirs(base, exist_ok=True)
    root = tempfile.mkdtemp(prefix="opslake-bench-", dir=base)

    # The test tables are files of one row group, which one task reads. Large tables have many: deal the input
    # to twice as many files as cores first, outside the timings.
    split = os.path.join(root, "input")
    for name in ("lineitem", "orders", "supplier", "nation"):
        table = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
        table.repartition(2 * cpus if name in ("lineitem", "orders") else 1).write.parquet(os.path.join(split, f"{name}.parquet"))
    sf_dir = split

    q: dict[str, float] = {}
    lh = from_driver_tables(spark, sf_dir)
    cold = run_full_refresh(spark, lh.sources, root)
    q["pipeline_cold"] = cold.seconds["total"]
    warm = run_full_refresh(spark, from_driver_tables(spark, sf_dir).sources, root)
    q["pipeline_warm"] = warm.seconds["total"]
    for step in ("bronze", "silver", "contract_dim_fact", "obt", "gate"):
        q[f"pipeline_{step}"] = warm.seconds[step]

    pub = published_lakehouse(spark, lh.sources, root)
    for name, build in REPORTS.items():
        run = lambda: build(pub).collect()
        q[f"obt_{name}_cold"] = timed(run)
        q[f"obt_{name}"] = statistics.median(timed(run) for _ in range(5))

    qs = catalog.queries()
    for name in E2E:
        run = lambda: qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timed(run)
        q[f"e2e_{name}"] = statistics.median(timed(run) for _ in range(3))

    report_p50 = statistics.median(q[f"obt_{n}"] for n in REPORTS)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "pipeline_full_refresh_warm_sec",
        "value": round(q["pipeline_warm"], 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "obt_report_p50_sec": round(report_p50, 3),
        "rows": {k: p.rows for k, p in warm.tables.items()},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

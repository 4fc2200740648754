"""Full refresh: bronze → silver → contract → gold → gate, in dependency order.

Each layer is staged (Parquet, a new version) and the next layer reads the
*written* table: lineage is cut at every layer, a failed executor only
recomputes from the last written table, and Catalyst sees the real file sizes
(so a registry is broadcast only when it is measured small). The contract
metrics ride on the quarantine write (``observe`` below the filter sees every
row); row counts ride on each write. The run ends with the gate, which raises
when an invariant between layers breaks.

The output root defaults to a folder under ``spark.checkpoint.dir`` — the
shared folder the cluster names — never a machine-local temp dir.
"""

from __future__ import annotations

import logging
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Observation, SparkSession

from opslake import spec
from opslake.operators.contract import observe, quarantine
from opslake.operators.publish import Published, commit, current, discard, is_incremental, read_published, register, stage
from opslake.plans import gate, silver
from opslake.plans.lakehouse import Lakehouse, Sources
from opslake.session import output_root

log = logging.getLogger("opslake.pipeline")


@dataclass
class RunResult:
    root: str
    tables: dict[str, Published] = field(default_factory=dict)
    contract: dict[str, int] = field(default_factory=dict)
    parse_losses: dict[str, int] = field(default_factory=dict)
    gate: list[tuple] = field(default_factory=list)
    seconds: dict[str, float] = field(default_factory=dict)


def run_full_refresh(spark: SparkSession, sources: Sources, root: str | None = None,
                     run_gate: bool = True, layout: str | None = "range", catalog: bool = False,
                     parallel: int = 4) -> RunResult:
    """``layout``: "range" (extra range shuffle for disjoint files), "curve" (the same
    along a space-filling curve: filters on airline or scope skip files, too), "local"
    (sort within partitions, no shuffle) or None. ``catalog``: also
    expose every table by name (``bronze.vra``, ``gold.obt_flights`` …).
    ``parallel``: independent tables of a wave are written by concurrent
    Spark jobs (the dependency DAG: bronze → silver → {contract, dimension,
    fact} → OBT → gate)."""
    root = root or output_root(spark)
    if is_incremental(spark, root, "bronze.vra"):
        raise ValueError(f"{root} holds the tables of an incremental load: give the full refresh a root of its own")
    res = RunResult(root=root)
    try:
        _refresh(spark, sources, res, run_gate, layout, parallel)
    except BaseException:
        discard(spark, list(res.tables.values()))
        raise
    t0 = time.time()
    commit(spark, root, list(res.tables.values()))
    res.seconds["commit"] = time.time() - t0
    res.seconds["total"] += res.seconds["commit"]
    if catalog:
        for name in res.tables:
            register(spark, root, name)
    return res


def _refresh(spark: SparkSession, sources: Sources, res: RunResult, run_gate: bool, layout: str | None, parallel: int) -> None:
    """Stage and verify every table of a run."""
    root = res.root
    published: dict = {}

    def lake() -> Lakehouse:
        return Lakehouse(sources, published=dict(published))

    def put(name, build, cluster=False, columns=None):
        df = build() if callable(build) else build
        cluster_by, curve = None, {}
        if cluster and layout:
            lead, split = spec.LAYOUT[name]
            cluster_by = lead if layout == "local" else lead + split
            if layout == "curve":
                # No layer has more rows than bronze. Silver leads with one column; its airline is next.
                curve = {"curve_by": lead if len(lead) > 1 else lead + split[:1], "rows": res.tables["bronze.vra"].rows}
        p = stage(df, root, name, cluster_by=cluster_by, columns=columns, mode=layout or "range", **curve)
        log.info("%s: %s rows in %.1fs", name, f"{p.rows:,}", p.seconds)
        return p

    def wave(jobs):
        """Stage a list of (name, builder, kwargs) concurrently, then read
        every written table back for the next wave."""
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            futures = {name: pool.submit(put, name, build, **kw) for name, build, kw in jobs}
        # All have ended: of a wave that fails, the tables that were written are known, too.
        res.tables |= {name: fut.result() for name, fut in futures.items() if not fut.exception()}
        for name, fut in futures.items():
            published[name] = spark.read.parquet(fut.result().path)

    t0 = time.time()
    # bronze: land as is (flights ∥ registries ∥ seed)
    registry_table = {spec.NATIONAL_AIRLINES_FILE: "bronze.national_airlines",
                      spec.FOREIGN_AIRLINES_FILE: "bronze.foreign_airlines"}
    parse_obs = Observation("bronze:parse_losses")
    wave([("bronze.vra", sources.flights.observe(parse_obs, *silver.parse_loss_metrics()), {})]
         + [(registry_table[f], df, {}) for f, df in sources.airline_registries.items()]
         + [("bronze.aerodromos", sources.aerodromes, {}), ("bronze.operation_codes", sources.codes, {})])
    for check in sources.checks:
        check.verify()
    res.seconds["bronze"] = time.time() - t0

    # silver reads the written bronze
    t1 = time.time()
    reg = {f: published[t] for f, t in registry_table.items() if t in published}
    sources = Sources(published["bronze.vra"], reg, published["bronze.aerodromos"],
                      published["bronze.operation_codes"])
    lh = lake()
    wave([
        ("silver.vra", lambda: lh.silver_flights, {"cluster": True, "columns": spec.SILVER_VRA_COLUMNS}),
        ("silver.airlines", lambda: lh.silver_airlines, {"columns": spec.SILVER_AIRLINE_COLUMNS}),
        ("silver.aerodromes", lambda: lh.silver_aerodromes, {"columns": spec.SILVER_AERODROME_COLUMNS}),
        ("silver.operation_codes", lambda: lh.silver_codes, {}),
    ])
    res.parse_losses = {k: int(v) for k, v in parse_obs.get.items()}
    if any(res.parse_losses.values()):
        log.warning("unparsable times in bronze.vra: %s", res.parse_losses)
    res.seconds["silver"] = time.time() - t1

    # contract ∥ dimension ∥ fact, all from the written silver. The contract is
    # one pass: mark → observe → filter → write quarantine.
    t2 = time.time()
    lh = lake()
    marked, obs = observe(lh.marked, lh.rules, "contract")
    q = quarantine(marked, lh.rules, spec.REASONS_COLUMN, spec.REASON_SEPARATOR, spec.COL_QUARANTINED)
    wave([
        ("silver.vra_quarentena", q, {}),
        ("gold.dim_airport", lambda: lh.dim_airport, {"columns": spec.DIM_AIRPORT_COLUMNS}),
        ("gold.fact_flights", lambda: lh.fact, {"cluster": True, "columns": spec.FACT_COLUMNS}),
    ])
    res.contract = {k: int(v) for k, v in obs.get.items()}
    res.seconds["contract_dim_fact"] = time.time() - t2

    # OBT from the written fact
    t3 = time.time()
    lh = lake()
    wave([("gold.obt_flights", lambda: lh.obt, {"cluster": True, "columns": spec.OBT_COLUMNS})])
    res.seconds["obt"] = time.time() - t3

    if run_gate:
        t4 = time.time()
        res.gate = gate.run_gate(lake())
        res.seconds["gate"] = time.time() - t4
    res.seconds["total"] = time.time() - t0


def published_lakehouse(spark: SparkSession, sources: Sources, root: str) -> Lakehouse:
    """A Lakehouse whose layers are the tables of a previous run or incremental load."""
    names = ["bronze.vra", "silver.vra", "silver.airlines", "silver.aerodromes", "silver.operation_codes",
             "silver.vra_quarentena", "gold.dim_airport", "gold.fact_flights", "gold.obt_flights"]
    now = current(spark, root)
    return Lakehouse(sources, published={n: read_published(spark, root, n, now) for n in names})

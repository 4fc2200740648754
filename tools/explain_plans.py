"""Write PLANS.md: the physical operator trees of the main stages.

    python tools/explain_plans.py [sf_dir]

Gold stages and reports are planned over published tables (the production
path: every layer reads the written one), so sizes are real file sizes.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opslake import spec  # noqa: E402
from opslake.operators.contract import quarantine  # noqa: E402
from opslake.plans import reports  # noqa: E402
from opslake.plans.lakehouse import from_driver_tables  # noqa: E402
from opslake.plans.pipeline import published_lakehouse, run_full_refresh  # noqa: E402
from opslake.session import local_session  # noqa: E402


def tree(df) -> str:
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    body = text.replace("== Physical Plan ==\n", "")
    head = re.split(r"\n\s*\n", body)[0]
    details = {}
    for block in re.split(r"\n(?=\(\d+\) )", body):
        m = re.match(r"\((\d+)\) (Scan parquet|BroadcastExchange|Exchange)", block)
        if m:
            keep = [ln for ln in block.splitlines()[1:]
                    if ln.startswith(("PushedFilters", "ReadSchema", "Arguments"))]
            details[m.group(1)] = [ln[:160] for ln in keep]
    big, small, stack = 0, 0, []
    for line in head.splitlines():
        m = re.search(r"[A-Za-z]", line)
        if not m:
            continue
        indent, name = m.start(), line[m.start():]
        while stack and stack[-1][0] >= indent:
            stack.pop()
        in_build_side = any(b for _, b in stack)
        if name.startswith("Exchange ("):
            small, big = (small + 1, big) if in_build_side else (small, big + 1)
        stack.append((indent, name.startswith("BroadcastExchange")))
    out = [head, f"  -- shuffles on the streamed side: {big}; inside broadcast build sides: {small}; "
                 f"broadcasts: {head.count('BroadcastExchange (')}"]
    for k, lines in details.items():
        out.append(f"  ({k}) " + " | ".join(lines))
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    lh = from_driver_tables(spark, sf)
    root = tempfile.mkdtemp(prefix="plans-")
    run_full_refresh(spark, lh.sources, root, run_gate=False)
    pub = published_lakehouse(spark, lh.sources, root)
    from opslake.plans.lakehouse import Lakehouse
    silver_only = Lakehouse(lh.sources, published={k: v for k, v in pub.published.items()
                                                   if k.startswith(("bronze.", "silver.")) and k != "silver.vra_quarentena"})
    fact_only = Lakehouse(lh.sources, published={k: v for k, v in pub.published.items()
                                                 if k in ("gold.fact_flights", "silver.aerodromes")})
    stages = [
        ("bronze.vra (projection of lineitem ⋈ orders)", lh.bronze_flights),
        ("silver.vra (from published bronze)", Lakehouse(lh.sources, published={"bronze.vra": pub.published["bronze.vra"]}).silver_flights),
        ("quarantine (mark → filter → reasons)", quarantine(silver_only.marked, silver_only.rules,
                                                             spec.REASONS_COLUMN, spec.REASON_SEPARATOR)),
        ("gold.dim_airport", silver_only.dim_airport),
        ("gold.fact_flights", silver_only.fact),
        ("gold.obt_flights (from published fact)", fact_only.obt),
        ("report: punctuality_by_airline over published OBT", reports.punctuality_by_airline(pub.obt)),
        ("report: carrier_share over published OBT", reports.carrier_share(pub.obt)),
        ("report: top_routes over published OBT", reports.top_routes(pub.obt)),
    ]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("# Physical plans\n\nGenerated by `python tools/explain_plans.py` "
                f"(local[*], Spark {spark.version}, `{sf}`). Trees from `explain('formatted')`; under each tree, "
                "the scans' pushed filters / read schema and the exchanges' partitioning.\n")
        for title, df in stages:
            f.write(f"\n## {title}\n\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main()

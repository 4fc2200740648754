"""Post-load quality gate (GT1–GT8, GT10, GT11).

``gate_results`` is a lazy DataFrame with one row per check:
(check_name, severity, passed, observed, detail). Every counter is a scalar
subquery over the layers (global partial aggregates; nothing but one number
per counter reaches the driver). ``run_gate`` collects those few rows, logs
PASS/FAIL and raises once with every failed error-level check.
"""

from __future__ import annotations

import logging
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake import spec
from opslake.functions import non_empty
from opslake.operators.dedup import group_sizes
from opslake.plans.lakehouse import Lakehouse

log = logging.getLogger("opslake.gate")
c = F.col


def _measures(df: DataFrame, **aggregates: Column) -> dict[str, Column]:
    """Several aggregates of one table from ONE pass: a one-row struct read field
    by field (the same scalar subquery is executed once)."""
    row = df.select(F.struct(*[a.cast("long").alias(name) for name, a in aggregates.items()])).scalar()
    return {name: row.getField(name) for name in aggregates}


def counters(lh: Lakehouse) -> dict[str, Column]:
    """Every number the checks need: one scan of each layer. Over a lake that is not stored, the groups of the
    fact and its orphans read the same shuffle: orphans are counted by origin, so no filter is moved below it."""
    keys = lh.flight_spec.dedup_keys
    rows = F.count(F.lit(1))
    conflict = c("departure_punctual") != (c("departure_delay_min") <= lh.flight_spec.punctual_max)
    fact_groups = lh.fact.groupBy(*keys).agg(rows.alias("_n"), F.count_if(conflict).alias("_conflicts"))
    code_groups = lh.silver_codes.groupBy("domain", "code").agg(rows.alias("_n"))
    return {
        **_measures(lh.bronze_flights, bronze=rows, rescued=F.count_if(c(spec.COL_RESCUED).isNotNull())),
        **_measures(group_sizes(lh.silver_flights, keys), silver=F.coalesce(F.sum("_n"), F.lit(0)),
                    surplus=F.coalesce(F.sum(c("_n") - 1), F.lit(0))),
        **_measures(fact_groups, fact=F.coalesce(F.sum("_n"), F.lit(0)), repeated=F.count_if(c("_n") > 1),
                    conflicts=F.coalesce(F.sum("_conflicts"), F.lit(0))),
        **_measures(lh.obt, obt=rows),
        **_measures(lh.quarantine, bad=rows),
        **_measures(_orphans_by_origin(lh.fact, lh.dim_airport), orphans=F.coalesce(F.sum("_n"), F.lit(0))),
        **_measures(code_groups, code_copies=F.coalesce(F.sum(c("_n") - 1), F.lit(0))),
    }


def _orphans_by_origin(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """(icao_origin, _n): the rows of :func:`orphan_rows`, counted by their origin."""
    by_origin = group_sizes(fact, ["icao_origin"])
    known = dim.select(c("icao_airport").alias("_known")).distinct()
    seen = by_origin.join(known, c("icao_origin") == c("_known"), "left")
    return seen.select("icao_origin", F.when(non_empty(c("icao_origin")) & c("_known").isNull(), c("_n")).otherwise(0).alias("_n"))


def orphan_rows(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact rows whose non-empty origin is missing from the dimension (anti join)."""
    return fact.where(non_empty(c("icao_origin"))).join(dim, c("icao_origin") == dim["icao_airport"], "left_anti")


def gate_results(lh: Lakehouse) -> DataFrame:
    # Each counter is evaluated once into a one-row frame (a scalar subquery is
    # not cheap, so Catalyst keeps this projection separate from the checks).
    k = lh.silver_codes.sparkSession.range(1).select(*[v.alias(name) for name, v in counters(lh).items()])
    # (check, severity, passed, observed counter, detail with counters in braces)
    checks = [
        ("bronze_not_empty", "error", c("bronze") > 0, "bronze", "landed rows: {bronze}"),
        ("silver_mirrors_bronze", "error", c("silver") == c("bronze"), "silver",
         "landed {bronze}, mirrored {silver}"),
        ("gold_drops_only_exact_duplicates", "error", c("fact") + c("surplus") == c("silver"), "fact",
         "mirrored {silver}, surplus copies {surplus}, kept {fact}"),
        ("obt_keeps_every_fact_row", "error", c("obt") == c("fact"), "obt", "kept {fact}, wide {obt}"),
        ("quarantine_is_diagnostic", "error", (c("bad") > 0) & (c("bad") < c("silver")), "bad",
         "flagged {bad} out of {silver}"),
        ("fact_grain_unique", "error", c("repeated") == 0, "repeated", "keys held twice or more: {repeated}"),
        ("origin_airports_in_dim", "error", c("orphans") == 0, "orphans", "rows without their origin: {orphans}"),
        ("punctuality_follows_rule", "error", c("conflicts") == 0, "conflicts",
         "flags against the threshold: {conflicts}"),
        ("codes_unique_per_domain", "error", c("code_copies") == 0, "code_copies",
         "codes held twice or more: {code_copies}"),
        ("rescued_rows", "warn", F.lit(True), "rescued", "rows with rescued text: {rescued}"),
    ]

    def detail(text: str) -> Column:
        names = re.findall(r"{(\w+)}", text)
        return F.format_string(re.sub(r"{\w+}", "%d", text), *[c(n) for n in names])

    structs = [
        F.struct(F.lit(name).alias("check_name"), F.lit(sev).alias("severity"), ok.alias("passed"),
                 c(seen).alias("observed"), detail(text).alias("detail"))
        for name, sev, ok, seen, text in checks
    ]
    return k.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


class GateFailed(AssertionError):
    pass


def run_gate(lh: Lakehouse) -> list[tuple[str, str, bool, int, str]]:
    results = [tuple(r) for r in gate_results(lh).collect()]
    for name, severity, passed, observed, detail in results:
        level = logging.INFO if passed else (logging.WARNING if severity == "warn" else logging.ERROR)
        log.log(level, "%s  %s  (%s)", "PASS" if passed else "FAIL", name, detail)
        if severity == "warn" and observed:
            log.warning("%s: %s", name, detail)
    failed = [r[0] for r in results if r[1] == "error" and not r[2]]
    if failed:
        raise GateFailed(f"{len(failed)} data quality check(s) failed: {', '.join(failed)}")
    return results

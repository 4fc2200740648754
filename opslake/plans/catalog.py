"""Named queries: one builder per inventory item, each (spark, root) → DataFrame.

Every query reads the driver tables through the flight-shaped projection, so
its work grows with them. Audit timestamps are dropped from every result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake import spec
from opslake.functions import decimal_comma_to_double, non_empty, null_if_literal, safe_timestamp
from opslake.operators import checksum, contract
from opslake.operators.dedup import distinct_keys, duplicate_surplus, grain_violations, keep_first
from opslake.operators.profile import column_profile
from opslake.plans import gate, gold, reports, silver, views
from opslake.plans.lakehouse import Lakehouse, from_driver_tables
from opslake.sources import csv_landing, opsdata
from opslake.sources.tables import read_table

c = F.col
CITY_PATTERN = "%CITY 1%"


def drop_audit(df: DataFrame) -> DataFrame:
    return df.drop(*[a for a in spec.AUDIT_COLUMNS if a in df.columns])


def _n():
    return F.count(F.lit(1)).alias("flights")


def null_literals(lh: Lakehouse) -> DataFrame:
    """Per time column: literal 'null' markers, and non-empty text that failed
    to parse (a silent loss that shows up only here)."""
    aggs = []
    for raw, name in spec.FLIGHT_SOURCE_COLUMNS:
        if name not in spec.TIMESTAMP_COLUMNS:
            continue
        col = c(f"`{raw}`")
        typed = safe_timestamp(null_if_literal(col, spec.NULL_LITERAL))
        aggs += [
            F.count_if(col == F.lit(spec.NULL_LITERAL)).alias(f"{name}_null_literals"),
            F.count_if(col.isNotNull() & (col != F.lit(spec.NULL_LITERAL)) & typed.isNull()).alias(
                f"{name}_unparsable"),
        ]
    return lh.bronze_flights.agg(*aggs)


def decimal_comma(lh: Lakehouse) -> DataFrame:
    return lh.sources.aerodromes.select("icao", "name", "altitude",
                                        decimal_comma_to_double("altitude").alias("altitude_m"))


def operation_code_usage(lh: Lakehouse) -> DataFrame:
    """Every seed code with the number of flight rows that use it: one scan of
    silver, both code domains exploded, partial-aggregated, then joined to the
    13-row seed (the preserved side)."""
    used = lh.silver_flights.select(F.explode(F.array(
        F.struct(F.lit(spec.DOMAIN_DI).alias("domain"), c("di_code").alias("code")),
        F.struct(F.lit(spec.DOMAIN_LINE_TYPE).alias("domain"), c("line_type_code").alias("code")),
    )).alias("u")).select("u.*").groupBy("domain", "code").agg(_n())
    codes = drop_audit(lh.silver_codes)
    return codes.join(used, ["domain", "code"], "left").select(
        "domain", "code", "description", F.coalesce(c("flights"), F.lit(0)).alias("flights"))


def orphan_airports(lh: Lakehouse) -> DataFrame:
    return gate.orphan_rows(lh.fact, lh.dim_airport).agg(F.count(F.lit(1)).alias("orphan_rows"))


def unused_airports(lh: Lakehouse) -> DataFrame:
    """Dimension rows that no fact row uses in either role (NOT EXISTS)."""
    used = lh.fact.select(F.explode(F.array("icao_origin", "icao_destination")).alias("_code")).distinct()
    dim = drop_audit(lh.dim_airport)
    return dim.join(used, dim["icao_airport"] == used["_code"], "left_anti")


def silver_grain_violations(lh: Lakehouse) -> DataFrame:
    """Keys that silver, which keeps every copy, holds more than once, by number of copies."""
    return (grain_violations(lh.silver_flights, spec.DEDUP_KEYS)
            .groupBy(c("rows").alias("copies")).agg(F.count(F.lit(1)).alias("keys")))


def airports_outside_registry(lh: Lakehouse) -> DataFrame:
    """Flights per airport code and role that the aerodrome registry doesn't know
    (anti join after the codes are grouped, so a busy code is one row)."""
    used = lh.fact.select(F.explode(F.array(*[
        F.struct(F.lit(role).alias("role"), c(f"icao_{role}").alias("icao_airport"))
        for role in ("origin", "destination")])).alias("u")).select("u.*")
    used = used.where(non_empty(c("icao_airport"))).groupBy("role", "icao_airport").agg(_n())
    return used.join(lh.best_aerodrome, c("icao_airport") == c("icao"), "left_anti")


def punctuality_conflicts(lh: Lakehouse, threshold: int = 0) -> DataFrame:
    """Per airline, flights whose departure flag disagrees with ``threshold`` minutes."""
    conflict = c("departure_punctual") != (c("departure_delay_min") <= threshold)
    return lh.fact.where(conflict).groupBy("airline_name").agg(_n())


TYPED = [name for _, name in spec.FLIGHT_SOURCE_COLUMNS]


def content_reconcile(lh: Lakehouse) -> DataFrame:
    """Per file, whether silver holds exactly what bronze does (once typed)."""
    landed = silver.silver_flights(lh.bronze_flights)
    return checksum.reconcile(landed, lh.silver_flights, spec.COL_SOURCE_FILE, TYPED, ("bronze", "silver")).withColumnRenamed(
        spec.COL_SOURCE_FILE, "source_file")


def swapped_lake(lh: Lakehouse) -> Lakehouse:
    """The lake with origin and destination of some silver rows swapped: all counts agree."""
    swap = c("flight_number").cast("long") % 1009 == 0
    rows = lh.silver_flights
    return Lakehouse(lh.sources, lh.flight_spec, published={"silver.vra": rows.withColumns({
        "icao_origin": F.when(swap, c("icao_destination")).otherwise(c("icao_origin")),
        "icao_destination": F.when(swap, c("icao_origin")).otherwise(c("icao_destination"))})})


def rule_patterns(lh: Lakehouse) -> DataFrame:
    month = F.date_format(c("scheduled_departure_date"), "yyyy-MM")
    return contract.rule_patterns(lh.marked, lh.rules, {"source_file": c(spec.COL_SOURCE_FILE), "month": month})


def damaged_lake(lh: Lakehouse) -> Lakehouse:
    """The lake with known damage, so that the gate's checks have something to
    find: silver lost rows, fact repeats rows and has flipped flags, and the
    dimension lost the airports outside the registry."""
    number = c("flight_number").cast("long")
    flags = c("departure_punctual") != (number % 7 == 0)
    return Lakehouse(lh.sources, lh.flight_spec, published={
        "silver.vra": lh.silver_flights.where(number % 11 != 0),
        "silver.vra_quarentena": lh.quarantine,
        "gold.fact_flights": lh.fact.withColumn("departure_punctual", flags).unionByName(
            lh.fact.where(number % 13 == 0)),
        "gold.dim_airport": lh.dim_airport.where("in_anac_registry"),
        "gold.obt_flights": lh.obt,
    })


def _registry() -> dict[str, Callable[[Lakehouse], DataFrame]]:
    keys = spec.DEDUP_KEYS
    return {
        # silver mirror
        "mirror_flights": lambda lh: drop_audit(lh.silver_flights),
        "mirror_airlines": lambda lh: drop_audit(lh.silver_airlines),
        "mirror_aerodromes": lambda lh: drop_audit(lh.silver_aerodromes),
        "operation_codes": operation_code_usage,
        "delay_minutes": lambda lh: lh.silver_flights.groupBy(
            "departure_delay_min", "arrival_delay_min", "minutes_recovered").agg(_n()),
        "null_literals": null_literals,
        "decimal_comma": decimal_comma,
        # contract
        "mark_registry": lambda lh: drop_audit(lh.marked),
        "contract_metrics": lambda lh: lh.contract_metrics,
        "quarantine_rows": lambda lh: drop_audit(lh.quarantine),
        "quarantine_reasons": lambda lh: lh.quarantine.groupBy(spec.REASONS_COLUMN).agg(_n()),
        # dedup and best records
        "dedup_exact": lambda lh: distinct_keys(lh.silver_flights, keys),
        "dedup_survivors": lambda lh: keep_first(lh.silver_flights, keys, [spec.COL_SOURCE_FILE], ["justification_code"]),
        "rule_patterns": rule_patterns,
        "content_reconcile": content_reconcile,
        "content_reconcile_swapped": lambda lh: content_reconcile(swapped_lake(lh)),
        "duplicate_surplus": lambda lh: duplicate_surplus(lh.silver_flights, keys),
        "best_airline": lambda lh: lh.best_airline,
        "best_aerodrome": lambda lh: lh.best_aerodrome,
        # gold
        "dim_airport": lambda lh: drop_audit(lh.dim_airport),
        "fact_flights": lambda lh: drop_audit(lh.fact),
        "flight_scope": lambda lh: lh.fact.groupBy("line_type_code", "flight_scope").agg(_n()),
        "punctuality_flags": lambda lh: lh.fact.groupBy(
            "departure_punctual", "arrival_punctual", "delay_out_of_range").agg(_n()),
        "plausibility": lambda lh: lh.fact.groupBy("delay_out_of_range").agg(
            _n(),
            F.min("departure_delay_min").alias("min_dep_delay"), F.max("departure_delay_min").alias("max_dep_delay"),
            F.min("arrival_delay_min").alias("min_arr_delay"), F.max("arrival_delay_min").alias("max_arr_delay"),
        ),
        "code_labels": lambda lh: lh.fact.groupBy(
            "di_code", "di_description", "line_type_code", "line_type_description").agg(_n()),
        "calendar_fields": lambda lh: lh.fact.groupBy("day_of_week", "scheduled_departure_hour").agg(_n()),
        "obt_flights": lambda lh: drop_audit(lh.obt),
        # gate pieces
        "orphan_airports": orphan_airports,
        "unused_airports": unused_airports,
        "grain_violations": lambda lh: grain_violations(lh.fact, keys).agg(
            F.count(F.lit(1)).alias("violating_keys")),
        "gate_results": gate.gate_results,
        "gate_results_damaged": lambda lh: gate.gate_results(damaged_lake(lh)),
        "silver_grain_violations": silver_grain_violations,
        "airports_outside_registry": airports_outside_registry,
        "punctuality_conflicts": punctuality_conflicts,
        # reports
        "recovery_analysis": lambda lh: reports.recovery_analysis(lh.obt),
        "unjudgeable_by_status": lambda lh: reports.unjudgeable_by_status(lh.obt),
        "punctuality_by_airline": lambda lh: reports.punctuality_by_airline(lh.obt),
        "top_routes": lambda lh: reports.top_routes(lh.obt),
        "top_cancellations": lambda lh: reports.top_cancellations(lh.obt),
        "monthly_trend": lambda lh: reports.monthly_trend(lh.obt),
        "hourly_cascade": lambda lh: reports.hourly_cascade(lh.obt),
        "delays_in_city": lambda lh: reports.delays_in_city(lh.obt, CITY_PATTERN),
        "cancel_rate_by_route": lambda lh: reports.cancel_rate_by_route(lh.obt),
        "recovery_by_month": lambda lh: reports.recovery_by_month(lh.obt),
        "foreign_cancellations": lambda lh: reports.foreign_cancellations(lh.fact),
        "worst_hour": lambda lh: reports.worst_hour(lh.obt),
        "carrier_share": lambda lh: reports.carrier_share(lh.obt),
        "top_carrier_share": lambda lh: reports.top_carrier_share(lh.obt),
        "monthly_volume": lambda lh: reports.monthly_volume(lh.obt),
        "volume_span": lambda lh: reports.volume_span(lh.obt),
        "quality_summary": reports.quality_summary,
        "layer_reconcile": reports.layer_reconcile,
        "registry_coverage": lambda lh: reports.registry_coverage(lh.marked),
        "recent_routes": lambda lh: reports.recent_routes(lh.obt),
        "column_profile": lambda lh: column_profile(drop_audit(lh.obt)),
        # views by parts
        "contract_view": views.contract_by_file,
        "sketch_profile": views.sketch_profile,
        **{name: views.over_parts(name) for name in views.REPORT_VIEWS},
    }


BUILDERS = _registry()


def sites_without_large_cancellation(sites: DataFrame, orders: DataFrame, price: int = 450_000) -> DataFrame:
    """Codes of the registry for which no cancelled order over ``price`` exists (anti join)."""
    large = orders.where((c("o_orderstatus") == "P") & (c("o_totalprice") > price))
    return sites.where(non_empty(c("icao"))).select("icao").distinct().join(
        large.select(opsdata.site_code(c("o_custkey")).alias("icao")), "icao", "left_anti")


# Registry operators over a registry that grows with the tables (customer).
SITE_BUILDERS = {
    "decimal_comma_sites": lambda sites, orders: sites.select("icao", "name", "altitude_m"),
    "best_site": lambda sites, orders: gold.best_aerodrome(sites),
    "sites_without_large_cancellation": sites_without_large_cancellation,
}


def landed_rows(landed: DataFrame) -> DataFrame:
    return landed.select(*[c(f"`{raw}`").alias(name) for raw, name in spec.FLIGHT_SOURCE_COLUMNS], c("_file").alias("source_file"))


def landed_misfits(landed: DataFrame) -> DataFrame:
    """What was rescued: per file, position or column and value, the rows."""
    entry = F.explode(F.from_json(spec.COL_RESCUED, "map<string, string>")).alias("misfit", "value")
    return landed.select(c("_file").alias("source_file"), entry).where(c("misfit") != "_file").groupBy(
        "source_file", "misfit", "value").agg(_n())


def landed_summary(landed: DataFrame) -> DataFrame:
    """GT10 by file: landed rows and those with anything rescued."""
    return landed.groupBy(c("_file").alias("source_file")).agg(
        _n(), F.count_if(c(spec.COL_RESCUED).isNotNull()).alias("rescued_rows"))


# The landing over the flights rendered as lines of files with different headers.
LANDING_BUILDERS = {"landing_rows": landed_rows, "landing_rescued": landed_misfits, "landing_summary": landed_summary}


def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    build = BUILDERS[name]

    def run(spark: SparkSession, root: str) -> DataFrame:
        return build(from_driver_tables(spark, root))

    run.__name__ = name
    return run


def site_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, root: str) -> DataFrame:
        sites = silver.silver_aerodromes(opsdata.bronze_sites(spark, root))
        return SITE_BUILDERS[name](sites, read_table(spark, root, "orders", ["o_custkey", "o_orderstatus", "o_totalprice"]))

    run.__name__ = name
    return run


def landing_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, root: str) -> DataFrame:
        header = [raw for raw, _ in spec.FLIGHT_SOURCE_COLUMNS]
        lines = opsdata.landing_lines(spark, root)
        headers = csv_landing.written_headers(lines, header, csv_landing.UTF8_QUOTED)
        return LANDING_BUILDERS[name](csv_landing.parse_lines(lines, headers, header))

    run.__name__ = name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query(name) for name in BUILDERS} | {name: site_query(name) for name in SITE_BUILDERS} | {
        name: landing_query(name) for name in LANDING_BUILDERS}

"""Views refreshed by parts: contract counts by month, the reports Q3–Q7, and a
column profile from sketches.

Contract counts are row-level, so a batch's part is final. The gold views come
from the deduplicated OBT: their parts are by month, and a batch replaces the
parts of the months it touched. Reading a view merges parts only; no layer is
scanned. The incremental load keeps the parts (``opslake.streaming``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake import spec
from opslake.operators import partials
from opslake.operators.contract import Rule, metric_columns
from opslake.plans.lakehouse import Lakehouse

c = F.col
CONTRACT = "silver.contract_parts"
REPORT_VIEWS = ["punctuality_view", "routes_view", "cancellations_view", "trend_view", "cascade_view"]  # Q3 to Q7
PROFILED = ["airline_name", "route_icao", "icao_origin", "icao_destination", "flight_status"]
DELAYS, RANKS = ["departure_delay_min", "arrival_delay_min"], [0.5, 0.9]


@dataclass(frozen=True)
class View:
    keys: list[str]
    measures: list[partials.Measure]
    report: Callable[[DataFrame], DataFrame]
    where: Column | None = None

    def parts(self, obt: DataFrame, part: list[str]) -> DataFrame:
        rows = obt if self.where is None else obt.where(self.where)
        return partials.parts(rows, part, self.keys, self.measures)

    def read(self, stored: DataFrame) -> DataFrame:
        return self.report(partials.merged(stored, self.keys, self.measures))


def _pct(numerator: str) -> Column:
    return c(numerator).cast("double") * F.lit(100.0) / c("flights")


def gold_views() -> dict[str, View]:
    completed = c("flight_status") == F.lit(spec.STATUS_COMPLETED)
    flights = partials.count("flights")
    departure = partials.mean("avg_dep_delay", c("departure_delay_min"))
    arrival = partials.mean("avg_arr_delay", c("arrival_delay_min"))
    return {
        "punctuality_view": View(
            ["airline_name"], [flights, departure, arrival, partials.total("_on_time", c("departure_punctual").cast("int"))],
            lambda v: v.withColumn("dep_on_time_pct", _pct("_on_time")).drop("_on_time")
            .orderBy(c("dep_on_time_pct").desc_nulls_last(), c("airline_name").asc_nulls_first()), completed),
        "routes_view": View(
            ["route_municipalities"], [flights, partials.mean("avg_minutes_recovered", c("minutes_recovered"))],
            lambda v: v.orderBy(c("flights").desc(), c("route_municipalities").asc_nulls_first()).limit(10), completed),
        "cancellations_view": View(
            ["airline_name"], [flights, partials.total("cancelled", c("flight_cancelled").cast("int"))],
            lambda v: v.withColumn("cancel_pct", _pct("cancelled"))
            .orderBy(c("cancelled").desc_nulls_last(), c("airline_name").asc_nulls_first()).limit(10)),
        "trend_view": View(
            ["reference_month", "flight_status"], [flights, partials.mean("avg_delay", c("arrival_delay_min"))],
            lambda v: v.orderBy(c("reference_month").asc_nulls_first(), c("flight_status").asc_nulls_first())),
        "cascade_view": View(
            ["scheduled_departure_hour"], [flights, departure, arrival],
            lambda v: v.orderBy(c("scheduled_departure_hour").asc_nulls_first()), completed & c("departure_delay_min").isNotNull()),
        "profile_view": View(
            [], [flights, *[partials.distinct(n, c(n)) for n in PROFILED],
                 *[partials.quantiles(n, c(n), RANKS) for n in DELAYS]], lambda v: v),
    }


def parts_table(view: str) -> str:
    return f"gold.{view}_parts"


def contract_parts(marked: DataFrame, rules: list[Rule], part: list[str]) -> DataFrame:
    """Rows, failures of each rule and quarantined rows, by part and month of the schedule."""
    month = F.date_format("scheduled_departure_date", "yyyy-MM").alias("month")
    return marked.groupBy(*part, month).agg(*metric_columns(rules))


def contract_view(stored: DataFrame) -> DataFrame:
    """Contract counts by month over all parts, with the share quarantined."""
    names = [*spec.RULE_NAMES, "quarantined", "null_only_not_quarantined"]
    out = stored.groupBy("month").agg(F.sum("rows").alias("flights"), *[F.sum(f"`{n}`").alias(n) for n in names])
    return out.withColumn("quarantine_pct", _pct("quarantined"))


def over_parts(view: str) -> Callable[[Lakehouse], DataFrame]:
    """A gold view of a lake by way of one part a month."""
    def run(lh: Lakehouse) -> DataFrame:
        v = gold_views()[view]
        return v.read(v.parts(lh.obt.withColumn("_part", c("reference_month")), ["_part"]))

    return run


def contract_by_file(lh: Lakehouse) -> DataFrame:
    """The contract view of a lake by way of one part a file."""
    return contract_view(contract_parts(lh.marked, lh.rules, [spec.COL_SOURCE_FILE]))


def sketch_profile(lh: Lakehouse) -> DataFrame:
    """The profile view's sketches against exact figures: for each column its exact
    number (distinct values, or rows with a delay) and whether the sketch is within
    three times its stated error (of the count, or of the ranks of both quantiles)."""
    obt = lh.obt
    told = over_parts("profile_view")(lh).select(F.struct("*")).scalar()
    near = 3 * partials.KLL_ERROR
    # What the sketches told is a value of the plan, not a column: carried along, it made the aggregate a sort of all rows.
    aggs = [F.count_distinct(n).alias(n) for n in PROFILED]
    for n in DELAYS:
        at = told[n]
        aggs.append(F.count(n).alias(n))
        for i in range(len(RANKS)):
            aggs += [F.count_if(c(n) < at[i]).alias(f"{n}_under{i}"), F.count_if(c(n) <= at[i]).alias(f"{n}_upto{i}")]
    one = obt.select(*PROFILED, *DELAYS).agg(*aggs).select("*", told.alias("_told"))
    rows = [F.struct(F.lit(n).alias("column_name"), c(n).alias("exact"),
                     (F.abs(c("_told")[n] - c(n)) <= 3 * partials.HLL_ERROR * c(n)).alias("within_error")) for n in PROFILED]
    for n in DELAYS:
        good = F.lit(True)
        for i, rank in enumerate(RANKS):
            good = good & (c(f"{n}_under{i}") <= (rank + near) * c(n)) & (c(f"{n}_upto{i}") >= (rank - near) * c(n))
        rows.append(F.struct(F.lit(n).alias("column_name"), c(n).alias("exact"), good.alias("within_error")))
    return one.select(F.inline(F.array(*rows)))

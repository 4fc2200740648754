"""Analyst reports over the gold layer (Q1–Q13) and layer-level checks.

All of them are grouped aggregates with map-side partial aggregation; ratios
to a grand total use a scalar subquery (one global partial aggregate), never a
single-partition window or a cross join. Top-k reports break ties on the
group key so the k rows are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake import spec
from opslake.plans.lakehouse import Lakehouse

c = F.col


def _n() -> Column:
    return F.count(F.lit(1))


def _sum_if(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END): NULL only over an empty input."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def _pct(numerator: Column, denominator: Column) -> Column:
    """``numerator * 100.0 / denominator`` in double precision. NULL flags are
    ignored in the numerator but counted in the denominator (as specified)."""
    return numerator.cast("double") * F.lit(100.0) / denominator


def _flag_sum(flag: str) -> Column:
    return F.sum(c(flag).cast("int")).cast("long")


def _completed(df: DataFrame) -> DataFrame:
    return df.where(c("flight_status") == F.lit(spec.STATUS_COMPLETED))


# ----------------------------------------------------------------- Q1, Q2


def recovery_analysis(obt: DataFrame) -> DataFrame:
    """Flights that recovered minutes in the air, and how they arrived."""
    arr = c("arrival_delay_min")
    return obt.where(c("minutes_recovered") > 0).agg(
        _n().alias("recovered_some_minutes"),
        _sum_if(arr <= 0).alias("arrived_early_or_on_time"),
        _sum_if(arr > 0).alias("arrived_late_anyway"),
        _sum_if(arr > spec.PUNCTUAL_MAX).alias("arrived_late_over_15"),
    )


def unjudgeable_by_status(obt: DataFrame) -> DataFrame:
    return obt.groupBy("flight_status").agg(
        _n().alias("flights"),
        _sum_if(c("departure_punctual").isNull()).alias("departure_punctual_null"),
    )


# ----------------------------------------------------------------- Q3–Q7


def punctuality_by_airline(obt: DataFrame) -> DataFrame:
    return _completed(obt).groupBy("airline_name").agg(
        _n().alias("flights"),
        F.avg("departure_delay_min").alias("avg_dep_delay"),
        F.avg("arrival_delay_min").alias("avg_arr_delay"),
        _pct(_flag_sum("departure_punctual"), _n()).alias("dep_on_time_pct"),
    ).orderBy(c("dep_on_time_pct").desc_nulls_last(), c("airline_name").asc_nulls_first())


def top_routes(obt: DataFrame, k: int = 10) -> DataFrame:
    """Top-k routes by completed flights (TakeOrderedAndProject: each task keeps
    its k best, the driver merges k × tasks rows)."""
    agg = _completed(obt).groupBy("route_municipalities").agg(
        _n().alias("flights"),
        F.avg("minutes_recovered").alias("avg_minutes_recovered"),
    )
    return agg.orderBy(c("flights").desc(), c("route_municipalities").asc_nulls_first()).limit(k)


def top_cancellations(obt: DataFrame, k: int = 10) -> DataFrame:
    agg = obt.groupBy("airline_name").agg(
        _n().alias("flights"),
        _flag_sum("flight_cancelled").alias("cancelled"),
        _pct(_flag_sum("flight_cancelled"), _n()).alias("cancel_pct"),
    )
    return agg.orderBy(c("cancelled").desc_nulls_last(), c("airline_name").asc_nulls_first()).limit(k)


def monthly_trend(obt: DataFrame) -> DataFrame:
    return obt.groupBy("reference_month", "flight_status").agg(
        _n().alias("flights"),
        F.avg("arrival_delay_min").alias("avg_delay"),
    ).orderBy(c("reference_month").asc_nulls_first(), c("flight_status").asc_nulls_first())


def hourly_cascade(obt: DataFrame) -> DataFrame:
    return (
        _completed(obt).where(c("departure_delay_min").isNotNull())
        .groupBy("scheduled_departure_hour")
        .agg(
            F.avg("departure_delay_min").alias("avg_dep_delay"),
            F.avg("arrival_delay_min").alias("avg_arr_delay"),
            _n().alias("flights"),
        )
        .orderBy(c("scheduled_departure_hour").asc_nulls_first())
    )


# ----------------------------------------------------------------- Q8 (question shapes)


def delays_in_city(obt: DataFrame, pattern: str) -> DataFrame:
    """Which airline had most delays departing from a municipality (LIKE)."""
    return obt.where(c("origin_municipality").like(pattern)).groupBy("airline_name").agg(
        _n().alias("flights"),
        _sum_if(c("departure_punctual") == F.lit(False)).alias("delayed_departures"),
        F.avg("departure_delay_min").alias("avg_dep_delay"),
    )


def cancel_rate_by_route(obt: DataFrame) -> DataFrame:
    return obt.groupBy("route_icao").agg(
        _n().alias("flights"),
        _sum_if(c("flight_cancelled") == F.lit(True)).alias("cancelled"),
        _pct(_sum_if(c("flight_cancelled") == F.lit(True)), _n()).alias("cancel_pct"),
    )


def recovery_by_month(obt: DataFrame) -> DataFrame:
    return obt.groupBy("reference_month").agg(
        _n().alias("flights"),
        F.avg("minutes_recovered").alias("avg_minutes_recovered"),
    )


def foreign_cancellations(fact: DataFrame) -> DataFrame:
    """Cancellations of carriers from the foreign registry (the registry column
    lives in the fact, not in the OBT)."""
    return (
        fact.where((c("airline_registry") == F.lit(spec.REGISTRY_FOREIGN)) & (c("flight_cancelled") == F.lit(True)))
        .groupBy("airline_name")
        .agg(_n().alias("cancelled"))
    )


def worst_hour(obt: DataFrame, k: int = 1) -> DataFrame:
    agg = obt.groupBy("scheduled_departure_hour").agg(
        F.avg("departure_delay_min").alias("avg_dep_delay"), _n().alias("flights"))
    return agg.orderBy(c("avg_dep_delay").desc_nulls_last(), c("scheduled_departure_hour").asc_nulls_first()).limit(k)


# ----------------------------------------------------------------- Q9, Q10


def carrier_share(obt: DataFrame) -> DataFrame:
    """Flights and share of all flights per carrier (skew report)."""
    per = obt.groupBy("icao_airline", "airline_name").agg(_n().alias("flights"))
    # The total comes from the grouped counts: the subquery shares the main
    # plan's exchange instead of rescanning the OBT.
    total = per.select(F.sum("flights")).scalar()
    return per.withColumn("share_pct", _pct(c("flights"), total))


def top_carrier_share(obt: DataFrame, k: int = 3) -> DataFrame:
    """Share of all flights held by the k largest carriers (skew indicator)."""
    per = obt.groupBy("icao_airline").agg(_n().alias("flights"))
    top = per.orderBy(c("flights").desc(), c("icao_airline").asc_nulls_first()).limit(k)
    total = per.select(F.sum("flights")).scalar()
    return top.agg(
        _n().alias("carriers"),
        F.sum("flights").alias("flights"),
        _pct(F.sum("flights"), total).alias("share_pct"),
    )


def monthly_volume(obt: DataFrame) -> DataFrame:
    return obt.groupBy("reference_month").agg(
        _n().alias("flights"),
        F.count_distinct("scheduled_departure_date").alias("flight_dates"),
    )


def volume_span(obt: DataFrame) -> DataFrame:
    return obt.agg(
        F.min("reference_month").alias("first_month"),
        F.max("reference_month").alias("last_month"),
        F.count_distinct("reference_month").alias("months"),
        F.count_distinct("scheduled_departure_date").alias("flight_dates"),
        _n().alias("flights"),
    )


# ----------------------------------------------------------------- Q11–Q13


def quality_summary(lh: Lakehouse) -> DataFrame:
    """Quarantine rate, missing times, unknown status, implausible delays and
    duplicates in one row: one pass over the marked silver table plus one
    folded scalar aggregate over the fact."""
    m = lh.contract_metrics
    facts = lh.fact.select(F.struct(_n().alias("rows"), F.count_if(c("delay_out_of_range")).alias("oor"))).scalar()
    fact_rows, implausible = facts.getField("rows"), facts.getField("oor")
    return m.select(
        c("rows").alias("silver_rows"),
        c("quarantined"),
        _pct(c("quarantined"), c("rows")).alias("quarantine_pct"),
        c(spec.RULE_NAMES[0]).alias("missing_scheduled_times"),
        c(spec.RULE_NAMES[1]).alias("unknown_status"),
        implausible.alias("implausible_delays"),
        (c("rows") - fact_rows).alias("exact_duplicates"),
    )


def layer_reconcile(lh: Lakehouse) -> DataFrame:
    """Rows per source file in bronze and in silver (full outer join of two
    small grouped aggregates)."""
    b = lh.bronze_flights.groupBy(c(spec.COL_SOURCE_FILE).alias("source_file")).agg(_n().alias("bronze_rows"))
    s = lh.silver_flights.groupBy(c(spec.COL_SOURCE_FILE).alias("source_file")).agg(_n().alias("silver_rows"))
    j = b.join(s, "source_file", "full_outer")
    return j.select(
        "source_file",
        F.coalesce(c("bronze_rows"), F.lit(0)).alias("bronze_rows"),
        F.coalesce(c("silver_rows"), F.lit(0)).alias("silver_rows"),
        (F.coalesce(c("bronze_rows"), F.lit(0)) - F.coalesce(c("silver_rows"), F.lit(0))).alias("difference"),
    )


def registry_coverage(marked: DataFrame) -> DataFrame:
    """Share of flight rows whose airport / airline is outside the registry."""
    return marked.agg(
        _n().alias("rows"),
        _pct(F.count_if(~c(spec.FLAG_ORIGIN)), _n()).alias("origin_outside_pct"),
        _pct(F.count_if(~c(spec.FLAG_DESTINATION)), _n()).alias("destination_outside_pct"),
        _pct(F.count_if(~c(spec.FLAG_AIRLINE)), _n()).alias("airline_outside_pct"),
    )


def recent_routes(obt: DataFrame, days: int = 7) -> DataFrame:
    """Distinct (origin, destination) pairs flown in the last ``days`` days,
    anchored at the latest scheduled date (deterministic recency slice)."""
    last = obt.select(F.max("scheduled_departure_date")).scalar()
    return (
        obt.where(c("scheduled_departure_date") >= F.date_sub(last, days))
        .select("icao_origin", "icao_destination")
        .distinct()
    )

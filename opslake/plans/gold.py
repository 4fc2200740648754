"""Gold: airport dimension, flight fact, One Big Table.

Plan shape of the fact at scale: one hash shuffle on the 11 dedup keys (with
map-side partial aggregation), then only lookups that are
broadcast when their size is known to be small. The OBT adds no shuffle: its airport attributes come from the
aerodrome registry through the same formula the dimension uses, which
equals joining the dimension because every non-empty fact airport is a
dimension key by construction (both come from the same silver table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake import spec
from opslake.functions import (
    airport_country,
    between_inclusive,
    flight_scope,
    hh_mm,
    minutes_between,
    hour_of_day,
    month_anchor,
    non_empty,
    weekday_name,
    with_fallback,
)
from opslake.operators.best_record import best_per_key
from opslake.operators.dedup import distinct_keys
from opslake.operators.joins import left_lookup
from opslake.operators.once import once

AERODROME_PAYLOAD = ["name", "municipality", "state_name", "served_municipality", "served_state_name"]


def best_airline(airlines: DataFrame) -> DataFrame:
    """One record per airline code: active first, then by legal name
    (registry origin breaks the remaining ties)."""
    rank = F.when(F.col("status") == F.lit(spec.AIRLINE_ACTIVE), F.lit(0)).otherwise(F.lit(1))
    return best_per_key(
        airlines.where(non_empty(F.col("icao"))), "icao",
        order_by=[rank, F.col("legal_name")], payload=["legal_name", "registry_origin"],
    )


def best_aerodrome(aerodromes: DataFrame) -> DataFrame:
    """One record per ICAO code: first by name (then the other attributes)."""
    return best_per_key(
        aerodromes.where(non_empty(F.col("icao"))), "icao",
        order_by=[F.col("name")], payload=AERODROME_PAYLOAD,
    )


def airport_name(code: Column, registry_name: Column) -> Column:
    return with_fallback(registry_name, code, spec.AIRPORT_FALLBACK)


def airport_codes(silver: DataFrame) -> DataFrame:
    """Every non-empty airport code used as origin or destination: one scan,
    both roles exploded, then DISTINCT (partial aggregation per task)."""
    return (
        silver.select(F.explode(F.array("icao_origin", "icao_destination")).alias("icao_airport"))
        .where(non_empty(F.col("icao_airport")))
        .distinct()
    )


def dim_airport(silver: DataFrame, aerodromes_best: DataFrame) -> DataFrame:
    """The airport codes of the flights, left-joined to the registry."""
    return dim_from_codes(airport_codes(silver), aerodromes_best)


def dim_from_codes(codes: DataFrame, aerodromes_best: DataFrame) -> DataFrame:
    codes = codes.select("icao_airport").distinct()
    reg = aerodromes_best.select(
        F.col("icao").alias("_icao"), F.col("name").alias("_name"),
        F.col("municipality").alias("_municipality"), F.col("state_name").alias("_state"),
    )
    out = left_lookup(codes, reg, F.col("icao_airport") == F.col("_icao"))
    code = F.col("icao_airport")
    return out.select(
        code,
        airport_name(code, F.col("_name")).alias("airport_name"),
        F.col("_municipality").alias("airport_municipality"),
        F.col("_state").alias("airport_state"),
        airport_country(code).alias("airport_country"),
        F.col("_icao").isNotNull().alias("in_anac_registry"),
        F.current_timestamp().alias(spec.COL_PROCESSED),
    )


def _code_table(codes: DataFrame, domain: str, prefix: str) -> DataFrame:
    return codes.where(F.col("domain") == F.lit(domain)).select(
        F.col("code").alias(f"{prefix}_code"), F.col("description").alias(f"{prefix}_description")
    )


def fact_flights(silver: DataFrame, airlines_best: DataFrame, codes: DataFrame,
                 s: spec.FlightSpec = spec.FLIGHTS) -> DataFrame:
    """Deduplicated flight steps with labels, scope, plausibility and punctuality.

    Over a silver that is not stored, the four times are parsed once a row: a filter on
    a delay or a flag is applied to them before the dedup, but not written out below."""
    silver = once(silver, **{name: F.col(name) for name in spec.TIMESTAMP_COLUMNS})
    base = distinct_keys(silver, s.dedup_keys)
    c = F.col
    sd, ad, sa, aa = (c(x) for x in spec.TIMESTAMP_COLUMNS)
    # Each minute difference once (long); delays and recovery derive from it.
    base = base.withColumns({"_dep_l": minutes_between(sd, ad), "_arr_l": minutes_between(sa, aa)})
    base = base.withColumns({
        "_dep": c("_dep_l").try_cast("int"),
        "_arr": c("_arr_l").try_cast("int"),
        "_rec": (c("_dep_l") - c("_arr_l")).try_cast("int"),
    })
    out_of_range = (
        (c("_dep").isNotNull() & ~between_inclusive(c("_dep"), s.delay_min, s.delay_max))
        | (c("_arr").isNotNull() & ~between_inclusive(c("_arr"), s.delay_min, s.delay_max))
    )
    base = base.withColumn("delay_out_of_range", out_of_range)

    airline = airlines_best.select(
        c("icao").alias("_al_icao"), c("legal_name").alias("_al_name"), c("registry_origin").alias("_al_registry")
    )
    df = left_lookup(base, airline, c("icao_airline") == c("_al_icao"))
    for lk, prefix in zip(s.lookups, ("_di", "_lt")):
        table = _code_table(codes, lk.domain, prefix)
        df = left_lookup(df, table, c(lk.code_column) == c(f"{prefix}_code"))

    oor = c("delay_out_of_range")
    sd_date = sd.cast("date")

    def judged(delay: str) -> Column:
        return F.when(oor | c(delay).isNull(), F.lit(None).cast("boolean")).otherwise(c(delay) <= F.lit(s.punctual_max))

    status = c("flight_status")
    cols = {
        "icao_airline": c("icao_airline"),
        "airline_name": with_fallback(c("_al_name"), c("icao_airline"), spec.AIRLINE_FALLBACK),
        "airline_registry": c("_al_registry"),
        "flight_number": c("flight_number"),
        "di_code": c("di_code"),
        "di_description": with_fallback(c("_di_description"), c("di_code"), s.lookups[0].fallback),
        "line_type_code": c("line_type_code"),
        "line_type_description": with_fallback(c("_lt_description"), c("line_type_code"), s.lookups[1].fallback),
        "flight_scope": flight_scope(c("line_type_code")),
        "icao_origin": c("icao_origin"),
        "icao_destination": c("icao_destination"),
        "route": F.concat(c("icao_origin"), F.lit(" - "), c("icao_destination")),
        "scheduled_departure": sd,
        "scheduled_departure_date": sd_date,
        "scheduled_departure_time": hh_mm(sd),
        "scheduled_departure_hour": hour_of_day(sd),
        "day_of_week": weekday_name(sd_date),
        "reference_month": month_anchor(sd_date),
        "actual_departure": ad,
        "scheduled_arrival": sa,
        "actual_arrival": aa,
        "departure_delay_min": F.when(~oor, c("_dep")),
        "arrival_delay_min": F.when(~oor, c("_arr")),
        "minutes_recovered": F.when(~oor, c("_rec")),
        "delay_out_of_range": oor,
        "departure_punctual": judged("_dep"),
        "arrival_punctual": judged("_arr"),
        "flight_status": status,
        "flight_cancelled": status == F.lit(spec.STATUS_CANCELLED),
        "flight_completed": status == F.lit(spec.STATUS_COMPLETED),
        spec.COL_PROCESSED: F.current_timestamp(),
    }
    return df.select(*[v.alias(k) for k, v in cols.items()])


def obt_flights(fact: DataFrame, aerodromes_best: DataFrame) -> DataFrame:
    """Fact with the airport attributes in two roles (origin, destination)."""
    c = F.col
    df = fact
    for role, code_col in (("o", "icao_origin"), ("d", "icao_destination")):
        reg = aerodromes_best.select(
            c("icao").alias(f"_{role}_icao"), c("name").alias(f"_{role}_name"),
            c("municipality").alias(f"_{role}_municipality"), c("state_name").alias(f"_{role}_state"),
        )
        df = left_lookup(df, reg, c(code_col) == c(f"_{role}_icao"))

    def role_cols(role: str, code_col: str, label: str) -> dict[str, Column]:
        code = c(code_col)
        in_dim = non_empty(code)
        return {
            f"{label}_airport_name": F.when(in_dim, airport_name(code, c(f"_{role}_name"))),
            f"{label}_municipality": c(f"_{role}_municipality"),
            f"{label}_state": c(f"_{role}_state"),
            f"{label}_country": F.when(in_dim, airport_country(code)),
        }

    extra = {
        **role_cols("o", "icao_origin", "origin"),
        **role_cols("d", "icao_destination", "destination"),
        "route_icao": c("route"),
        "route_municipalities": F.concat(
            F.coalesce(c("_o_municipality"), c("icao_origin")), F.lit(" - "),
            F.coalesce(c("_d_municipality"), c("icao_destination")),
        ),
    }
    df = df.withColumns(extra)
    return df.select(*spec.OBT_COLUMNS)

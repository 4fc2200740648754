"""Silver: typed lossless mirror of bronze (PRJ1–PRJ10, SE1) and the
flight data contract bound to the generic contract operator (DC1–DC5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake import spec
from opslake.functions import (
    between_inclusive,
    decimal_comma_to_double,
    hh_mm,
    minutes_between,
    null_if_literal,
    safe_timestamp,
)
from opslake.operators.contract import Rule
from opslake.operators.membership import key_set, mark
from opslake.operators.mirror import rename, union_with_discriminator


def parse_loss_metrics() -> list:
    """Per time column, rows whose text was present (not the 'null' marker)
    but did not parse: a silent loss that otherwise only shows up as rule 1
    or not at all. Evaluated on the landed text by the job that writes bronze
    (no exchange there whose sampling would count rows twice)."""
    out = []
    for text, name in spec.FLIGHT_SOURCE_COLUMNS:
        if name in spec.TIMESTAMP_COLUMNS:
            raw = F.col(f"`{text}`")
            typed = safe_timestamp(null_if_literal(raw, spec.NULL_LITERAL))
            present = raw.isNotNull() & (raw != F.lit(spec.NULL_LITERAL))
            out.append(F.count_if(present & typed.isNull()).alias(f"{name}_unparsable"))
    return out


def silver_flights(bronze: DataFrame) -> DataFrame:
    """Same row count as bronze; 'null' → NULL on the four times only, safe
    casts, date/HH:mm split, delay arithmetic in whole minutes."""
    df = rename(bronze, spec.FLIGHT_SOURCE_COLUMNS, keep=[spec.COL_SOURCE_FILE, spec.COL_INGESTED])
    typed = {c: safe_timestamp(null_if_literal(c, spec.NULL_LITERAL)) for c in spec.TIMESTAMP_COLUMNS}
    df = df.withColumns(typed)
    sd, ad, sa, aa = (F.col(c) for c in spec.TIMESTAMP_COLUMNS)
    # Each minute difference once (long); delays and recovery derive from it.
    df = df.withColumns({"_dep_l": minutes_between(sd, ad), "_arr_l": minutes_between(sa, aa)})
    derived = {}
    for c in spec.TIMESTAMP_COLUMNS:
        derived[f"{c}_date"] = F.col(c).cast("date")
        derived[f"{c}_time"] = hh_mm(F.col(c))
    derived["justification_code"] = null_if_literal("justification_code", spec.NOT_APPLICABLE)
    derived["departure_delay_min"] = F.col("_dep_l").try_cast("int")
    derived["arrival_delay_min"] = F.col("_arr_l").try_cast("int")
    derived["minutes_recovered"] = (F.col("_dep_l") - F.col("_arr_l")).try_cast("int")
    derived[spec.COL_TRANSFORMED] = F.current_timestamp()
    return df.withColumns(derived).select(*spec.SILVER_VRA_COLUMNS)


def silver_airlines(registries: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of the national and foreign registries with ``registry_origin``."""
    labels = {spec.NATIONAL_AIRLINES_FILE: spec.REGISTRY_NATIONAL, spec.FOREIGN_AIRLINES_FILE: spec.REGISTRY_FOREIGN}
    parts = {}
    for file, df in registries.items():
        cols = ["icao", "iata_code", "legal_name", "service", "city", "state", "status",
                spec.COL_SOURCE_FILE, spec.COL_INGESTED]
        parts[labels.get(file, file)] = df.select(*cols)
    out = union_with_discriminator(parts, "registry_origin", position=7)
    return out.withColumn(spec.COL_TRANSFORMED, F.current_timestamp()).select(*spec.SILVER_AIRLINE_COLUMNS)


def silver_aerodromes(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "icao", "ciad", "name", "municipality",
        F.col("state").alias("state_name"),
        "served_municipality",
        F.col("served_state").alias("served_state_name"),
        F.col("latitude").alias("latitude_dms"),
        F.col("longitude").alias("longitude_dms"),
        decimal_comma_to_double("altitude").alias("altitude_m"),
        "status",
        spec.COL_INGESTED,
        F.current_timestamp().alias(spec.COL_TRANSFORMED),
    )


def silver_codes(bronze: DataFrame) -> DataFrame:
    return bronze.select("domain", "code", "description", F.current_timestamp().alias(spec.COL_TRANSFORMED))


# --------------------------------------------------------------------------- contract


def flight_rules(s: spec.FlightSpec = spec.FLIGHTS) -> list[Rule]:
    """The nine expectations, in order, as passing predicates (NULL-passing
    branches exactly as specified; only rule 2 can evaluate to NULL)."""
    c = F.col
    sd, sa, ad, aa = c("scheduled_departure"), c("scheduled_arrival"), c("actual_departure"), c("actual_arrival")
    dep, arr = c("departure_delay_min"), c("arrival_delay_min")
    preds = [
        sd.isNotNull() & sa.isNotNull(),
        c("flight_status").isin(*spec.KNOWN_STATUSES),
        sd.isNull() | sa.isNull() | (sa > sd),
        ad.isNull() | aa.isNull() | (aa > ad),
        dep.isNull() | between_inclusive(dep, s.delay_min, s.delay_max),
        arr.isNull() | between_inclusive(arr, s.delay_min, s.delay_max),
        c(spec.FLAG_AIRLINE),
        c(spec.FLAG_ORIGIN),
        c(spec.FLAG_DESTINATION),
    ]
    return [Rule(name, p) for name, p in zip(spec.RULE_NAMES, preds)]


def mark_flights(silver: DataFrame, aerodromes: DataFrame, airlines: DataFrame) -> DataFrame:
    """silver + three registry-membership flags (origin, destination, airline)."""
    airports = key_set(aerodromes, "icao")
    carriers = key_set(airlines, "icao")
    out = mark(silver, "icao_origin", airports, spec.FLAG_ORIGIN)
    out = mark(out, "icao_destination", airports, spec.FLAG_DESTINATION)
    return mark(out, "icao_airline", carriers, spec.FLAG_AIRLINE)

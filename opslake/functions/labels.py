"""Business labels: fallbacks, scope, country, plausibility."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opslake import spec


def with_fallback(value: Column, code: Column, fallback: tuple[str, str]) -> Column:
    """``value`` when known, else 'PREFIX<code>SUFFIX'; a NULL code gives NULL."""
    prefix, suffix = fallback
    return F.coalesce(value, F.concat(F.lit(prefix), code, F.lit(suffix)))


def flight_scope(line_type: Column) -> Column:
    """Domestic / international / unclassified (NULL code included)."""
    return (
        F.when(line_type.isin(*spec.DOMESTIC_LINE_TYPES), F.lit(spec.SCOPE_DOMESTIC))
        .when(line_type.isin(*spec.INTERNATIONAL_LINE_TYPES), F.lit(spec.SCOPE_INTERNATIONAL))
        .otherwise(F.lit(spec.SCOPE_UNCLASSIFIED))
    )


def airport_country(icao: Column) -> Column:
    """Brazil when the ICAO prefix is a Brazilian one, else abroad."""
    return (
        F.when(icao.rlike(spec.BRAZIL_ICAO_PATTERN), F.lit(spec.COUNTRY_BRAZIL))
        .otherwise(F.lit(spec.COUNTRY_ABROAD))
    )


def between_inclusive(c: Column, low: int, high: int) -> Column:
    return (c >= F.lit(low)) & (c <= F.lit(high))

"""Column expressions. Every function returns a ``pyspark.sql.Column`` built from
built-in Spark functions, so it stays inside whole-stage codegen."""

from opslake.functions.cleaning import (  # noqa: F401
    decimal_comma_to_double,
    hh_mm,
    minutes_between,
    non_empty,
    null_if_literal,
    safe_timestamp,
)
from opslake.functions.calendar import hour_of_day, month_anchor, weekday_name  # noqa: F401
from opslake.functions.labels import (  # noqa: F401
    airport_country,
    between_inclusive,
    flight_scope,
    with_fallback,
)

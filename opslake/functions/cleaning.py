"""Cleaning and typing of raw text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_literal(c: Column | str, literal: str) -> Column:
    """The text marker ``literal`` (e.g. 'null', 'N/A') becomes a real NULL."""
    return F.nullif(_col(c), F.lit(literal))


def safe_timestamp(c: Column | str) -> Column:
    """Zone-less timestamp; unparsable text gives NULL and the row is kept."""
    return _col(c).try_cast("timestamp_ntz")


def decimal_comma_to_double(c: Column | str) -> Column:
    """'760,5' → 760.5; a thousands separator ('1.234,5') gives NULL."""
    return F.replace(_col(c), F.lit(","), F.lit(".")).try_cast("double")


def hh_mm(ts: Column | str) -> Column:
    """Time of day as 'HH:mm', built from the fields so no session time zone
    can shift it (``date_format`` would, inside a DST gap)."""
    ts = _col(ts)
    return F.concat(
        F.lpad(F.hour(ts).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad(F.minute(ts).cast("string"), 2, "0"),
    )


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole minutes from ``start`` to ``end`` (long), truncated toward zero:
    −90 s is −1. The difference of two zone-less timestamps is a day-time
    interval on the wall clock, so no session time zone shifts it
    (``timestamp_diff`` would, inside a DST gap)."""
    return (_col(end) - _col(start)).cast("interval minute").cast("bigint")


def non_empty(c: Column | str) -> Column:
    """Key present: not NULL and not the empty string."""
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))

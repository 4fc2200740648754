"""Calendar derivations of a scheduled time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opslake.spec import WEEKDAYS


def hour_of_day(ts: Column) -> Column:
    """Hour 0–23 as int; NULL when the time is NULL."""
    return F.hour(ts).cast("int")


def weekday_name(d: Column, names: list[str] = WEEKDAYS) -> Column:
    """Weekday name by Spark's ``dayofweek`` (1 = Sunday); NULL date → NULL.

    A CASE chain: ``element_at`` on a literal array does not return NULL for
    a NULL index here."""
    dow = F.dayofweek(d)
    out = F.lit(None).cast("string")
    for i in range(len(names), 0, -1):
        out = F.when(dow == F.lit(i), F.lit(names[i - 1])).otherwise(out)
    return out


def month_anchor(d: Column) -> Column:
    """First day of the month at midnight, zone-less."""
    return F.trunc(d, "MM").cast("timestamp_ntz")

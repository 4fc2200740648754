"""Columns that are computed once a row.

Catalyst writes a column's expression out wherever a filter that it moves down
looks at the column: a filter on a delay then parses the same times a dozen times
a row, in generated code that may be too long for the JVM to compile. What comes
out of a generator is never written out again, and no filter on it moves below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` (replaced in place, or added at the end)."""
    made = F.inline(F.array(F.struct(*[v.alias(f"_once_{k}") for k, v in columns.items()])))
    out = df.select("*", made)
    kept = [F.col(f"_once_{k}" if k in columns else f"`{k}`").alias(k) for k in df.columns]
    return out.select(*kept, *[F.col(f"_once_{k}").alias(k) for k in columns if k not in df.columns])

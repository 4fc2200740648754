"""Lookup joins without broadcast hints.

Catalyst broadcasts a side only when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold``, AQE re-checks the *measured* size at
runtime (``spark.sql.adaptive.autoBroadcastJoinThreshold``), and beyond that a
sort-merge join is used, where AQE's skew join splits a hot key's partition.
The seed is an inline relation and registries are files, so their sizes are known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def left_lookup(df: DataFrame, side: DataFrame, condition: Column) -> DataFrame:
    """LEFT join that never changes the row count as long as ``side`` is unique
    on its join key (callers build it with DISTINCT or a best-record choice)."""
    return df.join(side, condition, "left")

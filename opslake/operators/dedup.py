"""Exact deduplication on a key grain (WN1, AG2, AG3).

``keep_first`` is the form that also tells which row survives: an argument
minimum of (order, payload), partially aggregated like the distinct form.

``distinct`` over the key columns is a HashAggregate with a map-side partial
aggregate: a hot group (even one holding a third of all rows) collapses
before the shuffle. It equals ROW_NUMBER()=1 keep-first whenever the output
holds only the keys and functions of them (NULL keys group as equal in both).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct()


def group_sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def duplicate_surplus(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows that exact dedup removes, ``COALESCE(SUM(n - 1), 0)``."""
    return group_sizes(df, keys).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_surplus")
    )


def grain_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups that occur more than once (HAVING COUNT(*) > 1)."""
    return group_sizes(df, keys).where(F.col("_n") > 1).withColumnRenamed("_n", "rows")


def keep_first(df: DataFrame, keys: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """One row per key group: the keys, the ``order`` and ``payload`` columns of
    its first row by ``order`` (nulls first; ties by payload) and its ``copies``."""
    first = F.min(F.struct(*order, *payload)).alias("_first")
    rows = df.groupBy(*keys).agg(first, F.count(F.lit(1)).alias("copies"))
    return rows.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in [*order, *payload]], "copies")

"""Registry membership flags (JN1, DC1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.functions import non_empty
from opslake.operators.joins import left_lookup


def key_set(registry: DataFrame, key: str) -> DataFrame:
    """DISTINCT non-empty keys of a registry (partial aggregation before the shuffle)."""
    return registry.where(non_empty(F.col(key))).select(F.col(key).alias("_key")).distinct()


def mark(df: DataFrame, column: str, keys: DataFrame, flag: str) -> DataFrame:
    """Add boolean ``flag`` = ``column`` is in ``keys`` (never NULL).

    A left join to a DISTINCT key set cannot change the row count. ``keys``
    must hold a single column ``_key`` (see :func:`key_set`).
    """
    side = keys.select(F.col("_key").alias(f"_k_{flag}"), F.lit(True).alias(f"_m_{flag}"))
    out = left_lookup(df, side, df[column] == side[f"_k_{flag}"])
    return out.withColumn(flag, F.coalesce(F.col(f"_m_{flag}"), F.lit(False))).drop(f"_k_{flag}", f"_m_{flag}")

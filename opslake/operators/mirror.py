"""Generic mirror operators: rename from a map, union with a discriminator."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename(df: DataFrame, pairs: Iterable[tuple[str, str]], keep: Iterable[str] = ()) -> DataFrame:
    """Select ``source AS target`` for every pair (names may hold spaces and
    accents), then the ``keep`` columns unchanged (PRJ1)."""
    cols = [F.col(f"`{src}`").alias(dst) for src, dst in pairs]
    return df.select(*cols, *[F.col(c) for c in keep])


def union_with_discriminator(parts: dict[str, DataFrame], column: str, position: int | None = None) -> DataFrame:
    """UNION ALL of same-shaped tables, each tagged with its label in ``column``
    (SE1). The row count is exactly the sum of the parts."""
    out = None
    for label, df in parts.items():
        cols = list(df.columns)
        tagged = F.lit(label).alias(column)
        at = len(cols) if position is None else position
        df = df.select(*cols[:at], tagged, *cols[at:])
        out = df if out is None else out.unionByName(df)
    return out

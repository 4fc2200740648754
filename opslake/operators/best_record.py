"""Best record per key (WN2, WN3).

ROW_NUMBER() OVER (PARTITION BY key ORDER BY o1, o2, …) = 1 expressed as an
arg-min aggregate: ``min(struct(o1, o2, …, payload…))`` per key. It is a
HashAggregate/ObjectHashAggregate with a partial step, so a key with millions of
records is reduced map-side instead of being sorted in one task. Fields
compare NULLS FIRST, like Spark's ascending ORDER BY; the payload columns act
as the final tie-breakers, which makes the choice deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def best_per_key(df: DataFrame, key: str, order_by: list[Column], payload: list[str]) -> DataFrame:
    fields = [c.alias(f"_o{i}") for i, c in enumerate(order_by)] + [F.col(p) for p in payload]
    best = df.groupBy(key).agg(F.min(F.struct(*fields)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{p}").alias(p) for p in payload])

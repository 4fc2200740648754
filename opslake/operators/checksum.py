"""Reconciliation by content (GT2, Q12): order-free checksums of two layers.

The checksum of a group is the exact sum of a row hash over its rows, so it
depends on neither order nor partitioning and counts every copy. Sums are
partially aggregated: a row a group and task is shuffled, whatever its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_sum(columns: list[str]) -> Column:
    """Two sums of independent 64-bit hashes of the columns, nulls included."""
    present = F.array(*[F.col(c).isNull() for c in columns])
    hashes = [F.xxhash64(F.lit(seed), present, *columns).cast("decimal(38,0)") for seed in (1, 2)]
    return F.struct(*[F.sum(h).alias(f"s{i}") for i, h in enumerate(hashes)])


def reconcile(left: DataFrame, right: DataFrame, group: str, columns: list[str], names: tuple[str, str]) -> DataFrame:
    """Per value of ``group`` (null is one): rows on either side and whether both
    hold the same rows, as multisets of ``columns``."""
    def side(df: DataFrame, at: int) -> DataFrame:
        sums = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), row_sum(columns).alias("sums"))
        return sums.select(group, *[(F.col("n") if at == i else F.lit(None).cast("long")).alias(f"n{i}") for i in (0, 1)],
                           *[(F.col("sums") if at == i else F.lit(None).cast("struct<s0: decimal(38,0), s1: decimal(38,0)>")).alias(f"sums{i}")
                             for i in (0, 1)])

    both = side(left, 0).unionByName(side(right, 1)).groupBy(group).agg(
        *[F.max(c).alias(c) for c in ("n0", "n1")], *[F.first(c, ignorenulls=True).alias(c) for c in ("sums0", "sums1")])
    return both.select(group, *[F.coalesce(f"n{i}", F.lit(0)).alias(f"{n}_rows") for i, n in enumerate(names)],
                       (F.col("n0").eqNullSafe(F.col("n1")) & F.col("sums0").eqNullSafe(F.col("sums1"))).alias("content_equal"))

"""Aggregates kept as parts that merge: views refreshed without a rescan.

A :class:`Measure` is an aggregate in three steps: what a part (a batch, a
month) keeps of its rows, how the kept columns of several parts merge, and the
value read from the merged columns. Counts, sums and averages are exact; a
distinct count is a HyperLogLog sketch and a quantile a KLL sketch, both merged
in the JVM. A part is as small as its groups; a new batch writes its own part
and no other is read again until the view is.

Groups that are null are groups of their own. Averages, and quantiles of nothing,
are null; a distinct count of nothing is 0.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12      # 4,096 registers
HLL_ERROR = 1.04 / (1 << (LG_K // 2))  # standard error of a merged distinct count, as a share of it
KLL_K = 800
KLL_ERROR = 0.0045  # error of a rank, two-sided, at 99 % confidence


@dataclass(frozen=True)
class Measure:
    name: str
    kept: dict[str, tuple[Column, Callable[[Column], Column]]]  # column: (over rows, over parts)
    value: Column


def count(name: str, where: Column | None = None) -> Measure:
    """Rows, or those for which ``where`` is true."""
    rows = F.count(F.lit(1)) if where is None else F.count_if(F.coalesce(where, F.lit(False)))
    return Measure(name, {name: (rows, F.sum)}, F.col(name))


def total(name: str, col: Column) -> Measure:
    """Sum of an integer column; null where all of it is."""
    return Measure(name, {name: (F.sum(col.cast("long")), F.sum)}, F.col(name))


def mean(name: str, col: Column) -> Measure:
    """Average of an integer column, from its exact sum and count."""
    s, n = f"{name}__sum", f"{name}__n"
    return Measure(name, {s: (F.sum(col.cast("long")), F.sum), n: (F.count(col), F.sum)},
                   F.when(F.col(n) > 0, F.col(s).cast("double") / F.col(n)))


def distinct(name: str, col: Column, lg_k: int = LG_K) -> Measure:
    """Distinct values (as text), within some ``HLL_ERROR`` of their number. The
    sketch leaves out empty texts, so every text is told with a mark before it."""
    return Measure(name, {name: (F.hll_sketch_agg(F.concat(F.lit("="), col.cast("string")), lg_k), F.hll_union_agg)},
                   F.hll_sketch_estimate(name))


def quantiles(name: str, col: Column, ranks: list[float], k: int = KLL_K) -> Measure:
    """Array of the values at ``ranks`` of an integer column, within ``KLL_ERROR`` of the rank."""
    at = F.array(*[F.kll_sketch_get_quantile_bigint(name, F.lit(r)) for r in ranks])
    return Measure(name, {name: (F.kll_sketch_agg_bigint(col.cast("long"), k), F.kll_merge_agg_bigint)},
                   F.when(F.kll_sketch_get_n_bigint(name) > 0, at))


def parts(df: DataFrame, part: list[str], keys: list[str], measures: list[Measure]) -> DataFrame:
    """What every part keeps of each group: the ``part`` columns, the keys and the kept columns."""
    return df.groupBy(*part, *keys).agg(*[rows.alias(n) for m in measures for n, (rows, _) in m.kept.items()])


def merged(stored: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    """The value of each measure by group, over all parts in ``stored``."""
    one = stored.groupBy(*keys).agg(*[merge(F.col(n)).alias(n) for m in measures for n, (_, merge) in m.kept.items()])
    return one.select(*keys, *[m.value.alias(m.name) for m in measures])

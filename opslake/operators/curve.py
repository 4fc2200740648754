"""Clustering in several dimensions: a space-filling (Z-order) curve over ranks.

A value's rank is the share of the rows below it, in ``2 ** BITS`` steps, whatever
the type and the skew of a column. The bits of the ranks are interleaved, the
highest first. Files that hold ranges of the curve have narrow minima and maxima in
*each* column: a filter on any one of them skips files.

The cut points come from a uniform sample of at most about ``SAMPLE`` rows, as
those of a range partitioner do. They decide where a row lies, never whether.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000   # rows that come to the driver, of the clustering columns only
BITS = 5          # at most 31 cut points a column


def cut_points(df: DataFrame, columns: list[str], rows: int | None = None, bits: int = BITS,
               seed: int = 7) -> dict[str, list[tuple]]:
    """(value, by how much the rank of greater values rises) of each column, ascending,
    nulls left out. ``rows`` is an upper bound of the rows, counted if it isn't given."""
    d = df.select(*[F.col(f"`{c}`") for c in columns])
    share = min(1.0, SAMPLE / max(1, d.count() if rows is None else rows))
    drawn = (d.sample(share, seed) if share < 1 else d).collect()
    out = {}
    for k, c in enumerate(columns):
        values = sorted(r[k] for r in drawn if r[k] is not None)
        parts, rank, out[c] = 1 << bits, 0, []
        for v in sorted({values[len(values) * i // parts] for i in range(parts)} if values else ()):
            above = bisect_right(values, v) * parts // len(values)
            if rank < above < parts:
                out[c].append((v, above - rank))
                rank = above
    return out


def curve_key(df: DataFrame, cuts: dict[str, list[tuple]], bits: int = BITS) -> Column:
    """The place of a row on the curve (a long); null values have rank 0."""
    types = dict(df.dtypes)
    ranks = []
    for c, points in cuts.items():
        rank = F.lit(0)
        for value, step in points:
            rank = rank + F.when(F.col(f"`{c}`") > F.lit(str(value)).cast(types[c]), step).otherwise(0)
        ranks.append(rank)
    key = F.lit(0).cast("long")
    for level in reversed(range(bits)):
        for rank in ranks:
            key = key * 2 + F.shiftright(rank, level).bitwiseAND(F.lit(1)).cast("long")
    return key

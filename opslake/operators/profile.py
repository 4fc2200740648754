"""Column profile in one aggregate pass (PF1).

For every column: row count, NULL count, min and max (computed on the typed
value, then rendered as text) and optionally ``approx_count_distinct``. All
columns are profiled by a single ``agg`` (partial aggregation per task, one
tiny shuffle), then unpivoted with ``stack`` into one row per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

PROFILABLE = (StringType, NumericType, DateType, TimestampType, TimestampNTZType, BooleanType)


def column_profile(df: DataFrame, columns: list[str] | None = None, distinct: bool = False) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = [c for c in (columns or df.columns) if isinstance(types[c], PROFILABLE)]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        aggs += [
            F.count_if(col.isNull()).alias(f"_n{i}"),
            F.min(col).cast("string").alias(f"_lo{i}"),
            F.max(col).cast("string").alias(f"_hi{i}"),
        ]
        if distinct:
            aggs.append(F.approx_count_distinct(col).alias(f"_d{i}"))
    wide = df.agg(*aggs)
    parts = []
    for i, c in enumerate(columns):
        parts += [f"'{c}'", f"_n{i}", f"_lo{i}", f"_hi{i}"] + ([f"_d{i}"] if distinct else [])
    names = "column_name, null_count, min_value, max_value" + (", approx_distinct" if distinct else "")
    long = wide.selectExpr("_rows", f"stack({len(columns)}, {', '.join(parts)}) AS ({names})")
    return long.select(
        "column_name", F.col("_rows").alias("row_count"), "null_count", "min_value", "max_value",
        *(["approx_distinct"] if distinct else []),
    )

"""Inline seed relations (SRC8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opslake.spec import OPERATION_CODES


def operation_codes(spark: SparkSession) -> DataFrame:
    """The 13 operation-code seed rows as an inline VALUES relation, whose size Catalyst knows."""
    rows = ", ".join("(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in row) + ")" for row in OPERATION_CODES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS codes(domain, code, description)")

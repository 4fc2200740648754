"""Parquet table scans (SRC9)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan ``<root>/<name>.parquet`` (a file or a directory of parts).

    Selecting ``columns`` right at the scan keeps the Parquet ReadSchema narrow;
    later filters are pushed into the scan by Catalyst.
    """
    path = os.path.join(root, f"{name}.parquet")
    if not os.path.exists(path) and os.path.isdir(os.path.join(root, name)):
        path = os.path.join(root, name)
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df

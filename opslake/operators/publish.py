"""Publishing tables: write, audit, then commit, with layout and a row count
observed on the write itself (SNK1–SNK5, SNK7).

* ``stage`` writes a new version folder of a table. Nobody reads it until
  ``commit`` names it: a commit is one small file that maps tables to versions,
  so all tables of a run become current in one step, after whatever was to be
  verified. A job or check that fails leaves every table as it was; ``discard``
  removes what it staged. The schema may change between versions.
* A commit deletes the versions and commits older than the previous one, and
  staged versions that an ended run left behind. Readers keep what they opened.
  One run at a time writes to a root.
* Layout (the reference's clustering), three modes:
  ``range`` (default) — range-partition on the cluster columns first (an extra
  shuffle plus a sampling job; files get disjoint ranges, so a filter on the
  leading column skips files);
  ``curve`` — range-partition on a space-filling curve over the leading cluster columns
  (``operators/curve.py``; one more sampling job): a filter on any of them skips files;
  ``local`` — sort within the partitions the plan already has: no shuffle,
  row groups get tight min/max statistics (Parquet row-group skipping). The
  trailing cluster columns split hot values of the leading ones, so one
  airline or one day cannot become one giant file.
* The row count comes from ``DataFrame.observe`` on the same job: no second
  scan of the written table.
"""

from __future__ import annotations

import os
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opslake.operators.curve import curve_key, cut_points

VERSION = "version-"
COMMITS = "commits"
MONTH, BATCH = PARTITIONS = ("_month", "_batch")   # partition columns of the incremental load


@dataclass
class Published:
    name: str
    path: str
    rows: int
    seconds: float


def table_path(root: str, name: str) -> str:
    layer, _, table = name.partition(".")
    return os.path.join(root, layer, table)


def _folders(spark: SparkSession, path: str) -> tuple:
    """Hadoop file system of ``path`` and the names of the folders in it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.listStatus(hadoop) if fs.exists(hadoop) else []
    return fs, sorted(f.getPath().getName() for f in found if f.isDirectory())


def versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """Paths of the complete versions of a table, oldest first, committed or not."""
    path = table_path(root, name)
    fs, names = _folders(spark, path)
    marked = spark._jvm.org.apache.hadoop.fs.Path
    return [os.path.join(path, n) for n in names
            if n.startswith(VERSION) and fs.exists(marked(os.path.join(path, n, "_SUCCESS")))]


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def commits(spark: SparkSession, root: str, last: int = 1) -> list[dict[str, str]]:
    """The last commits (table → version folder), newest first."""
    _, names = _folders(spark, os.path.join(root, COMMITS))
    fs, found = _folders(spark, root)[0], []
    for n in reversed(names):
        path = os.path.join(root, COMMITS, n)
        if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS"))):
            found.append({r.name: r.version for r in spark.read.schema("name string, version string").json(path).collect()})
            if len(found) == last:
                break
    return found


def current(spark: SparkSession, root: str) -> dict[str, str]:
    """Table → path of its committed version."""
    done = commits(spark, root)
    return {name: os.path.join(table_path(root, name), v) for name, v in done[0].items()} if done else {}


def commit(spark: SparkSession, root: str, tables: list[Published]) -> None:
    """Make the staged versions of ``tables`` current, all at once; other tables stay."""
    old = commits(spark, root)
    new = (old[0] if old else {}) | {t.name: os.path.basename(t.path) for t in tables}
    rows = spark.createDataFrame(sorted(new.items()), "name string, version string")
    rows.coalesce(1).write.json(os.path.join(root, COMMITS, f"commit-{time.time_ns():020d}"))
    read = [new, *old]
    for t in tables:
        keep = {c.get(t.name) for c in read}
        for n in _folders(spark, table_path(root, t.name))[1]:
            if n.startswith(VERSION) and n not in keep and n < new[t.name]:
                _delete(spark, os.path.join(table_path(root, t.name), n))
    for n in _folders(spark, os.path.join(root, COMMITS))[1][:-2]:
        _delete(spark, os.path.join(root, COMMITS, n))


def discard(spark: SparkSession, tables: list[Published]) -> None:
    """Remove staged versions that must not become current."""
    for t in tables:
        _delete(spark, t.path)


def is_incremental(spark: SparkSession, root: str, name: str) -> bool:
    """Whether the table is in the partitioned layout of the incremental load."""
    return any("=" in n for n in _folders(spark, table_path(root, name))[1])


def stage(df: DataFrame, root: str, name: str, cluster_by: list[str] | None = None,
          columns: list[str] | None = None, partitions: int | None = None, mode: str = "range",
          curve_by: list[str] | None = None, rows: int | None = None) -> Published:
    """Write ``df`` as a version of table ``name`` (``layer.table``) under ``root``, to be committed.

    ``columns`` fixes the stored column order (a reader that matches by
    position can never be handed swapped columns). ``mode="curve"`` clusters by
    ``curve_by`` (default: all of ``cluster_by``); ``rows`` bounds its rows from above.
    """
    t0 = time.time()
    obs = Observation(f"publish:{name}")
    out = df.select(*columns) if columns else df
    if cluster_by:
        keys = [F.col(c).asc_nulls_first() for c in cluster_by]
        if mode == "curve":
            place = curve_key(out, cut_points(out, curve_by or cluster_by, rows))
            out = out.withColumn("__curve", place)
            ranges = [F.col("__curve"), *keys]
            out = out.repartitionByRange(partitions, *ranges) if partitions else out.repartitionByRange(*ranges)
            out = out.drop("__curve")
        if mode == "range":
            out = out.repartitionByRange(partitions, *keys) if partitions else out.repartitionByRange(*keys)
        out = out.sortWithinPartitions(*keys)
    # Above the exchange: the range partitioner's sampling job must not count.
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    path = os.path.join(table_path(root, name), f"{VERSION}{time.time_ns():020d}")
    out.write.mode("error").parquet(path)
    return Published(name, path, int(obs.get["rows"]), time.time() - t0)


def publish(df: DataFrame, root: str, name: str, **layout) -> Published:
    """``stage`` and ``commit`` one table."""
    done = stage(df, root, name, **layout)
    commit(df.sparkSession, root, [done])
    return done


def read_published(spark: SparkSession, root: str, name: str, versions_now: dict[str, str] | None = None) -> DataFrame:
    """The committed version of a table, or a table of the incremental load without
    its partition columns. ``versions_now``: what ``current`` gave, for several reads."""
    now = current(spark, root) if versions_now is None else versions_now
    if name in now:
        return spark.read.parquet(now[name])
    df = spark.read.parquet(table_path(root, name))
    return df.drop(*PARTITIONS)


def register(spark: SparkSession, root: str, name: str) -> None:
    """Expose a published table by name (``layer.table``) in the session
    catalog: ``CREATE SCHEMA IF NOT EXISTS`` + an external Parquet table over
    the committed version, re-declared when the stored schema changed, and
    pointed at it otherwise (SNK2, SNK4). Consumers can then run
    plain SQL such as ``SELECT … FROM gold.obt_flights``."""
    layer, _, table = name.partition(".")
    path = current(spark, root)[name]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{layer}`")
    fq = f"`{layer}`.`{table}`"
    schema = spark.read.parquet(path).schema
    if spark.catalog.tableExists(f"{layer}.{table}"):
        if spark.table(fq).schema != schema:
            spark.sql(f"DROP TABLE {fq}")
        else:
            spark.sql(f"ALTER TABLE {fq} SET LOCATION '{path}'")
            return
    spark.catalog.createTable(f"{layer}.{table}", path=path, source="parquet", schema=schema)

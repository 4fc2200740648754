"""Session settings and the shared storage root.

Library code never creates a session; it uses the caller's. ``local_session``
is for tests and the bench only. ``shared_root`` reads ``spark.checkpoint.dir``
(the shared folder the cluster names) and only sets one when it is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the plans are designed for (all open-source Spark).
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what is measured small; larger sides sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "opslake") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for k, v in RECOMMENDED.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


# Cluster profile (runtime SQL settings) for the 100 TB scale: start shuffles
# wide and let AQE coalesce them to ~256 MB partitions, so the fact dedup
# (the one big shuffle) never builds multi-GB reducer partitions that spill;
# scan splits of 256 MB; a partition 5× the median and over 1 GB is split by
# AQE's skew join (a carrier holding a third of all rows).
CLUSTER = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
}


def apply_recommended(spark: SparkSession, cluster: bool = False) -> None:
    """Apply the runtime SQL settings to an existing session (``cluster``:
    also the large-scale shuffle and scan sizing)."""
    for k, v in {**RECOMMENDED, **(CLUSTER if cluster else {})}.items():
        spark.conf.set(k, v)


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``), as
    configured — stable across applications (SparkContext adds a per-app
    subfolder for RDD checkpoints; published tables must not move per run).

    Only a local session without one gets a scratch folder (tests); a cluster
    session without a shared folder is refused rather than handed a
    machine-local path."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if not root and current:
        root = current.rstrip("/").rsplit("/", 1)[0]
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="opslake-ckpt-")
    if not current:
        sc.setCheckpointDir(root)
    return root


def output_root(spark: SparkSession, name: str = "opslake") -> str:
    """Default warehouse root for published tables: under the shared folder."""
    base = shared_root(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, name)

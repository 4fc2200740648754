"""Helpers shared by the training-data operators: shared folder, ASCII text
functions, written intermediate tables, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# Word separators of the contracts: space and tab .. carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only where it
    is unset (tests) a scratch folder is set, and never on a cluster."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            root = current.rstrip("/").rsplit("/", 1)[0]
        elif sc.master.startswith("local["):
            root = tempfile.mkdtemp(prefix="llm-ckpt-")
        else:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def mounted_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one as a path workers can open. The
    shared folder must be mounted (``file:``) for that; otherwise it raises."""
    path = fresh_path(spark, name)
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" in path or path.startswith("hdfs:"):
        raise RuntimeError("memory-mapped model files need spark.checkpoint.dir on a mounted shared file system")
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder, read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one operator, in a folder of their own in the
    shared folder. Shuffle files of a written table go as soon as it is there,
    and ``drop`` deletes tables that no later job reads."""

    CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, fresh_path(spark, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: cuts lineage, as ``written``."""
        was = self.spark.conf.get(self.CLEAN, None)
        self.spark.conf.set(self.CLEAN, "true")
        try:
            df.write.parquet(f"{self.root}/{name}")
        finally:
            if was is None:
                self.spark.conf.unset(self.CLEAN)
            else:
                self.spark.conf.set(self.CLEAN, was)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(c, UPPER, LOWER)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph given as (a, b) long pairs.

    Returns (node, component): every node that has an edge, with the smallest
    node it can reach. Alternating large-star and small-star contraction
    (Kiveris et al. 2014): each round is two aggregations and joins, nothing
    reaches the driver but one count and checksum per round, and each round is
    checkpointed in the shared folder. No edges give an empty result.
    """
    shared_folder(edges.sparkSession)
    e = (edges.where(F.col("a") != F.col("b"))
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def large_star(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return (both.where(F.col("v") > F.col("u")).join(low, "u")
                .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())

    def small_star(e: DataFrame) -> DataFrame:
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        moved = (e.join(low, "u").where(F.col("v") > F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        return moved.unionByName(low.withColumnRenamed("m", "v")).distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e = e.checkpoint()
    seen = mark(e)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        e = small_star(large_star(e)).checkpoint()
        now = mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("component contraction did not converge")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def sized(df: DataFrame, max_rows: int = 2_000_000) -> DataFrame:
    """Hint a broadcast of a written table of narrow rows if it is counted to
    hold at most ``max_rows``; beyond that the join shuffles both sides."""
    return F.broadcast(df) if df.count() <= max_rows else df

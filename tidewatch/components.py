"""Tables in the shared folder, and connected components over them."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import ship


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where the session names none."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = held.get() if held.isDefined() else "file://" + tempfile.mkdtemp(prefix="tidewatch-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Seconds between two collections of the driver's garbage, which frees the shuffle files of finished jobs.
COLLECT_EVERY = 2.0
_collected = 0.0


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files of finished jobs go when the driver collects its references to them: have it do so."""
    global _collected
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _collected = time.monotonic()


def scratch(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there and a lost executor costs nothing.

    The table stays until ``discard`` is called on what this returns.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if time.monotonic() - _collected > COLLECT_EVERY:
        free_shuffles(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``scratch`` wrote and nothing will read again."""
    for df in tables:
        jvm, spark = df.sparkSession.sparkContext._jvm, df.sparkSession
        at = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of an edge list (a, b): one row (id, component) per vertex, the smallest id reachable.

    Alternating large-star and small-star rounds: each vertex links its larger, then its smaller
    neighbours to the least one it knows. Both are joins on grouped minima, so a hub is never
    gathered in one list, and the rounds needed grow with the logarithm of the graph.
    """
    norm = lambda d: d.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    cur = scratch(norm(edges), "edges")
    state = None
    for _ in range(max_rounds):
        before = cur
        # Large star: every neighbour larger than u links to the least of u's neighbourhood.
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # Small star: every smaller neighbour, and u itself, links to the least smaller neighbour.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        cur = scratch(small, "stars")
        discard(before)
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    # Settled: every vertex points at its root and no root points anywhere.
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).union(cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())

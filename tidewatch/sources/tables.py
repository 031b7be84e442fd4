"""Reading and writing tables: typed Parquet, JSON lines, CSV seeds, compaction, watermarks, the URL frontier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.tables import conform, latest_by, upsert


def write_partitions(df: DataFrame, path: str, partition: str, sort: tuple[str, ...] = (), schema: StructType | None = None) -> None:
    """Overwrite only the partitions that the rows touch, sorted within files so that readers can skip."""
    out = conform(df, schema) if schema else df
    out = out.repartition(partition).sortWithinPartitions(partition, *sort)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def merge_table(df: DataFrame, path: str, keys: list[str], target: str, order: str) -> None:
    """Upsert the last row of each key, by ``order`` (ties by all columns), into a new place.

    A path that is read is never overwritten; the caller then swaps the two.
    """
    spark = df.sparkSession
    last = latest_by(df, keys, [F.desc(order), *[F.col(c) for c in df.columns if c != order]])
    upsert(spark.read.parquet(path), last, keys).write.parquet(target)


def recent_ids(table: DataFrame, key: str, ts: str, since) -> DataFrame:
    """Distinct keys of rows after an instant, to anti-join a new batch with."""
    return table.where(F.col(ts) > since).select(key).where(F.col(key).isNotNull()).distinct()


def drift(df: DataFrame, schema: StructType) -> DataFrame:
    """How a table's columns differ from a schema: column, kind (missing, extra, type), expected, found."""
    want, have = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (schema, df.schema))
    rows = [(c, "missing" if c not in have else "extra" if c not in want else "type", want.get(c), have.get(c)) for c in sorted({*want, *have}) if want.get(c) != have.get(c)]
    return df.sparkSession.createDataFrame(rows, "column string, kind string, expected string, found string")


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "raw")


def write_json(df: DataFrame, path: str, since: str | None = None, ts: str | None = None) -> None:
    out = df if since is None else df.where(F.col(ts) >= F.lit(since).cast("timestamp"))
    out.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def compact(df: DataFrame, key: str, order: str, partition: str, files: int = 1) -> DataFrame:
    """Rows for a rewrite in fewer files: the last row of each key, ``files`` tasks a partition."""
    kept = latest_by(df, [partition, key], [F.desc(order)])
    return kept.repartition(partition, F.pmod(F.xxhash64(key), F.lit(files)))


def read_mark(spark: SparkSession, path: str, pipeline: str) -> str | None:
    row = spark.read.schema("pipeline string, mark string, at timestamp").json(path).where(F.col("pipeline") == pipeline).orderBy(F.desc("at")).first()
    return row["mark"] if row else None


def save_mark(spark: SparkSession, path: str, pipeline: str, mark: str) -> None:
    """Append a high-water mark; call it only when the run has succeeded."""
    spark.range(1).select(F.lit(pipeline).alias("pipeline"), F.lit(mark).alias("mark"), F.current_timestamp().alias("at")).write.mode("append").json(path)


def cutoff(mark: str | None, lookback: str, floor: str, backfill: bool = False) -> str:
    """Where a run starts: the mark or the look-back, never before the floor; a backfill ignores the mark."""
    return max(lookback if backfill or mark is None else mark, floor)


FRONTIER = "url string, source_feed string, title string, published_at timestamp, status string, attempt_count int, last_attempt_at timestamp"


def frontier_add(frontier: DataFrame, found: DataFrame) -> DataFrame:
    """New URLs as pending; known ones and repeats stay as they are."""
    new = found.dropDuplicates(["url"]).join(frontier.select("url"), "url", "left_anti")
    rows = new.select("url", "source_feed", "title", "published_at", F.lit("pending").alias("status"), F.lit(0).alias("attempt_count"), F.lit(None).cast("timestamp").alias("last_attempt_at"))
    return frontier.unionByName(rows)


def frontier_claim(frontier: DataFrame, now: str, limit: int = 100) -> tuple[DataFrame, DataFrame]:
    """(claimed rows, frontier after): the newest pending URLs, undated ones last."""
    chosen = frontier.where("status = 'pending'").orderBy(F.desc_nulls_last("published_at"), "url").limit(limit)
    claimed = chosen.select("url", "source_feed", "title", "published_at")
    at = F.lit(now).cast("timestamp")
    mine = F.col("_claimed").isNotNull()
    after = frontier.join(claimed.select("url", F.lit(1).alias("_claimed")), "url", "left").select(
        "url", "source_feed", "title", "published_at", F.when(mine, "in_progress").otherwise(F.col("status")).alias("status"), (F.col("attempt_count") + F.when(mine, 1).otherwise(0)).alias("attempt_count"), F.when(mine, at).otherwise(F.col("last_attempt_at")).alias("last_attempt_at")
    )
    return claimed, after


def frontier_reset_stale(frontier: DataFrame, now: str, hours: int = 2) -> DataFrame:
    stale = (F.col("status") == "in_progress") & (F.col("last_attempt_at") < F.lit(now).cast("timestamp") - F.expr(f"interval {int(hours)} hours"))
    return frontier.withColumn("status", F.when(stale, "pending").otherwise(F.col("status")))


def frontier_retryable(frontier: DataFrame, most: int = 3) -> DataFrame:
    return frontier.where((F.col("status") == "failed") & (F.col("attempt_count") < most))


def frontier_purge(frontier: DataFrame, now: str, days: int = 30) -> DataFrame:
    old = F.col("last_attempt_at") < F.lit(now).cast("timestamp") - F.expr(f"interval {int(days)} days")
    return frontier.where(~(F.col("status").isin("done", "failed") & F.coalesce(old, F.lit(False))))


def frontier_stats(frontier: DataFrame) -> DataFrame:
    return frontier.groupBy("status").agg(F.count("*").alias("n"))


def cooldowns(fetches: DataFrame, base_seconds: int = 900, cap_seconds: int = 3600, trigger: int = 3) -> DataFrame:
    """Cool-down after each fetch (domain, at, ok): doubles with each failure in a row past the trigger, and a success resets it."""
    by = Window.partitionBy("domain").orderBy("at")
    streak = fetches.withColumn("_island", F.sum(F.col("ok").cast("int")).over(by))
    run = F.sum((~F.col("ok")).cast("int")).over(Window.partitionBy("domain", "_island").orderBy("at"))
    out = streak.withColumn("consecutive_failures", run)
    return out.withColumn("cooldown_seconds", F.when(F.col("consecutive_failures") >= trigger, F.least(F.lit(float(cap_seconds)), base_seconds * F.pow(F.lit(2.0), F.col("consecutive_failures") - trigger))).otherwise(0.0).cast("long")).drop("_island")


def feed_health(fetches: DataFrame) -> DataFrame:
    """Availability, mean latency (by a decimal sum, whatever the order of rows) and trailing failures of each feed (feed, at, ok, latency_ms)."""
    last_ok = Window.partitionBy("feed").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, 0)
    marked = fetches.withColumn("_seen_ok", F.max(F.col("ok").cast("int")).over(last_ok))
    return marked.groupBy("feed").agg(F.avg(F.col("ok").cast("double")).alias("availability"), F.avg(F.col("latency_ms").cast("decimal(18,4)")).cast("double").alias("avg_latency_ms"), F.count_if(F.col("_seen_ok") == 0).alias("consecutive_failures"))

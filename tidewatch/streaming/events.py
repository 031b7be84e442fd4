"""Structured Streaming: messages in, the batch expressions on them, idempotent upserts out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

MESSAGE = "content_hash string, published_at timestamp, person_id long, source_type string, text string, engagement double"


def file_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def decode_messages(raw: DataFrame, column: str = "value", encoded: bool = True) -> tuple[DataFrame, DataFrame]:
    """(messages, rejected): base64 JSON payloads; what does not parse goes to its own stream."""
    body = F.unbase64(column).cast("string") if encoded else F.col(column)
    parsed = raw.select(F.col(column).alias("payload"), F.from_json(body, MESSAGE).alias("m"))
    good = F.col("m.content_hash").isNotNull() & F.col("m.published_at").isNotNull()
    return parsed.where(good).select("m.*"), parsed.where(~F.coalesce(good, F.lit(False))).select("payload")


def deduplicated(messages: DataFrame, key: str = "content_hash", ts: str = "published_at", delay: str = "2 hours") -> DataFrame:
    """Delivery is at least once; state is kept only as long as the watermark allows a repeat."""
    return messages.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def rolling_volume(messages: DataFrame, by: str = "person_id", ts: str = "published_at", window: str = "24 hours", slide: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    return messages.withWatermark(ts, delay).groupBy(F.window(ts, window, slide), by).agg(F.count("*").alias("volume"), F.sum("engagement").alias("engagement")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), by, "volume", "engagement")


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, key: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df, once: bool = True) -> StreamingQuery:
    """Write each micro-batch under its own id, so that a batch that runs again overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch.dropDuplicates([key])).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id:010d}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_upserts(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The latest row of each key over all batches."""
    rows = spark.read.option("basePath", path).parquet(path)
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), "batch_id").alias("r")).select(key, "r.*")

"""Time series: dense calendars, rolling baselines, band joins, trend and reach."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _micros(ts) -> Column:
    """Microseconds of an instant, with or without a time zone."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def calendar(spark, first: str, last: str, name: str = "day") -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias(name))


def densify(counts: DataFrame, keys: DataFrame, days: DataFrame, key: str, day: str = "day", value: str = "n") -> DataFrame:
    """Every key on every day, 0 where there is no count. The calendar is broadcast: it has a row a day."""
    grid = keys.crossJoin(F.broadcast(days))
    return grid.join(counts, [key, day], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def anomalies(dense: DataFrame, key: str, day: str = "day", value: str = "n", frame: int = 30, z: float = 2.0, least: int = 3) -> DataFrame:
    """z-score against the ``frame`` days before; days without a count go after the window has seen them."""
    w = Window.partitionBy(key).orderBy(day).rowsBetween(-frame, -1)
    out = dense.withColumn("baseline_mean", F.avg(value).over(w)).withColumn("baseline_std", F.round(F.stddev_samp(value).over(w), 6))
    score = F.when(F.col("baseline_std") > 0, F.round((F.col(value) - F.col("baseline_mean")) / F.col("baseline_std"), 6))
    out = out.withColumn("z_score", score).where(F.col(value) > 0)
    return out.withColumn("is_anomaly", F.coalesce((F.col("z_score") >= z) & (F.col(value) >= least), F.lit(False)))


def band_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, seconds: int) -> DataFrame:
    """Pairs of equal keys at most ``seconds`` apart.

    Time is cut into bins of that width and the right side goes into three of them, so a hot key
    meets only its neighbours in time instead of all its rows.
    """
    bin_of = lambda ts: F.floor(_micros(ts) / (seconds * 1_000_000))
    a = left.withColumn("_bin", bin_of(F.col(left_ts)))
    b = right.withColumn("_bin", F.explode(F.sequence(bin_of(F.col(right_ts)) - 1, bin_of(F.col(right_ts)) + 1)))
    apart = F.abs(_micros(left_ts) - _micros(right_ts))
    return a.join(b, [*keys, "_bin"]).where(apart <= seconds * 1_000_000).withColumn("delta_seconds", apart / 1e6).drop("_bin")


def mutual_best(pairs: DataFrame, left_id: str, right_id: str, cost: str) -> DataFrame:
    """Pairs that are each other's nearest; ties by id."""
    by_left = Window.partitionBy(left_id).orderBy(cost, right_id)
    by_right = Window.partitionBy(right_id).orderBy(cost, left_id)
    return pairs.withColumns({"_l": F.row_number().over(by_left), "_r": F.row_number().over(by_right)}).where("_l = 1 and _r = 1").drop("_l", "_r")


def reach(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Per key: how many rows, over how many hours, and a velocity (a fifth of rows an hour; 0.1 for one row, 0.5 for one instant; at most 1)."""
    span = (_micros(F.max(ts)) - _micros(F.min(ts))) / 3.6e9
    out = df.groupBy(key).agg(F.count("*").alias("volume"), span.alias("span_hours"))
    speed = F.when(F.col("volume") < 2, 0.1).when(F.col("span_hours") <= 0, 0.5).otherwise(F.least(F.lit(1.0), F.col("volume") / F.when(F.col("span_hours") > 0, F.col("span_hours")) / 5))
    return out.withColumn("velocity", speed)


def trend(df: DataFrame, key: str, ts: str, as_of: Column, window_hours: int = 48, half_life: float = 12.0) -> DataFrame:
    """Trend score of each key in a window: 0.35 volume + 0.40 recency + 0.25 velocity."""
    age = (_micros(as_of) - _micros(ts)) / 3.6e9
    inside = df.withColumn("_age", age).where((F.col("_age") >= 0) & (F.col("_age") <= window_hours))
    total = inside.agg(F.count("*").alias("_total"))
    span = (F.max("_age") - F.min("_age")).alias("span")
    each = inside.groupBy(key).agg(F.count("*").alias("n"), F.avg(F.exp(-F.log(F.lit(2.0)) * F.col("_age") / half_life)).alias("recency"), span)
    volume = F.log1p(F.col("n")) / F.log1p(F.greatest(F.col("_total"), F.lit(10)))
    velocity = F.when(F.col("n") < 2, 0.1).when(F.col("span") <= 0, 0.5).otherwise(F.least(F.lit(1.0), F.col("n") / F.when(F.col("span") > 0, F.col("span")) / 5))
    return each.crossJoin(F.broadcast(total)).select(key, "n", F.round(0.35 * F.least(volume, F.lit(1.0)) + 0.40 * F.col("recency") + 0.25 * velocity, 6).alias("trend_score"))

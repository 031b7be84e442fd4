"""Row selection and table maintenance: latest rows, deduplication, upserts, high-water marks, history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row of each key, the first by ``order``; the order should be total, so that the choice is one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)


def first_seen(df: DataFrame, order: Sequence[Column], *keys: str) -> DataFrame:
    """First row per key in ingest order, key after key: a row that falls out for one key does not hold back the next."""
    for key in keys:
        df = latest_by(df, [key], order)
    return df


def unseen(df: DataFrame, known: DataFrame, *keys: str) -> DataFrame:
    """Rows that no known table names by any key."""
    for key in keys:
        df = df.join(known.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return df


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace those of equal keys; columns that one side lacks are null there."""
    return existing.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def above_mark(df: DataFrame, column: str, target: DataFrame, inclusive: bool = False, lookback_days: int = 0, floor: str = "1970-01-01") -> DataFrame:
    """Rows past the largest value that ``target`` holds; all of them if it holds none."""
    mark = target.agg(F.coalesce(F.max(column), F.lit(floor).cast("timestamp")).alias("_mark"))
    at = F.col("_mark") - F.expr(f"interval {int(lookback_days)} days")
    ahead = F.col(column) >= at if inclusive else F.col(column) > at
    return df.crossJoin(F.broadcast(mark)).where(ahead).drop("_mark")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of a schema, in its order and types: missing ones are null, others go."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def slowly_changing(existing: DataFrame, seed: DataFrame, key: str, tracked: Sequence[str], as_of: str) -> DataFrame:
    """Type 2 history: ``existing`` has valid_from, valid_to and is_current beside the key and tracked columns.

    Current rows whose tracked values differ (null-safe) or whose key is gone are closed at
    ``as_of``; changed and new keys open a row there; closed history is carried on.
    """
    day = F.lit(as_of).cast("date")
    current, closed = existing.where("is_current"), existing.where("not is_current")
    cols = [key, *tracked]
    old, new = current.alias("o"), seed.select(*cols).alias("n")
    both = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    in_old, in_new = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    keeps = both.where(in_old & in_new & same).select("o.*")
    ends = both.where(in_old & ~(in_new & same)).select(*[F.col(f"o.{c}") for c in cols], F.col("o.valid_from"), day.alias("valid_to"), F.lit(False).alias("is_current"))
    opens = both.where(in_new & ~(in_old & same)).select(*[F.col(f"n.{c}") for c in cols], day.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    return closed.unionByName(keeps).unionByName(ends).unionByName(opens)


def full_refresh(seed: DataFrame, tracked: Sequence[str], key: str, as_of: str) -> DataFrame:
    return seed.select(key, *tracked, F.lit(as_of).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))


def null_profile(df: DataFrame) -> DataFrame:
    """Share of nulls (blank texts and empty arrays count) of each column, in one pass: column, null_rate, critical."""
    rates = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        empty = c.isNull() | (F.trim(c) == "" if kind == "string" else F.size(c) == 0 if kind == "array" else F.lit(False))
        rates.append(F.struct(F.lit(f.name).alias("column"), F.avg(F.when(empty, 1.0).otherwise(0.0)).alias("null_rate")))
    return df.agg(F.array(*rates).alias("r")).select(F.explode("r").alias("r")).select("r.*").withColumn("critical", F.col("null_rate") > 0.5)


def concentration(df: DataFrame, column: str, alert_above: float = 0.70) -> DataFrame:
    """Herfindahl index of a column's values, the dominant one and its share."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    share = F.col("n") / F.col("total")
    return counts.crossJoin(F.broadcast(total)).agg(F.sum(share * share).alias("hhi"), F.count("*").alias("n_sources"), F.max_by(column, F.struct("n", column)).alias("dominant"), F.max(share).alias("dominant_share")).withColumn("alert", F.col("dominant_share") > alert_above)

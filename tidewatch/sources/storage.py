"""Stores of named tables behind one interface, chosen by the scheme of their address."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.tables import conform, latest_by, upsert


class Store(Protocol):
    def read(self, name: str) -> DataFrame: ...

    def append(self, df: DataFrame, name: str) -> None: ...

    def replace(self, df: DataFrame, name: str) -> None: ...


class FileStore:
    """Tables as folders of files of one format; they can lie in any store that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str, fmt: str):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def read(self, name: str) -> DataFrame:
        return self.spark.read.format(self.fmt).load(f"{self.root}/{name}")

    def append(self, df: DataFrame, name: str) -> None:
        df.write.mode("append").format(self.fmt).save(f"{self.root}/{name}")

    def replace(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").format(self.fmt).save(f"{self.root}/{name}")


class CatalogStore:
    """Tables of the session's catalog. A table format with commits of its own (Iceberg, Delta) is a matter of the catalog's settings."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database

    def read(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def append(self, df: DataFrame, name: str) -> None:
        table = f"{self.database}.{name}"
        if self.spark.catalog.tableExists(table):
            df.writeTo(table).append()
        else:
            df.write.saveAsTable(table)

    def replace(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").saveAsTable(f"{self.database}.{name}")


class NoStore:
    """Takes everything and holds nothing; for dry runs."""

    def __init__(self, spark: SparkSession, schema: StructType | None = None):
        self.spark, self.schema = spark, schema or StructType([])

    def read(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def append(self, df: DataFrame, name: str) -> None:
        df.write.format("noop").mode("overwrite").save()

    replace = append


def open_store(spark: SparkSession, address: str) -> Store:
    """``parquet:ROOT``, ``json:ROOT``, ``orc:ROOT``, ``catalog:DATABASE`` or ``none:``."""
    scheme, _, rest = address.partition(":")
    if scheme in ("parquet", "json", "orc"):
        return FileStore(spark, rest, scheme)
    if scheme == "catalog":
        return CatalogStore(spark, rest)
    if scheme == "none":
        return NoStore(spark)
    raise ValueError(f"no store for {address!r}")


def merge_into(store: Store, df: DataFrame, name: str, into: str, keys: list[str], order: str) -> None:
    """Upsert the last row of each key of a batch into another table of the store: what is read is never overwritten."""
    store.replace(upsert(store.read(name), latest_by(df, keys, [F.desc(order), *[F.col(c) for c in df.columns if c != order]]), keys), into)


AUDIT = "at timestamp, kind string, subject string, model string, n_in long, n_out long, redactions long, status string, detail string"


def audit(store: Store, rows: DataFrame, name: str = "audit") -> None:
    """Append calls and resolutions to the audit log; columns that a caller lacks are null."""
    schema = StructType.fromDDL(AUDIT)
    store.append(conform(rows.withColumn("at", F.col("at") if "at" in rows.columns else F.current_timestamp()), schema), name)

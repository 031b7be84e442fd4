"""Sessions: fixed settings for reproducible results, and the package on the workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str = "local[*]", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName("tidewatch")
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Bytes and rows of an Arrow batch, so that a worker holds a few MB at a time however long the rows are.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.execution.arrow.maxRecordsPerBatch": "4000"}


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once a context; they need not have it installed. Batches are bounded where the session does not say."""
    context = spark.sparkContext
    for key, value in BATCH.items():
        if not context.getConf().contains(key):
            spark.conf.set(key, value)
    if getattr(context, "_tidewatch_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidewatch-"), "tidewatch_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tidewatch", os.path.relpath(full, package)))
    context.addPyFile(path)
    context._tidewatch_shipped = True

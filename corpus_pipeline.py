"""The corpus pipeline: documents through the stages below, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.queries import STAGES

#: The stages work by n-gram models, hashing and tokenizers, which SQL does not express; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatch.llm.common import documents, scratch

    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch(docs, f"pipeline-{name}")
    return docs

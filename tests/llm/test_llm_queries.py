"""The registered queries on the smallest tables: against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from tidewatch.llm import common
from tidewatch.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for name in ("documents", "conversations", "labels", "benchmark"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return c


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(tuple(repr(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, sf, con, name):
    got = QUERIES[name](spark, sf)
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert as_rows(got.columns, [tuple(r) for r in got.collect()]) == as_rows(names, want.fetchall())


def test_pipeline_stages(spark, sf):
    docs = common.documents(spark, sf)
    before = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.scratch(stage(spark, before, sf), "stage")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            assert out.join(before, "doc_id", "left_anti").count() == 0 and 0 < out.count() < before.count()
            before = out
    assert out.select("doc_id").distinct().count() == before.count()
    assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0

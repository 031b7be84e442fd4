"""Every registered query of the library against its SQL on the smallest tables; the rest must run and return rows."""

import duckdb
import pytest

from tidewatch.plans import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for name in TABLES:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return c


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    show = lambda v: repr(float(v)) if isinstance(v, float) else str(v)
    return sorted(tuple(show(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_agrees_with_sql(spark, sf, con, name):
    got = queries.QUERIES[name](spark, sf)
    want = con.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert as_rows(got.columns, got.collect()) == as_rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_runs(spark, sf, name):
    assert queries.QUERIES[name](spark, sf).collect()


def test_driver_contract(spark):
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_plans(spark, sf):
    """Shapes that matter at scale: partial sums before the join, pruned scans, no cartesian product."""
    weekly = queries.QUERIES["mentions_by_person_weekly"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in weekly and "partial_count" in weekly
    feeds = queries.QUERIES["coverage_schedule"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in feeds
    pairs = queries.QUERIES["int_cross_post_pairs"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in pairs and "CartesianProduct" not in pairs


def test_every_customer_takes_part(spark, sf):
    """Each supplier has the handle of the customer of its number, whatever that is; each customer is a mention and a person."""
    customers, suppliers = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("customer", "supplier"))
    pairs = customers.join(suppliers, customers["c_custkey"] == suppliers["s_suppkey"]).count()
    assert pairs and queries.QUERIES["personas"](spark, sf).where("author_key like 'c%'").count() == pairs
    people = queries.QUERIES["resolved_people"](spark, sf)
    assert people.count() == customers.count() and people.where("person_id is null or person_id != mention_id").isEmpty()


def test_pairs_are_not_shuffled(spark, sf):
    """The span of a pair comes with it; checks of pairs send a row a task."""
    plan = queries.QUERIES["fct_coactivation_span"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("MapInArrow")[0]
    checks = queries.QUERIES["quality_assertions"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in checks and "events" not in checks


def test_pairs_found_wrong_are_counted(monkeypatch):
    import pyarrow as pa

    from tidewatch.operators import together

    rows = [(1, 1, 2, 1, [7]), (1, 1, 2, 1, [7]), (1, 1, 2, 1, [7]), (1, 3, 2, 1, [7]), (1, 3, 4, 2, [7])]
    whole = pa.Table.from_pylist([dict(zip(("day", "author_a", "author_b", "n_shared", "targets"), r, strict=True)) for r in rows])
    for size in (1, 2, 5):
        monkeypatch.setattr(together, "shared_pairs", lambda group, size=size: lambda batches: whole.to_batches(size))
        assert [b.to_pylist() for b in together.checked_pairs(["day"])(iter(()))] == [[{"n": 5, "twice": 1, "sizes": 1, "disorder": 1}]]

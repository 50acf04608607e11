"""Every registered query against its SQL, as the driver checks it, at the smallest scale."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

# Queries of optional parts have tests of their own.
OWN = list(registry._QUERIES)


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(OWN) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, sf_dir, duck, name):
    frame = registry.queries()[name](spark, sf_dir)
    result = duck.execute(registry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(names)
    expected = sorted(result.fetchall(), key=repr)
    assert sorted((tuple(row) for row in frame.select(*names).collect()), key=repr) == expected
    assert expected


def test_line_items_are_never_broadcast(spark, sf_dir):
    """Even where they are small enough: both sides grow with the data."""
    plan = registry.queries()["report_hourly"](spark, sf_dir)._jdf.queryExecution().executedPlan()
    assert "SortMergeJoin [l_orderkey" in plan.toString()


def test_retention_prunes_the_landed_folders(spark, sf_dir):
    for name in ("raw_retention", "raw_expired_days"):
        plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan()
        assert "make_date(" in plan.toString().split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_entry(spark):
    assert registry.entry(spark).count() == 6

"""Ids that an earlier run has, found by its filter and then by its files."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderflow import fixtures
from orderflow.operators import bloom
from orderflow.sources import catalog, run_ids
from orderflow.sources.processed import read_processed
from orderflow.streaming.incremental import run_incremental
from tests.conftest import rows

TIMEOUT = 300


@pytest.fixture
def zone(spark, raw, folder):
    class Zone:
        path, out, check = f"{folder}/raw", f"{folder}/processed", f"{folder}/check"

        def run(self, name, *ids, across=True):
            days = {"year": F.lit("2026"), "month": F.lit("01"), "day": F.lit("02")}
            frame = raw(*[{"order_id": i} for i in ids]).withColumns(days)
            fixtures.land_batch(frame, self.path, name)
            found = run_incremental(spark, self.path, self.out, self.check, TIMEOUT, across_runs=across)
            return [r.written_rows for r in found]

        def ids(self):
            return [i for (i,) in rows(read_processed(spark, self.out), "order_id")]

    return Zone()


def test_filters_have_what_they_were_made_of(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("o"), "id").alias("order_id"))
    blocks = bloom.block_count(20_000)
    assert blocks == 32 and bloom.block_count(0) == 1 and bloom.block_count(1025) == 2
    made = bloom.build_filter(ids, "order_id", blocks).withColumn("run_id", F.lit("x")).persist()
    assert bloom.may_contain(ids, "order_id", made, [blocks]).count() == 20_000
    others = spark.range(20_000, 1_020_000).select(F.concat(F.lit("o"), "id").alias("order_id"))
    # About one in a million; a hundred times that would still do.
    assert bloom.may_contain(others, "order_id", made, [blocks]).count() <= 100


def test_filters_of_several_sizes(spark):
    parts = []
    for n, size in enumerate((10, 3000, 9000)):
        ids = spark.range(n * 10_000, n * 10_000 + size).select(F.col("id").cast("string").alias("order_id"))
        made = bloom.build_filter(ids, "order_id", bloom.block_count(size))
        parts.append(made.withColumn("run_id", F.lit(str(n))))
    filters = parts[0].union(parts[1]).union(parts[2])
    asked = spark.createDataFrame([("5",), ("12999",), ("28999",), ("29000",), (None,)], "order_id string")
    found = bloom.may_contain(asked, "order_id", filters, [1, 4, 16, 1 << 20])
    assert rows(found) == [("12999", "1"), ("28999", "2"), ("5", "0")]


def test_known_ids_are_left_out(zone):
    assert zone.run("one", "a", "b") == [2]
    assert zone.run("two", "b", "c", "c") == [1]
    assert zone.run("three", "a", "b", "c") == []
    assert zone.ids() == ["a", "b", "c"]
    # Off by default.
    assert zone.run("four", "a", across=False) == [1]


def test_orders_without_an_id_stay(zone):
    assert zone.run("one", None, "a") == [2]
    assert zone.run("two", None, "a") == [1]


def test_runs_that_were_made_without_a_filter(zone):
    zone.run("one", "a", across=False)
    zone.run("two", "b", across=False)
    assert not Path(zone.out, "_ids").exists()
    assert zone.run("three", "a", "b", "c") == [1]


def test_a_run_tried_again_does_not_know_itself(zone):
    zone.run("one", "a")
    assert zone.run("two", "a", "b") == [1]
    for commit in Path(zone.check, "commits").glob("*1"):
        commit.unlink()
    assert zone.run("three", "c") == [1, 1]
    assert zone.ids() == ["a", "b", "c"]


def test_runs_whose_filter_misses_are_not_read(spark, zone):
    zone.run("one", "a")
    zone.run("two", "b")
    for file in Path(zone.out).glob("run_id=*-1/**/*.parquet"):
        file.write_bytes(b"not to be read")
    for crc in Path(zone.out).glob("run_id=*-1/**/.*.crc"):
        crc.unlink()
    orders = spark.createDataFrame([("a",), ("z",)], "order_id string")
    found = run_ids.hits(spark, orders, zone.out, "new")
    assert [r.rsplit("-", 1)[1] for _, r in rows(found)] == ["0"]
    assert rows(run_ids.drop_known(spark, orders, zone.out, "new", f"{zone.check}-hits")) == [("z",)]


def test_a_false_hit_is_told_from_a_true_one(spark, zone, monkeypatch):
    """Even if a filter says yes to everything."""
    zone.run("one", "a")
    monkeypatch.setattr(
        run_ids, "may_contain",
        lambda ids, key, filters, sizes: ids.withColumn("run_id", F.lit(zone_run(zone))),
    )
    orders = spark.createDataFrame([("a",), ("y",), ("z",)], "order_id string")
    assert rows(run_ids.drop_known(spark, orders, zone.out, "new", f"{zone.check}-hits")) == [("y",), ("z",)]


def zone_run(zone):
    return next(Path(zone.out).glob("run_id=*")).name.partition("=")[2]


def test_ids_of_merged_runs_are_known(spark, folder, zone):
    name = f"db_{abs(hash(folder))}"
    zone.run("one", "a")
    zone.run("two", "b")
    catalog.register_processed(spark, zone.out, name, database_path=f"{folder}/db")
    catalog.compact_runs(spark, zone.out, name)
    assert zone.run("three", "a", "c") == [1]
    catalog.remove_replaced(spark, zone.out, name)
    assert zone.run("four", "b", "c", "d") == [1]
    assert zone.ids() == ["a", "b", "c", "d"]

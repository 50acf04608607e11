from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderflow.operators.retention import expired_days, raw_retention
from orderflow.plans.curate import curate_orders
from orderflow.plans.nightly import nightly_run
from orderflow.session import conf_scope
from orderflow.sources import catalog
from orderflow.sources.processed import read_evolved, read_processed, write_processed
from orderflow.sources.raw_zone import read_raw
from orderflow.streaming.incremental import run_incremental
from tests.conftest import rows

TIMEOUT = 300


def land(raw, path, *orders, day="02"):
    (
        raw(*orders)
        .withColumns({"year": F.lit("2026"), "month": F.lit("01"), "day": F.lit(day)})
        .write.mode("append")
        .partitionBy("year", "month", "day")
        .json(path)
    )


def paths(folder):
    return f"{folder}/raw", f"{folder}/processed", f"{folder}/check"


def test_runs_take_only_new_files(spark, raw, folder):
    raw_path, out, check = paths(folder)
    land(raw, raw_path, {"order_id": "a"}, {"order_id": "a"}, {"order_id": "b"})
    (first,) = run_incremental(spark, raw_path, out, check, TIMEOUT)
    assert (first.raw_rows, first.written_rows) == (3, 2)
    assert run_incremental(spark, raw_path, out, check, TIMEOUT) == []

    # An id that comes again in a later run is kept again.
    land(raw, raw_path, {"order_id": "a"}, {"order_id": "c"}, day="03")
    (second,) = run_incremental(spark, raw_path, out, check, TIMEOUT)
    assert (second.raw_rows, second.written_rows) == (2, 2)
    assert rows(read_processed(spark, out), "order_id") == [("a",), ("a",), ("b",), ("c",)]
    assert second.run_id != first.run_id


def test_run_tried_again_adds_nothing(spark, raw, folder):
    raw_path, out, check = paths(folder)
    land(raw, raw_path, {"order_id": "a"}, {"order_id": "b"})
    (first,) = run_incremental(spark, raw_path, out, check, TIMEOUT)
    for commit in Path(check, "commits").glob("*0*"):
        commit.unlink()
    land(raw, raw_path, {"order_id": "c"}, day="03")
    again = run_incremental(spark, raw_path, out, check, TIMEOUT)
    assert [run.run_id for run in again][0] == first.run_id
    assert sum(run.written_rows for run in again) == 3
    assert rows(read_processed(spark, out), "order_id") == [("a",), ("b",), ("c",)]


def test_new_checkpoint_is_refused_unless_asked_for(spark, raw, folder):
    raw_path, out, check = paths(folder)
    land(raw, raw_path, {"order_id": "a"})
    run_incremental(spark, raw_path, out, check, TIMEOUT)
    with pytest.raises(ValueError, match="another checkpoint"):
        run_incremental(spark, raw_path, out, f"{check}-2", TIMEOUT)
    assert read_processed(spark, out).count() == 1
    run_incremental(spark, raw_path, out, f"{check}-2", TIMEOUT, again=True)
    assert read_processed(spark, out).count() == 2


def test_nightly_run_registers_what_it_wrote(spark, raw, folder):
    name = f"db_{abs(hash(folder))}"

    def night():
        return nightly_run(
            spark, *paths(folder), name, database_path=f"{folder}/db", timeout=TIMEOUT
        )

    raw_path, out, check = paths(folder)
    runs, table = night()
    assert runs == [] and table.count() == 0

    land(raw, raw_path, {"order_id": "a"})
    runs, table = night()
    assert len(runs) == 1 and table.count() == 1

    # A night that ended before its refresh is made up for by the next one.
    land(raw, raw_path, {"order_id": "b"}, day="03")
    run_incremental(spark, raw_path, out, check, TIMEOUT)
    runs, table = night()
    assert runs == [] and table.count() == 2


@pytest.fixture
def night(spark, folder):
    name = f"db_{abs(hash(folder))}"
    return lambda: nightly_run(
        spark, *paths(folder), name, database_path=f"{folder}/db", timeout=TIMEOUT
    )


def test_nights_with_files_make_up_for_earlier_ones(spark, raw, folder, night):
    raw_path, out, check = paths(folder)
    land(raw, raw_path, {"order_id": "a"})
    night()
    land(raw, raw_path, {"order_id": "b"}, day="03")
    (missed,) = run_incremental(spark, raw_path, out, check, TIMEOUT)
    land(raw, raw_path, {"order_id": "c"}, day="04")
    name = f"db_{abs(hash(folder))}"
    (tonight, *more), table = night()
    assert more == [] and tonight.run_id != missed.run_id
    assert rows(table, "order_id") == [("a",), ("b",), ("c",)]
    assert catalog.unregistered_runs(spark, out, name) == []


def test_nights_make_up_for_half_a_refresh(spark, raw, folder, night, monkeypatch):
    raw_path, _, _ = paths(folder)
    land(raw, raw_path, {"order_id": "a"})
    night()
    added = catalog._add_partitions

    def half(spark, files, path, runs):
        added(spark, files, path, runs)
        (run,) = runs
        gone = f"run_id = '{run}', order_date = '2026-01-02', category = 'LAST'"
        spark.sql(f"ALTER TABLE {files} DROP PARTITION ({gone})")
        raise RuntimeError("ended")

    land(raw, raw_path, {"order_id": "b"}, {"order_id": "c", "category": "last"}, day="03")
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="ended"):
        patch.setattr(catalog, "_add_partitions", half)
        night()
    land(raw, raw_path, {"order_id": "d"}, day="04")
    runs, table = night()
    assert len(runs) == 1 and rows(table, "order_id") == [(k,) for k in "abcd"]


def test_a_run_without_rows_is_no_hindrance(raw, folder, night):
    raw_path, _, _ = paths(folder)
    land(raw, raw_path, {"order_id": "a"})
    night()
    (Path(raw_path) / "year=2026/month=01/day=02/empty.json").write_text("")
    assert night()[0] == []
    land(raw, raw_path, {"order_id": "b"}, day="03")
    assert rows(night()[1], "order_id") == [("a",), ("b",)]


def test_file_without_rows(spark, raw, folder):
    raw_path, out, check = paths(folder)
    Path(raw_path, "year=2026/month=01/day=02").mkdir(parents=True)
    Path(raw_path, "year=2026/month=01/day=02/part.json").write_text("")
    assert run_incremental(spark, raw_path, out, check, TIMEOUT) == []
    land(raw, raw_path, {})
    (run,) = run_incremental(spark, raw_path, out, check, TIMEOUT)
    assert (run.raw_rows, run.written_rows) == (1, 1)


def test_partitions_that_have_no_value(spark, raw, folder):
    """A blank category and an unreadable time go to the default partition, as null."""
    orders = curate_orders(
        raw(
            {"order_id": "a", "category": " "},
            {"order_id": "b", "order_timestamp": "nope"},
            {"order_id": "c", "category": "007"},
        )
    )
    assert rows(orders, "order_id", "category")[0] == ("a", "")
    write_processed(orders, folder + "/out", "0")
    assert rows(read_processed(spark, folder + "/out"), "order_id", "category") == [
        ("a", None),
        ("b", "HOME"),
        ("c", "007"),
    ]
    assert read_processed(spark, folder + "/out").where("order_date IS NULL").count() == 1
    assert list(Path(folder, "out/run_id=0").glob("order_date=*/category=__HIVE_DEFAULT*"))


def test_evolved_runs(spark, raw, folder):
    path = f"{folder}/out"
    write_processed(curate_orders(raw({"order_id": "a"})), path, "0")
    later = curate_orders(raw({"order_id": "b", "category": "007"}))
    write_processed(later.withColumn("coupon", F.lit("X")), path, "1")
    evolved = read_evolved(spark, path)
    assert rows(evolved, "order_id", "category", "coupon") == [
        ("a", "HOME", None),
        ("b", "007", "X"),
    ]
    assert evolved.schema["order_date"].dataType.simpleString() == "date"
    assert "coupon" not in read_processed(spark, path).columns


def test_hot_partition_is_split(spark, folder):
    """A third of all rows in one (date, category): its files come from several tasks."""
    orders = spark.range(60_000).selectExpr(
        "cast(id AS string) AS order_id",
        "sha2(cast(id AS string), 512) AS product_name",
        "DATE '2026-01-01' AS order_date",
        "CASE WHEN id % 3 = 0 THEN 'HOT' ELSE concat('C', id % 40) END AS category",
    )
    with conf_scope(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k"}):
        write_processed(orders, folder + "/out", "0")
    hot = list(Path(folder, "out/run_id=0/order_date=2026-01-01/category=HOT").glob("*.parquet"))
    assert len(hot) > 1
    assert spark.read.parquet(folder + "/out").count() == 60_000


def test_retention_prunes_partitions(spark, raw, folder):
    for day in ("01", "02", "03"):
        land(raw, f"{folder}/raw", {}, day=day)
    zone = read_raw(spark, f"{folder}/raw")
    kept = raw_retention(zone, as_of=dt.date(2026, 1, 4), days=2)
    assert rows(kept, "day") == [(2,), (3,)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "make_date(" in plan.split("PartitionFilters: [", 1)[1].split("PushedFilters", 1)[0]
    assert "Filter (" not in plan
    expired = expired_days(zone, as_of=dt.date(2026, 1, 4), days=2)
    assert rows(expired) == [(2026, 1, 1, 1)]
    assert raw_retention(zone, as_of=dt.date(2026, 2, 1)).count() == 2

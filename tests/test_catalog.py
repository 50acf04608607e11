from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import oracle_queries
from orderflow.plans import reports
from orderflow.plans.curate import curate_orders
from orderflow.schema import PROCESSED
from orderflow.sources import catalog
from orderflow.sources.catalog import list_partitions, register_processed
from orderflow.sources.processed import read_processed, write_processed
from tests.conftest import rows


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def registered(spark, raw, folder):
    path = f"{folder}/processed"
    orders = curate_orders(
        raw(
            *[
                {"order_id": f"o{day}", "order_timestamp": f"2026-01-{day:02d}T00:00:00+00:00"}
                for day in range(1, 21)
            ]
        )
    )
    write_processed(orders, path, "0")
    name = f"db_{abs(hash(folder))}"
    table = register_processed(spark, path, name, database_path=f"{folder}/db")
    return path, name, table


def test_table_is_found_by_name(spark, registered):
    _, name, table = registered
    assert table.columns == PROCESSED.fieldNames()
    assert [field.dataType for field in table.schema] == [field.dataType for field in PROCESSED]
    assert spark.sql(f"SELECT count(*) FROM {name}.orders_processed").first()[0] == 20
    assert list_partitions(table).count() == 20


def test_later_runs_appear_after_registering_again(spark, raw, registered):
    path, name, table = registered
    write_processed(curate_orders(raw({"order_id": "new"})), path, "1")
    assert register_processed(spark, path, name).count() == 21
    partitions = list_partitions(spark.table(f"{name}.orders_processed"))
    assert partitions.where("order_date = DATE '2026-01-02'").first().n == 2


def test_daily_revenue_reads_its_days_only(registered):
    _, _, table = registered
    report = reports.daily_revenue(table, as_of=dt.date(2026, 1, 20))
    plan = plan_of(report)
    assert "order_date#" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "EqualTo(order_status,PLACED)" in plan
    assert "ReadSchema: struct<total_amount:double,order_status:string>" in plan
    assert len(rows(report)) == 8


def test_reports_read_only_their_columns(registered):
    _, _, table = registered
    expected = {
        reports.category_share: "struct<total_amount:double,order_status:string>",
        reports.payment_mix: "struct<payment_method:string,order_status:string>",
        reports.cancel_rate: "struct<order_status:string>",
    }
    for report, schema in expected.items():
        assert f"ReadSchema: {schema}" in plan_of(report(table))


def test_top_reports_keep_only_the_top(registered):
    _, _, table = registered
    for report in (reports.top_products, reports.top_cities):
        assert "TakeOrderedAndProject" in plan_of(report(table))


def test_reports_group_before_they_shuffle(registered):
    _, _, table = registered
    for report in (
        reports.daily_revenue,
        reports.category_share,
        reports.top_products,
        reports.hourly_pattern,
        reports.cancel_rate,
        reports.top_cities,
        reports.payment_mix,
    ):
        plan = plan_of(report(table))
        assert "partial_" in plan and "Python" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize(
    ("name", "report"),
    [
        ("report_category_share", reports.category_share),
        ("report_top_products", reports.top_products),
        ("report_hourly", reports.hourly_pattern),
        ("report_cancel_rate", reports.cancel_rate),
        ("report_top_cities", reports.top_cities),
        ("report_payment_mix", reports.payment_mix),
        ("report_daily_revenue", lambda table: reports.daily_revenue(table, dt.date(2026, 1, 20))),
    ],
)
def test_reports_can_be_asked_in_sql(spark, registered, name, report):
    _, database, table = registered
    sql = oracle_queries.SQL[name].removeprefix(oracle_queries.PROCESSED)
    asked = spark.sql(sql.replace("orders_processed", f"{database}.orders_processed"))
    assert asked.columns == report(table).columns
    assert asked.collect() == report(table).collect()


def test_the_last_days_can_be_asked_in_sql(spark, registered):
    """By name, with the day of the question as a parameter."""
    _, database, table = registered
    today = dt.date(2026, 1, 20)
    asked = spark.sql(
        f"SELECT order_date, sum(total_amount) AS gross FROM {database}.orders_processed"
        " WHERE order_date BETWEEN date_sub(:today, 7) AND :today"
        " GROUP BY ALL ORDER BY ALL DESC",
        args={"today": today},
    )
    report = reports.daily_revenue(table, as_of=today)
    assert asked.collect() == report.select("order_date", "gross_revenue").collect()


def test_another_path_under_one_name_is_refused(spark, raw, registered):
    path, name, _ = registered
    write_processed(curate_orders(raw({"order_id": "x"}, {"order_id": "y"})), f"{path}-2", "0")
    with pytest.raises(ValueError, match="stands for"):
        register_processed(spark, f"{path}-2", name)
    assert register_processed(spark, path, name).count() == 20


def test_runs_are_added_alone_and_bring_their_columns(spark, raw, registered):
    path, name, _ = registered
    later = curate_orders(
        raw(
            {"order_id": "a", "category": "a=b/c d"},
            {"order_id": "b", "category": " "},
            {"order_id": "c", "order_timestamp": "nope"},
        )
    ).withColumn("coupon", F.lit("X"))
    write_processed(later, path, "1")
    write_processed(curate_orders(raw({"order_id": "not yet"})), path, "2")
    table = register_processed(spark, path, name, runs=["1", "1"])
    assert table.columns == [*PROCESSED.fieldNames(), "coupon"]
    assert rows(table.where("coupon = 'X'"), "order_id", "category") == [
        ("a", "A=B/C D"), ("b", None), ("c", "HOME"),
    ]
    assert table.count() == 23 and table.where("coupon IS NULL").count() == 20
    # A repair lists the whole zone.
    assert register_processed(spark, path, name).count() == 24


# The log of registered runs, and merged runs.


@pytest.fixture
def runs(spark, raw, folder):
    """Runs that share days and categories, registered one by one."""
    path, name = f"{folder}/processed", f"db_{abs(hash(folder))}"

    def add(run_id, *orders, register=True, **columns):
        frame = curate_orders(raw(*orders))
        for column, value in columns.items():
            frame = frame.withColumn(column, F.lit(value))
        write_processed(frame, path, run_id)
        if register:
            return register_processed(spark, path, name, database_path=f"{folder}/db", runs=[run_id])
        return None

    return path, name, add


def day(number, **fields):
    return {"order_timestamp": f"2026-01-{number:02d}T00:00:00+00:00", **fields}


def partitions(spark, name):
    files = spark.table(f"{name}.{catalog.files_table(spark, name)}")
    return rows(files.groupBy("order_date", "category").agg(F.count_distinct("run_id").alias("n")), "n")


def test_each_registered_run_has_a_row(spark, runs):
    path, name, add = runs
    add("0", day(1, order_id="a"), day(2, order_id="b", category=" "))
    add("1", day(1, order_id="c"), register=False)
    (row,) = catalog.registered_runs(spark, path, name).collect()
    assert row["run_id"] == "0" and len(row["partitions"]) == 2
    assert {(p["order_date"], p["category"]) for p in row["partitions"]} == {
        ("2026-01-01", "HOME"), ("2026-01-02", None),
    }
    assert catalog.unregistered_runs(spark, path, name) == ["1"]


def test_a_run_registered_by_half_is_registered_again(spark, runs, monkeypatch):
    path, name, add = runs
    add("0", day(1, order_id="a"))
    attach = catalog._attach

    def half(spark, files, run_id, found):
        attach(spark, files, run_id, found[:1])
        raise RuntimeError("ended")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="ended"):
        patch.setattr(catalog, "_attach", half)
        add("1", day(1, order_id="b"), day(2, order_id="c"), day(3, order_id="d"))
    assert spark.table(f"{name}.orders_processed").count() == 2
    assert catalog.unregistered_runs(spark, path, name) == ["1"]
    table = register_processed(spark, path, name, runs=["1"])
    assert table.count() == 4 and catalog.unregistered_runs(spark, path, name) == []


def test_nights_never_list_partitions():
    import inspect

    from orderflow.plans import nightly
    from orderflow.streaming import incremental

    for module in (catalog, nightly, incremental):
        source = inspect.getsource(module)
        assert "SHOW PARTITIONS" not in source and "recoverPartitions" not in source


def test_merged_runs_leave_one_partition_for_a_day_and_category(spark, runs):
    path, name, add = runs
    add("0", day(1, order_id="a"), day(1, order_id="b", category="007"), day(2, order_id="c", category=" "))
    add("1", day(1, order_id="d"), day(2, order_id="e", category=" "), day(3, order_id="f", category="a=b/c d"))
    table = add("2", day(1, order_id="g", order_timestamp="nope"), coupon="X")
    before = rows(table)
    old = spark.table(f"{name}.orders_processed")
    old_path = read_processed(spark, path)
    assert max(partitions(spark, name)) == (2,)

    merged = catalog.compact_runs(spark, path, name)
    assert partitions(spark, name) == [(1,)] * 5
    assert rows(merged) == before and merged.columns == table.columns
    # Who began to read before the merge reads on as it was; so do readers of the path.
    assert rows(old) == before
    assert rows(old_path) == rows(read_processed(spark, path)) == rows(merged.drop("coupon"))

    # More runs, another merge, and what was merged is merged again.
    add("3", day(1, order_id="h"), day(3, order_id="i", category="a=b/c d"))
    assert max(partitions(spark, name)) == (2,)
    again = catalog.compact_runs(spark, path, name)
    assert partitions(spark, name) == [(1,)] * 5 and again.count() == 9
    assert read_processed(spark, path).count() == 9
    assert catalog.unregistered_runs(spark, path, name) == []

    catalog.remove_replaced(spark, path, name)
    assert again.count() == read_processed(spark, path).count() == 9
    assert len(list(Path(path).rglob("order_date=2026-01-01/category=HOME"))) == 1
    # A table made anew finds the same.
    fresh = register_processed(spark, path, f"{name}_2", database_path=f"{path}-db2")
    assert rows(fresh) == rows(again)


def test_nothing_to_merge(spark, runs):
    path, name, add = runs
    table = add("0", day(1, order_id="a"), day(2, order_id="b"))
    assert rows(catalog.compact_runs(spark, path, name)) == rows(table)
    assert catalog.files_table(spark, name) == "orders_processed_files"


@pytest.mark.parametrize("step", ["put_once", "_move", "_show"])
def test_a_merge_that_ended_half_way(spark, runs, monkeypatch, step):
    path, name, add = runs
    add("0", day(1, order_id="a"))
    table = add("1", day(1, order_id="b"))
    before = rows(table)

    def broken(*args):
        raise RuntimeError("ended")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="ended"):
        patch.setattr(catalog, step, broken)
        catalog.compact_runs(spark, path, name)
    # Readers of either kind see all rows once.
    assert rows(spark.table(f"{name}.orders_processed")) == before
    assert rows(read_processed(spark, path)) == before
    assert rows(catalog.compact_runs(spark, path, name)) == before
    assert partitions(spark, name) == [(1,)]
    assert rows(read_processed(spark, path)) == before
    add("2", day(1, order_id="c"))
    assert rows(spark.table(f"{name}.orders_processed"), "order_id") == [("a",), ("b",), ("c",)]

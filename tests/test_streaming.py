from __future__ import annotations

import json
import os
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderflow import fixtures
from orderflow.operators import decode
from orderflow.operators.live import live_metrics
from orderflow.plans import reports
from orderflow.schema import REJECT
from orderflow.sources.catalog import register_processed
from orderflow.sources.raw_zone import read_raw
from orderflow.sources.stream import read_order_stream
from orderflow.streaming import sinks
from orderflow.streaming.incremental import run_incremental
from orderflow.streaming.metrics_log import (
    LOG_FILES,
    metrics_lookup,
    read_live_metrics,
    write_live_metrics,
)
from orderflow.streaming.pipeline import (
    BatchCounts,
    LivePaths,
    batch_counts,
    read_counts,
    start_fan_out,
    start_pipeline,
)
from orderflow.streaming.runs import finish
from tests.conftest import order, rows

TIMEOUT = 300


def stage(spark, folder, *orders):
    """Append one file of envelopes to the stream's folder."""
    path = f"{folder}/stream"
    text = [(str(n), json.dumps(one) if isinstance(one, dict) else one) for n, one in orders]
    (
        spark.createDataFrame(text, "sequence_number string, payload string")
        .select("sequence_number", F.base64(F.encode("payload", "UTF-8")).alias("data"))
        .coalesce(1)
        .write.mode("append")
        .json(path)
    )
    return path


def records_of(spark, path, threshold=None, max_files=1):
    stream = read_order_stream(spark, path, max_files)
    return decode.parse_orders(decode.open_envelopes(stream), threshold)


def test_metrics_over_batches_equal_the_batch_plan(spark, sf_dir, folder):
    orders = fixtures.live_orders(spark, sf_dir)
    staged = f"{folder}/stream"
    max_files = fixtures.stage(fixtures.order_envelopes(orders, "order_id"), staged)
    metrics = live_metrics(decode.countable(records_of(spark, staged, max_files=max_files)))
    query = finish(
        write_live_metrics(
            metrics, f"{folder}/out", f"{folder}/check", state_partitions=2, available_now=True
        ),
        TIMEOUT,
    )
    assert query.lastProgress["batchId"] >= 3
    assert rows(read_live_metrics(spark, f"{folder}/out")) == rows(live_metrics(orders))


def test_metrics_survive_a_crash_after_the_write(spark, folder):
    """The sink wrote, the commit is lost: the batch runs again and counts once."""
    path = stage(spark, folder, (1, order()))
    out, check = f"{folder}/out", f"{folder}/check"

    def run():
        metrics = live_metrics(decode.countable(records_of(spark, path)))
        finish(
            write_live_metrics(metrics, out, check, state_partitions=2, available_now=True),
            TIMEOUT,
        )

    run()
    for commit in Path(check, "commits").glob("*0*"):
        commit.unlink()
    run()
    expected = ("CATEGORY#Home", "DATE#2026-01-02", 1, Decimal("20.50"))
    assert rows(read_live_metrics(spark, out)) == [expected]

    stage(spark, folder, (2, order(order_timestamp="1999-01-02T00:00:00+00:00")), (3, order()))
    run()
    run()
    assert rows(read_live_metrics(spark, out)) == [
        ("CATEGORY#Home", "DATE#1999-01-02", 1, Decimal("20.50")),
        ("CATEGORY#Home", "DATE#2026-01-02", 2, Decimal("41.00")),
    ]
    lookup = metrics_lookup(spark, out, "Home", "2026-01-01", "2026-01-31")
    assert rows(lookup, "order_count") == [(2,)]


def test_raw_zone_keeps_every_object_as_it_came(spark, folder):
    extra = '{"order_id": "a",\n "coupon": {"x": 10.50}, "category": null}'
    path = stage(spark, folder, (1, extra), (2, "[1]"), (3, "{bad"), (4, order()))
    out = f"{folder}/orders"
    records = decode.parsed(records_of(spark, path))
    for _ in range(2):
        query = sinks.write_raw_zone(records, out, f"{folder}/check", available_now=True)
        finish(query, TIMEOUT)
    lines = rows(spark.read.text(out), "value")
    assert lines == [
        ('{"order_id": "a",  "coupon": {"x": 10.50}, "category": null}',),
        (json.dumps(order()),),
    ]
    assert len(list(Path(out).glob("year=*/month=*/day=*/batch=*/*.txt"))) == 1
    (day,) = {tuple(row) for row in read_raw(spark, out).select("year", "month", "day").collect()}
    (now,) = spark.sql("SELECT year(current_date()), month(current_date())").collect()
    assert day[:2] == tuple(now)


@pytest.fixture
def mixed(spark, folder):
    return stage(
        spark,
        folder,
        (1, order(total_amount=300)),
        (2, order(total_amount=300, order_status="CANCELLED")),
        (3, order(total_amount=300, shipping_city=None)),
        (4, order(category=None)),
        (5, "{bad"),
        (6, "[1]"),
        (7, order()),
    )


def pipeline(spark, mixed, folder, alerts, begin=start_pipeline, max_files=None):
    paths = LivePaths(
        raw=f"{folder}/raw",
        rejects=f"{folder}/rejects",
        metrics=f"{folder}/metrics",
        checkpoints=f"{folder}/checks",
        alerts=alerts,
        counts=f"{folder}/counts",
    )
    opened = decode.open_envelopes(read_order_stream(spark, mixed, max_files))
    queries = begin(opened, paths, state_partitions=2, available_now=True)
    for query in queries:
        finish(query, TIMEOUT)
    return queries


def rejects_of(spark, folder):
    return rows(spark.read.schema(REJECT).parquet(f"{folder}/rejects"), "record_id", "reason")


@pytest.mark.parametrize(("begin", "count"), [(start_pipeline, 4), (start_fan_out, 2)])
def test_pipeline_fills_every_sink(spark, mixed, folder, begin, count):
    queries = pipeline(spark, mixed, folder, f"{folder}/alerts", begin=begin)
    assert len(queries) == count
    assert batch_counts(queries[0]) == [BatchCounts(0, 7, 4)]
    assert read_raw(spark, f"{folder}/raw").count() == 5
    assert rejects_of(spark, folder) == [
        ("3", "missing_shipping_city"),
        ("4", "missing_category"),
        ("5", "bad_json"),
        ("6", "not_an_object"),
    ]
    assert rows(read_live_metrics(spark, f"{folder}/metrics"), "order_count", "revenue") == [
        (3, Decimal("620.50"))
    ]
    assert sinks.read_alerts(spark, f"{folder}/alerts").count() == 1
    if begin is start_fan_out:
        assert rows(read_counts(spark, f"{folder}/counts")) == [(0, 7, 4)]


@pytest.mark.parametrize(("begin", "count"), [(start_pipeline, 3), (start_fan_out, 2)])
def test_pipeline_without_alerts(spark, mixed, folder, begin, count):
    """Alerts that are off also ask nothing of an order."""
    queries = pipeline(spark, mixed, folder, "", begin=begin)
    assert len(queries) == count
    assert [reason for _, reason in rejects_of(spark, folder)] == [
        "missing_category",
        "bad_json",
        "not_an_object",
    ]


@pytest.mark.parametrize("begin", [start_pipeline, start_fan_out])
def test_batches_tried_again_replace_what_they_wrote(spark, mixed, folder, begin):
    """The sinks wrote, the commits are lost: a second try leaves no copies."""
    for _ in range(2):
        pipeline(spark, mixed, folder, f"{folder}/alerts", begin=begin)
        for commit in Path(folder, "checks").glob("*/commits/*0*"):
            commit.unlink()
    assert read_raw(spark, f"{folder}/raw").count() == 5
    assert len(rejects_of(spark, folder)) == 4
    assert sinks.read_alerts(spark, f"{folder}/alerts").count() == 1
    (totals,) = rows(read_live_metrics(spark, f"{folder}/metrics"), "order_count")
    assert totals == (3,)


def deliver_all(spark, folder, deliver):
    query = sinks.start_delivery(
        spark, f"{folder}/alerts", f"{folder}/sent", deliver, f"{folder}/failed", available_now=True
    )
    finish(query, TIMEOUT)


def test_alerts_are_delivered_once_and_failures_kept(spark, mixed, folder):
    pipeline(spark, mixed, folder, f"{folder}/alerts", begin=start_fan_out)
    seen = []

    def deliver(batch, batch_id):
        seen.append(batch.count())
        if len(seen) > 1:
            raise ConnectionError("receiver is down")

    deliver_all(spark, folder, deliver)
    deliver_all(spark, folder, deliver)
    assert seen == [1]
    stage(spark, folder, (8, order(order_id="o8", total_amount=900)))
    pipeline(spark, mixed, folder, f"{folder}/alerts", begin=start_fan_out)
    deliver_all(spark, folder, deliver)
    # The failure concerns its own alert only; landing went on.
    assert rows(sinks.read_failed(spark, f"{folder}/failed")) == [("o8", "receiver is down")]
    assert read_raw(spark, f"{folder}/raw").count() == 6


def test_single_alerts_can_fail(spark, mixed, folder):
    stage(spark, folder, (8, order(order_id="o8", total_amount=900)))
    pipeline(spark, mixed, folder, f"{folder}/alerts", begin=start_fan_out)
    deliver_all(
        spark,
        folder,
        lambda batch, batch_id: batch.where("order_id = 'o8'").select(
            "order_id", F.lit("refused").alias("reason")
        ),
    )
    assert rows(sinks.read_failed(spark, f"{folder}/failed")) == [("o8", "refused")]


def test_files_of_any_age_are_read(spark, folder):
    """In the stream and in the raw zone, whatever was read before."""
    records = [fixtures_row(spark, n) for n in (1, 2)]
    landed = []
    for days_ago, record in zip((0, 400), records, strict=True):
        fixtures.stage(record, f"{folder}/staged-{days_ago}")
        fixtures.move_files(spark, f"{folder}/staged-{days_ago}", f"{folder}/stream", days_ago)
        pipeline(spark, f"{folder}/stream", folder, "", begin=start_fan_out)
        landed.append(read_raw(spark, f"{folder}/raw").count())
    assert landed == [1, 2]
    # The same for curation: the second file is a year older than the first.
    one, two = sorted(Path(folder, "raw").rglob("*.txt"))
    held = two.read_text()
    two.unlink()
    (first,) = run_incremental(spark, f"{folder}/raw", f"{folder}/out", f"{folder}/c", TIMEOUT)
    late = one.with_name("late.txt")
    late.write_text(held)
    year_ago = one.stat().st_mtime - 400 * 86_400
    os.utime(late, (year_ago, year_ago))
    (second,) = run_incremental(spark, f"{folder}/raw", f"{folder}/out", f"{folder}/c", TIMEOUT)
    assert (first.raw_rows, second.raw_rows) == (1, 1)


def fixtures_row(spark, number):
    text = json.dumps(order(order_id=f"o{number}"))
    frame = spark.createDataFrame([(str(number), text)], "sequence_number string, payload string")
    return frame.select("sequence_number", F.base64(F.encode("payload", "UTF-8")).alias("data"))


def test_a_batch_leaves_few_files(spark, folder):
    """However many tasks hold the state or the rows."""
    envelopes = [(n, order(order_id=f"o{n}", category=f"c{n % 40}")) for n in range(200)]
    path = stage(spark, folder, *envelopes)
    records = records_of(spark, path).repartition(50)
    finish(
        write_live_metrics(
            live_metrics(decode.countable(records)),
            f"{folder}/out",
            f"{folder}/check",
            state_partitions=50,
            available_now=True,
        ),
        TIMEOUT,
    )
    assert len(list(Path(folder, "out").rglob("*.parquet"))) <= LOG_FILES
    raw = sinks.write_raw_zone(decode.parsed(records), f"{folder}/raw", f"{folder}/c", True)
    finish(raw, TIMEOUT)
    assert len(list(Path(folder, "raw").rglob("*.txt"))) == 1
    assert not list(Path(folder, "raw").rglob("_spark_metadata"))


def test_metrics_log_is_compacted(spark, folder):
    """Old folders go, one snapshot back; the totals stay."""
    out = f"{folder}/out"
    for number in range(6):
        path = stage(spark, folder, (number, order(category="ab"[number % 2])))
    metrics = live_metrics(decode.countable(records_of(spark, path)))
    query = write_live_metrics(
        metrics, out, f"{folder}/check", state_partitions=2, snapshot_every=2, available_now=True
    )
    finish(query, TIMEOUT)
    assert sorted(p.name for p in Path(out, "kind=changes").iterdir()) == [
        f"batch_id={n}" for n in (2, 3, 4, 5)
    ]
    assert sorted(p.name for p in Path(out, "kind=snapshot").iterdir()) == [
        f"batch_id={n}" for n in (2, 4)
    ]
    assert rows(read_live_metrics(spark, out), "pk", "order_count") == [
        ("CATEGORY#a", 3),
        ("CATEGORY#b", 3),
    ]


def test_batch_without_alerts(spark, mixed, folder):
    """It leaves no folder, and alerts of other batches stay."""
    stage(spark, folder, (8, order()), (9, "{bad"))
    pipeline(spark, mixed, folder, f"{folder}/alerts", begin=start_fan_out, max_files=1)
    assert len(list(Path(folder, "alerts").glob("batch=*"))) == 1
    assert rows(read_counts(spark, f"{folder}/counts"), "records", "failures") in (
        [(2, 1), (7, 4)],
        [(7, 4), (2, 1)],
    )


@pytest.mark.parametrize("name", ["raw", "rejects", "metrics"])
def test_new_checkpoint_on_old_output_is_refused(spark, mixed, folder, name):
    records = records_of(spark, mixed)
    begin = {
        "raw": lambda check: sinks.write_raw_zone(
            decode.parsed(records), f"{folder}/out", check, available_now=True
        ),
        "rejects": lambda check: sinks.write_rejects(
            decode.rejected(records), f"{folder}/out", check, available_now=True
        ),
        "metrics": lambda check: write_live_metrics(
            live_metrics(decode.countable(records)),
            f"{folder}/out",
            check,
            state_partitions=2,
            available_now=True,
        ),
    }[name]
    finish(begin(f"{folder}/check"), TIMEOUT)
    finish(begin(f"{folder}/check"), TIMEOUT)
    with pytest.raises(ValueError, match="another checkpoint"):
        begin(f"{folder}/check-2")


def test_stream_that_overruns_is_stopped(spark, mixed, folder):
    records = records_of(spark, mixed)
    query = sinks.write_rejects(decode.rejected(records), f"{folder}/rejects", f"{folder}/check")
    with pytest.raises(TimeoutError):
        finish(query, timeout=1)
    assert not query.isActive


@pytest.mark.parametrize("begin", [start_pipeline, start_fan_out])
def test_stream_to_report(spark, mixed, folder, begin):
    """What the pipeline lands is what the nightly run curates and the reports count."""
    pipeline(spark, mixed, folder, "", begin=begin)
    out, check = f"{folder}/processed", f"{folder}/curate"
    (first,) = run_incremental(spark, f"{folder}/raw", out, check, TIMEOUT)
    assert (first.raw_rows, first.written_rows) == (5, 1)
    stage(spark, folder, (8, order(order_id="o2", category="Books", order_status=None)))
    pipeline(spark, mixed, folder, "", begin=begin)
    (second,) = run_incremental(spark, f"{folder}/raw", out, check, TIMEOUT)
    assert (second.raw_rows, second.written_rows) == (1, 1)
    assert run_incremental(spark, f"{folder}/raw", out, check, TIMEOUT) == []
    name = f"db_{abs(hash(folder))}"
    orders = register_processed(spark, out, name, database_path=f"{folder}/db")
    assert rows(reports.cancel_rate(orders), "category", "total")[0] == ("BOOKS", 1)

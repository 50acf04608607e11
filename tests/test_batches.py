"""Hand-over by batch: each is taken once, whole, whatever was tried before."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderflow import fixtures
from orderflow.operators import decode
from orderflow.sources import batches
from orderflow.sources.processed import read_processed
from orderflow.sources.raw_zone import read_raw
from orderflow.sources.records import folder_names, put_once, read_text
from orderflow.sources.stream import read_order_stream
from orderflow.streaming import incremental, sinks
from orderflow.streaming.incremental import read_runs, run_incremental, taken
from orderflow.streaming.pipeline import LivePaths, start_fan_out, start_pipeline
from orderflow.streaming.runs import finish
from tests.conftest import order, rows

TIMEOUT = 300


@pytest.fixture
def zone(spark, raw, folder):
    """Save a batch of orders by their ids, and run curation."""

    class Zone:
        path, out, check = f"{folder}/raw", f"{folder}/processed", f"{folder}/check"

        def save(self, name, *ids, day="02"):
            frame = raw(*[{"order_id": i} for i in ids])
            days = {"year": F.lit("2026"), "month": F.lit("01"), "day": F.lit(day)}
            fixtures.land_batch(frame.withColumns(days), self.path, name)

        def forget(self, name):
            """As if the sink had ended before it could say that the batch is complete."""
            Path(batches.log_path(self.path), name).unlink()

        def run(self):
            return run_incremental(spark, self.path, self.out, self.check, TIMEOUT)

        def ids(self):
            return [i for (i,) in rows(read_processed(spark, self.out), "order_id")]

    return Zone()


def test_a_batch_saved_twice_is_curated_once(zone):
    zone.save("one", "a", "b")
    zone.save("one", "a", "b")
    (first,) = zone.run()
    assert (first.raw_rows, first.written_rows) == (2, 2)
    zone.save("one", "a", "b")
    assert zone.run() == []
    zone.save("two", "c")
    assert len(zone.run()) == 1 and zone.ids() == ["a", "b", "c"]


def test_a_complete_batch_keeps_its_files(zone):
    zone.save("one", "a")
    before = sorted(Path(zone.path).rglob("part-*"))
    zone.save("one", "other rows")
    assert sorted(Path(zone.path).rglob("part-*")) == before


def test_a_batch_is_read_only_once_it_is_complete(spark, zone):
    zone.save("one", "a")
    zone.save("two", "b")
    zone.forget("two")
    (first,) = zone.run()
    assert first.raw_rows == 1 and zone.run() == []
    # Tried again, with new file names, it replaces what was left half written.
    zone.save("two", "b")
    (second,) = zone.run()
    assert second.raw_rows == 1 and zone.ids() == ["a", "b"]
    # Even if its completion is lost once more, curation knows it by name.
    zone.forget("two")
    zone.save("two", "b")
    assert zone.run() == [] and read_raw(spark, zone.path).count() == 2


def test_files_from_elsewhere_are_taken_by_their_place(spark, zone):
    zone.save("one", "a")
    zone.run()
    day = Path(zone.path, "year=2026/month=01/day=02")
    (day / "late.json").write_text(json.dumps(order(order_id="b")))
    (day / "batch=one/more.json").write_text(json.dumps(order(order_id="c")))
    (run,) = zone.run()
    assert run.raw_rows == 2 and zone.run() == [] and zone.ids() == ["a", "b", "c"]
    assert len({r["name"] for r in taken(spark, zone.check).collect()}) == 3


def test_a_zone_without_a_log_can_be_adopted(spark, zone):
    zone.save("one", "a")
    zone.save("two", "b")
    for name in ("one", "two"):
        zone.forget(name)
    assert zone.run() == []
    batches.adopt_batches(spark, zone.path)
    assert len(zone.run()) == 1 and zone.ids() == ["a", "b"]


@pytest.mark.parametrize("step", ["write_processed", "put_once"])
def test_a_run_that_failed_is_tried_again_as_planned(spark, zone, monkeypatch, step):
    zone.save("one", "a")
    kept = getattr(incremental, step)

    def broken(*args):
        if step == "put_once" and "/commits/" not in args[1]:
            return kept(*args)
        if step == "write_processed":
            kept(*args)
        raise OSError("gone")

    with monkeypatch.context() as patch, pytest.raises(OSError, match="gone"):
        patch.setattr(incremental, step, broken)
        zone.run()
    assert taken(spark, zone.check).isEmpty()
    zone.save("two", "b")
    first, second = zone.run()
    assert [r.raw_rows for r in (first, second)] == [1, 1] and zone.ids() == ["a", "b"]
    assert rows(read_runs(spark, zone.check)) == sorted(
        (r.run_id, r.raw_rows, r.written_rows) for r in (first, second)
    )


def test_a_half_written_plan_is_made_anew(zone):
    zone.save("one", "a")
    zone.run()
    zone.save("two", "b")
    Path(zone.check, "plans/00000001").mkdir()
    assert len(zone.run()) == 1 and zone.ids() == ["a", "b"]


def test_runs_are_known_before_the_first(spark, folder):
    assert read_runs(spark, f"{folder}/check").count() == 0


def test_a_checkpoint_of_a_stream_is_refused(zone, folder):
    zone.save("one", "a")
    Path(zone.check, "offsets").mkdir(parents=True)
    with pytest.raises(ValueError, match="made by a stream"):
        zone.run()


def test_a_run_over_its_time_is_cancelled(spark, zone):
    zone.save("one", *[f"o{k}" for k in range(2000)])
    with pytest.raises(TimeoutError):
        run_incremental(spark, zone.path, zone.out, zone.check, timeout=0.05)
    assert [r.written_rows for r in zone.run()] == [2000]


def test_records_are_written_once(spark, folder):
    assert put_once(spark, f"{folder}/log/a", "one")
    assert not put_once(spark, f"{folder}/log/a", "two")
    assert read_text(spark, f"{folder}/log/a") == "one"
    assert folder_names(spark, f"{folder}/log") == ["a"] and folder_names(spark, f"{folder}/no") == []


# Streams that share folders.


@pytest.fixture
def live(spark, folder):
    envelope = spark.createDataFrame([("1", json.dumps(order(total_amount=900)))], "n string, text string")
    data = F.base64(F.encode("text", "UTF-8")).alias("data")
    envelope.select(F.col("n").alias("sequence_number"), data).write.json(f"{folder}/stream")

    def begin(checks="checks", how=start_fan_out):
        paths = LivePaths(
            **{n: f"{folder}/{n}" for n in ("raw", "rejects", "metrics", "alerts", "counts")},
            checkpoints=f"{folder}/{checks}",
        )
        opened = decode.open_envelopes(read_order_stream(spark, f"{folder}/stream"))
        return how(opened, paths, state_partitions=2, available_now=True)

    return begin


@pytest.mark.parametrize("how", [start_fan_out, start_pipeline])
def test_a_foreign_checkpoint_starts_nothing(spark, folder, live, how):
    for query in live(how=how):
        finish(query, TIMEOUT)
    landed = read_raw(spark, f"{folder}/raw").count()
    with pytest.raises(ValueError, match="another checkpoint"):
        live("checks-2", how)
    assert spark.streams.active == [] and landed == 1
    assert read_raw(spark, f"{folder}/raw").count() == 1
    # Any one of the outputs is reason enough.
    with pytest.raises(ValueError, match="another checkpoint"):
        sinks.write_alerts(
            sinks.read_alerts(spark, f"{folder}/alerts"), f"{folder}/alerts", f"{folder}/checks-3"
        )


def test_what_was_started_is_stopped_if_the_rest_cannot(spark, folder, live, monkeypatch):
    from orderflow.streaming import pipeline

    def broken(*args):
        raise RuntimeError("no state store")

    monkeypatch.setattr(pipeline, "_start_metrics", broken)
    with pytest.raises(RuntimeError, match="no state store"):
        live()
    assert spark.streams.active == []


def test_delivery_may_start_before_the_first_alert(spark, folder, live):
    seen = []

    def deliver():
        query = sinks.start_delivery(
            spark,
            f"{folder}/alerts",
            f"{folder}/sent",
            lambda batch, n: seen.append(batch.count()),
            f"{folder}/failed",
            available_now=True,
        )
        finish(query, TIMEOUT)

    deliver()
    assert seen == []
    for query in live():
        finish(query, TIMEOUT)
    deliver()
    # The batch is saved once more, with new files, as if its completion was lost.
    (name,) = folder_names(spark, f"{folder}/alerts/_batches")
    Path(folder, "alerts/_batches", name).unlink()
    alerts = sinks.read_alerts(spark, f"{folder}/alerts")
    again = spark.createDataFrame(alerts.collect(), alerts.schema)
    sinks.save_batch(again, "parquet", f"{folder}/alerts", name)
    deliver()
    assert seen == [1]

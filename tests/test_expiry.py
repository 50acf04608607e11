from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderflow import fixtures
from orderflow.sources import batches
from orderflow.sources.processed import read_processed
from orderflow.sources.raw_zone import read_raw
from orderflow.sources.records import folder_names
from orderflow.streaming.expiry import expire_raw, expiry
from orderflow.streaming.incremental import run_incremental
from tests.conftest import rows

TODAY = dt.date(2026, 2, 10)


@pytest.fixture
def zone(spark, raw, folder):
    class Zone:
        path, out, check = f"{folder}/raw", f"{folder}/processed", f"{folder}/check"

        def save(self, name, *days):
            orders = raw(*[{"order_id": f"{name}-{d}"} for d in days])
            part = {"year": F.lit("2026"), "month": F.lit("01"), "day": F.substring_index("order_id", "-", -1)}
            fixtures.land_batch(orders.withColumns(part), self.path, name)

        def run(self):
            return run_incremental(spark, self.path, self.out, self.check, 300)

        def expire(self, days=30):
            found = expire_raw(spark, self.path, self.check, TODAY, days).collect()
            return sorted(tuple(row) for row in found)

        def days(self):
            return [d for (d,) in rows(read_raw(spark, self.path).select("day").distinct())]

    return Zone()


def day(number):
    return dt.date(2026, 1, number)


def test_curated_days_past_their_retention_go(spark, zone):
    zone.save("one", "05", "10", "11", "12")
    zone.run()
    assert zone.expire() == [(day(5), 1, "deleted", None), (day(10), 1, "deleted", None)]
    assert zone.days() == [11, 12] and zone.expire() == []
    # The batch has files left, so it stays in the log; nothing is curated again.
    assert folder_names(spark, batches.log_path(zone.path)) == ["one"]
    assert zone.run() == [] and read_processed(spark, zone.out).count() == 4


def test_a_day_that_is_not_curated_stays(spark, zone):
    zone.save("one", "05")
    zone.run()
    zone.save("two", "05", "06")
    assert zone.expire() == [(day(5), 2, "kept", "not curated"), (day(6), 1, "kept", "not curated")]
    assert read_raw(spark, zone.path).count() == 3
    zone.run()
    assert [row[2] for row in zone.expire()] == ["deleted"] * 2
    assert folder_names(spark, batches.log_path(zone.path)) == []
    assert zone.run() == [] and read_processed(spark, zone.out).count() == 3


def test_a_batch_that_is_not_complete_stays(zone):
    zone.save("one", "05")
    zone.save("two", "06")
    Path(batches.log_path(zone.path), "two").unlink()
    zone.run()
    assert zone.expire() == [(day(5), 1, "deleted", None), (day(6), 1, "kept", "not complete")]


def test_a_run_that_did_not_commit_has_curated_nothing(zone):
    zone.save("one", "05")
    zone.run()
    for commit in Path(zone.check, "commits").glob("0*"):
        commit.unlink()
    assert zone.expire() == [(day(5), 1, "kept", "not curated")]


def test_files_from_elsewhere_are_asked_for_too(spark, raw, zone):
    zone.save("one", "05")
    zone.run()
    part = {"year": F.lit("2026"), "month": F.lit("01"), "day": F.lit("05")}
    fixtures.land(raw({"order_id": "x"}).withColumns(part), zone.path)
    assert zone.expire() == [(day(5), 2, "kept", "not curated")]
    zone.run()
    assert zone.expire() == [(day(5), 2, "deleted", None)]


def test_days_within_retention_are_not_looked_at(spark, zone):
    zone.save("one", "31")
    assert zone.expire() == [] and expiry(spark, zone.path, zone.check, TODAY, 5).count() == 1
    assert zone.days() == [31]


def test_no_zone(zone):
    assert zone.expire() == []

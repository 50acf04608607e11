from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderflow import fixtures
from orderflow.operators.alerts import alert_message, high_value_alerts
from orderflow.operators.live import latest_metrics, live_metrics, select_metrics
from orderflow.schema import METRICS
from orderflow.session import conf_scope
from orderflow.streaming import metrics_log
from tests.conftest import rows


def test_status_rules(raw):
    """Only the exact text CANCELLED is left out; the category is taken as it is."""
    orders = raw(
        {},
        {"order_status": "cancelled"},
        {"order_status": "PENDING"},
        {"order_status": None},
        {"order_status": "CANCELLED"},
        {"category": " home"},
    )
    assert rows(live_metrics(orders)) == [
        ("CATEGORY# home", "DATE#2026-01-02", 1, Decimal("20.50")),
        ("CATEGORY#Home", "DATE#2026-01-02", 4, Decimal("82.00")),
    ]


def test_day_is_the_text_of_the_event(raw):
    orders = raw({"order_timestamp": "2026-01-02T23:30:15-05:00"})
    assert rows(live_metrics(orders), "sk") == [("DATE#2026-01-02",)]


def test_revenue_is_exact(raw):
    orders = raw(*[{"total_amount": "0.10"}] * 30)
    assert rows(live_metrics(orders), "revenue") == [(Decimal("3.00"),)]


def test_hot_category_is_summed_before_the_shuffle(spark, sf_dir):
    metrics = live_metrics(fixtures.live_orders(spark, sf_dir))
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan.split("Exchange hashpartitioning", 1)[1]
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string" in plan


def test_latest_and_lookup(spark):
    changes = spark.createDataFrame(
        [
            ("CATEGORY#a", "DATE#2026-01-01", 1, Decimal("5.00"), 0),
            ("CATEGORY#a", "DATE#2026-01-01", 2, Decimal("3.00"), 10),
            ("CATEGORY#a", "DATE#2026-01-01", 2, Decimal("4.00"), 9),
            ("CATEGORY#a", "DATE#2026-01-02", 1, Decimal("1.00"), 1),
            ("CATEGORY#b", "DATE#2026-01-01", 1, Decimal("1.00"), 1),
        ],
        "pk string, sk string, order_count bigint, revenue decimal(28,2), batch_id bigint",
    )
    latest = latest_metrics(changes)
    assert rows(latest, "pk", "sk", "revenue") == [
        ("CATEGORY#a", "DATE#2026-01-01", Decimal("3.00")),
        ("CATEGORY#a", "DATE#2026-01-02", Decimal("1.00")),
        ("CATEGORY#b", "DATE#2026-01-01", Decimal("1.00")),
    ]
    assert select_metrics(latest, "a").count() == 2
    assert select_metrics(latest, "a", "2026-01-01", "2026-01-01").count() == 1
    assert select_metrics(latest, "a", day_from="2026-01-02").count() == 1
    assert select_metrics(latest, "c").count() == 0


@pytest.mark.parametrize(
    ("changes", "alerts"),
    [
        ({"total_amount": "250.00"}, 0),
        ({"total_amount": "250.01"}, 1),
        ({"total_amount": "250.01", "order_status": "CANCELLED"}, 0),
        ({"total_amount": "250.01", "order_status": None}, 1),
        ({"total_amount": "abc"}, 0),
    ],
)
def test_threshold(raw, changes, alerts):
    assert high_value_alerts(raw(changes)).count() == alerts


def test_threshold_is_a_parameter(raw):
    assert high_value_alerts(raw({}), threshold=20.49).count() == 1
    assert high_value_alerts(raw({}), threshold=20.5).count() == 0


def test_message(raw):
    (row,) = alert_message(raw({"total_amount": "1.2345678905E7", "currency": None})).collect()
    assert row.subject == "High-value order alert"
    assert row.message.split("\n") == [
        "High-value order detected",
        "Order ID: o1",
        "Customer: C1000",
        "Product:  Lamp (Home)",
        "Amount:   $12345678.91 USD",
        "City:     Boston, MA",
        "Time:     2026-01-02T03:04:05.678901+00:00",
    ]


# Lookups in an ordered snapshot.


def _log_of(spark, folder, categories=40, days=30):
    """A log whose snapshot has one file for each of 8 ranges of keys, and changes after it."""
    rows = [
        (f"CATEGORY#c{c:02d}", f"DATE#2026-01-{d:02d}", c * d, Decimal(c))
        for c in range(categories)
        for d in range(1, days + 1)
    ]
    frame = spark.createDataFrame(rows, METRICS)
    with conf_scope(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        metrics_log._write_snapshot(frame, metrics_log._folder(folder, "snapshot", 5))
    newer = frame.where("pk = 'CATEGORY#c07' AND sk = 'DATE#2026-01-09'")
    metrics_log._write(newer.withColumn("order_count", F.lit(999).cast("bigint")), metrics_log._folder(folder, "changes", 6))
    return {(pk, sk): n for pk, sk, n, _ in rows} | {("CATEGORY#c07", "DATE#2026-01-09"): 999}


@pytest.mark.parametrize(
    ("category", "low", "high"),
    [("c07", None, None), ("c07", "2026-01-05", "2026-01-09"), ("c00", "2026-01-30", None),
     ("c39", None, "2026-01-01"), ("nope", None, None), ("c20", "2026-02-01", None)],
)
def test_lookups_agree_with_all_totals(spark, folder, category, low, high):
    wanted = {
        (pk, sk, n)
        for (pk, sk), n in _log_of(spark, folder).items()
        if pk == f"CATEGORY#{category}"
        and (low is None or sk >= f"DATE#{low}")
        and (high is None or sk <= f"DATE#{high}")
    }
    found = metrics_log.metrics_lookup(spark, folder, category, low, high)
    assert {tuple(r) for r in found.select("pk", "sk", "order_count").collect()} == wanted


def test_a_lookup_opens_few_files_of_a_snapshot(spark, folder):
    _log_of(spark, folder)
    snapshot = metrics_log._folder(folder, "snapshot", 5)
    assert len(list(Path(snapshot).glob("part-*"))) == 8
    found = metrics_log.metrics_lookup(spark, folder, "c07", "2026-01-05", "2026-01-09")
    opened = [f for f in found.inputFiles() if "kind=snapshot" in f]
    assert len(opened) == 1
    assert "PushedFilters: [IsNotNull(pk), IsNotNull(sk), EqualTo(pk,CATEGORY#c07)" in (
        found._jdf.queryExecution().executedPlan().toString()
    )
    # Rows of a file are in order, so its pages prune, too.
    keys = [tuple(r) for r in spark.read.parquet(opened[0]).select("pk", "sk").collect()]
    assert keys == sorted(keys)
    # A snapshot without notes of its files is read whole.
    for note in Path(snapshot, "_bounds").iterdir():
        note.unlink()
    whole = metrics_log.metrics_lookup(spark, folder, "c07", "2026-01-05", "2026-01-09")
    assert len([f for f in whole.inputFiles() if "kind=snapshot" in f]) == 8
    assert sorted(whole.collect()) == sorted(found.collect())

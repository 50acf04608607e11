from __future__ import annotations

import datetime as dt

import pytest

from orderflow.operators.clean import clean_orders
from orderflow.operators.dedup import dedup_orders
from orderflow.plans import reports


@pytest.fixture
def orders(raw):
    def make(*changes):
        named = [{"order_id": f"o{n}", **change} for n, change in enumerate(changes)]
        return clean_orders(raw(*named))

    return make


def found(frame):
    """Reports are ordered, so their order is part of the result."""
    return [tuple(row) for row in frame.collect()]


def test_daily_revenue_takes_eight_days_and_the_future(orders):
    days = [
        {"order_timestamp": f"2026-01-{day:02d}T00:00:00+00:00"} for day in (1, 2, 3, 9, 10, 10)
    ]
    report = reports.daily_revenue(orders(*days), as_of=dt.date(2026, 1, 9))
    assert found(report) == [
        (dt.date(2026, 1, 10), 2, 41.0, 20.5),
        (dt.date(2026, 1, 9), 1, 20.5, 20.5),
        (dt.date(2026, 1, 3), 1, 20.5, 20.5),
        (dt.date(2026, 1, 2), 1, 20.5, 20.5),
    ]


def test_daily_revenue_defaults_to_today(orders):
    now = dt.datetime.now(dt.UTC)
    times = [(now - dt.timedelta(days=days)).isoformat() for days in (0, 6, 9)]
    report = reports.daily_revenue(orders(*[{"order_timestamp": text} for text in times]))
    assert len(found(report)) == 2


def test_only_placed_orders_count(orders):
    some = orders(
        {}, {"order_status": " placed "}, {"order_status": None}, {"order_status": "PENDING"}
    )
    assert found(reports.category_share(some)) == [("HOME", 2, 41.0, 100.0)]
    assert found(reports.payment_mix(some)) == [("PAYPAL", 2, 100.0)]
    assert found(reports.hourly_pattern(some)) == [(3, 2, 20.5)]


def test_category_share(orders):
    some = orders(
        {"category": "b", "total_amount": "1"},
        {"category": "a", "total_amount": "1"},
        {"category": "c", "total_amount": "4"},
    )
    assert found(reports.category_share(some)) == [
        ("C", 1, 4.0, 66.67),
        ("A", 1, 1.0, 16.67),
        ("B", 1, 1.0, 16.67),
    ]


def test_cancel_rate_counts_every_status(orders):
    some = orders({"order_status": "cancelled"}, {}, {"order_status": None}, {"category": "z"})
    assert found(reports.cancel_rate(some)) == [("HOME", 3, 1, 33.33), ("Z", 1, 0, 0.0)]


def test_amounts_that_are_missing(orders):
    """An average without amounts is null; a share of nothing is null."""
    some = orders({"total_amount": "x"}, {"total_amount": None})
    assert found(reports.hourly_pattern(some)) == [(3, 2, None)]
    assert found(reports.category_share(some)) == [("HOME", 2, None, None)]
    zero = orders({"total_amount": "0"})
    assert found(reports.category_share(zero)) == [("HOME", 1, 0.0, None)]


def test_top_products(orders):
    changes = [
        {"product_id": f"P{n:02d}", "total_amount": str(n % 6), "quantity": "3"}
        for n in range(12)
    ]
    report = found(reports.top_products(orders(*changes)))
    assert len(report) == 10
    assert report[:3] == [
        ("P05", "Lamp", 3, 5.0),
        ("P11", "Lamp", 3, 5.0),
        ("P04", "Lamp", 3, 4.0),
    ]
    assert len(found(reports.top_products(orders(*changes), n=2))) == 2


def test_top_cities(orders):
    changes = [{"shipping_city": f"c{n:02d}", "total_amount": str(n)} for n in range(20)]
    report = found(reports.top_cities(orders(*changes)))
    assert len(report) == 15
    assert report[0] == ("MA", "c19", 1, 19.0)


def test_sums_ignore_input_order(orders):
    amounts = [{"total_amount": text} for text in ("1e15", "0.01", "-1e15", "0.02") * 5]
    one = found(reports.top_cities(orders(*amounts).repartition(5)))
    other = found(reports.top_cities(orders(*reversed(amounts)).repartition(3)))
    assert one == other == [("MA", "Boston", 20, 0.15)]


def test_reports_after_dedup(orders):
    twice = orders({"order_id": "x"}, {"order_id": "x"}, {"order_id": "y"})
    assert found(reports.payment_mix(dedup_orders(twice))) == [("PAYPAL", 2, 100.0)]


@pytest.mark.parametrize(
    ("amounts", "count", "average"),
    [(("10", "NaN"), 2, 10.0), (("10", "1e29"), 2, 10.0), (("10", "1e17"), 2, 5e16 + 5),
     (("NaN", "x"), 2, None), (("0.004",) * 10, 10, 0.0)],
)
def test_averages_are_over_what_is_summed(orders, amounts, count, average):
    report = reports.hourly_pattern(orders(*({"total_amount": a} for a in amounts)))
    assert found(report) == [(3, count, average)]


def test_sums_keep_parts_of_a_cent(orders):
    report = reports.category_share(orders(*({"total_amount": "0.004"} for _ in range(10))))
    assert found(report) == [("HOME", 10, 0.04, 100.0)]

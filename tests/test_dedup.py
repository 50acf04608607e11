from __future__ import annotations

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderflow.operators.dedup import dedup_orders
from orderflow.plans.curate import curate_orders
from tests.conftest import rows


def test_earliest_copy_survives(raw):
    late, early = "2026-01-02T05:00:00+00:00", "2026-01-02T04:00:00+00:00"
    orders = raw(
        {"order_id": "a", "order_timestamp": late},
        {"order_id": "a", "order_timestamp": early},
        {"order_id": "b", "order_timestamp": late},
    )
    assert rows(dedup_orders(orders), "order_id", "order_timestamp") == [("a", early), ("b", late)]


def test_copy_with_a_time_is_preferred(raw):
    orders = raw({"order_timestamp": "nope", "quantity": "1"}, {"quantity": "2"})
    assert rows(curate_orders(orders), "quantity") == [(2,)]


def test_missing_ids_are_one_key(raw):
    assert dedup_orders(raw({"order_id": None}, {"order_id": None}, {})).count() == 2


def test_equal_copies_leave_one(raw):
    assert dedup_orders(raw({}, {}, {})).count() == 1


copies = st.lists(
    st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(1, 4)), min_size=1, max_size=12
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(copies=copies, seed=st.integers(0, 99))
def test_survivor_ignores_input_order(raw, copies, seed):
    def curated(some):
        orders = [
            {
                "order_id": key,
                "order_timestamp": f"2026-01-02T0{hour}:00:00+00:00",
                "quantity": str(quantity),
            }
            for key, hour, quantity in some
        ]
        return rows(curate_orders(raw(*orders).repartition(3)))

    shuffled = random.Random(seed).sample(copies, len(copies))
    found = curated(copies)
    assert found == curated(shuffled)
    best = {}
    for key, hour, quantity in sorted(copies):
        best.setdefault(key, (hour, quantity))
    assert {row[0]: (row[14], row[5]) for row in found} == best


def test_hot_key_sends_one_row_per_input_partition(spark, raw):
    """A third of the rows share an id; after the partial step few are left."""
    orders = spark.range(0, 30_000, 1, 6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS order_id",
        "id AS order_ts",
    )
    found = dedup_orders(orders)
    assert found.count() == 20_001
    plan = found._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after

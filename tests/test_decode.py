from __future__ import annotations

import base64
import json

import pytest

from orderflow.operators import decode
from orderflow.schema import ENVELOPE
from orderflow.sources.stream import open_messages
from tests.conftest import ORDER, order, rows


@pytest.fixture
def envelopes(spark):
    def make(*payloads: bytes | str | None):
        records = []
        for number, payload in enumerate(payloads):
            if isinstance(payload, str):
                payload = payload.encode()
            data = None if payload is None else base64.b64encode(payload).decode()
            records.append((str(number), data))
        return spark.createDataFrame(records, ENVELOPE)

    return make


def _reasons(frame):
    return [row.reason for row in frame.orderBy(frame.record_id.cast("int")).collect()]


def test_good_order(envelopes):
    orders, rejects = decode.decode_orders(envelopes(json.dumps(ORDER)))
    (row,) = orders.collect()
    assert {name: row[name] for name in ORDER} == ORDER
    assert row.record_id == "0" and row.reason is None
    assert rejects.count() == 0


@pytest.mark.parametrize(
    ("payload", "reason"),
    [
        (None, "bad_base64"),
        (b"\xff\xff", "bad_base64"),
        ("", "bad_json"),
        ("  ", "bad_json"),
        ("{bad", "bad_json"),
        ("{'order_id': 'a'}", "bad_json"),
        ('{"order_id": "a",}', "bad_json"),
        ('{"order_id": "a"} x', "bad_json"),
        ('{"order_id": "a"}{"order_id": "b"}', "bad_json"),
        ('{"order_id": "a"}, {"order_id": "b"}', "bad_json"),
        ('{"order_id": "a"}] x', "bad_json"),
        ('{"order_id": "a"}} x', "bad_json"),
        ("[1]", "not_an_object"),
        ('[{"order_id": "a"}]', "not_an_object"),
        ('"abc"', "not_an_object"),
        ("null", "not_an_object"),
        ("12", "not_an_object"),
        ("{}", "missing_order_timestamp"),
        (json.dumps(order(category=None)), "missing_category"),
        (json.dumps(order(total_amount=None)), "missing_total_amount"),
        (json.dumps(order(total_amount="abc")), "bad_total_amount"),
        (json.dumps(order(order_timestamp=1767322245)), "bad_order_timestamp"),
        (json.dumps(order(order_timestamp=True)), "bad_order_timestamp"),
        (json.dumps(order(order_timestamp=["2026-01-02"])), "bad_order_timestamp"),
        (json.dumps(order(total_amount=float("nan"))), "bad_total_amount"),
        (json.dumps(order(total_amount=True)), "bad_total_amount"),
        (json.dumps(order(total_amount="abc", order_status="CANCELLED")), None),
        ('{"order_status": "CANCELLED"}', None),
        (json.dumps(order(order_status=None)), None),
        (json.dumps(order(total_amount=12.5), indent=1), None),
        (' {"order_status": "CANCELLED"}\n', None),
    ],
)
def test_reasons(envelopes, payload, reason):
    opened = decode.open_envelopes(envelopes(payload))
    assert _reasons(decode.parse_orders(opened, 250)) == [reason]


def test_bad_base64_keeps_the_text(spark):
    records = spark.createDataFrame([("7", "%%%")], ENVELOPE)
    _, rejects = decode.decode_orders(records)
    assert rows(rejects) == [("7", "bad_base64", "%%%")]


def test_fields_an_alert_needs(envelopes):
    """An order above the threshold that lacks one still counts, but is reported."""
    rich = json.dumps(order(total_amount=251, shipping_city=None))
    poor = json.dumps(order(total_amount=250, shipping_city=None))
    opened = decode.open_envelopes(envelopes(rich, poor))
    assert _reasons(decode.parse_orders(opened, 250)) == ["missing_shipping_city", None]
    assert _reasons(decode.parse_orders(opened, None)) == [None, None]
    records = decode.parse_orders(opened, 250)
    assert decode.countable(records).count() == 2
    assert decode.valid(records).count() == 1


def test_stages_cover_every_record(envelopes):
    records = decode.parse_orders(
        decode.open_envelopes(envelopes("{bad", "[1]", "{}", json.dumps(ORDER), None)), 250
    )
    assert decode.parsed(records).count() == 2
    assert decode.valid(records).count() + decode.rejected(records).count() == 5


def test_parse_is_not_repeated_by_filters(envelopes):
    """Filters on the reason stay above the step that parses."""
    orders, _ = decode.decode_orders(envelopes(json.dumps(ORDER)))
    plan = orders._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate explode", 1)
    assert "from_json" not in above and "from_json" in below
    assert "Filter" in above and "Filter" not in below


def test_kafka_messages(spark):
    messages = spark.createDataFrame(
        [("orders", 3, 42, bytearray(json.dumps(ORDER).encode())), ("orders", 3, 43, None)],
        "topic string, partition int, offset bigint, value binary",
    )
    records = decode.parse_orders(open_messages(messages))
    assert rows(records, "record_id", "order_id", "reason") == [
        ("orders-3-42", "o1", None),
        ("orders-3-43", None, "bad_base64"),
    ]

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderflow.schema import ALERT, FAILED_ALERT
from orderflow.streaming import retry, sinks
from orderflow.streaming.retry import RetryRound, read_attempts, retry_failed
from tests.conftest import rows


@pytest.fixture
def table(spark, folder):
    """Failed alerts by order id, as one batch, and rounds over them."""

    class Table:
        failures, attempts = f"{folder}/failed", f"{folder}/attempts"
        calls: list[list[str]] = []

        def fail(self, name, *ids):
            rows = [(i, "C1", "Home", "s", f"m {i}", "receiver is down") for i in ids]
            frame = spark.createDataFrame(rows, FAILED_ALERT)
            sinks.save_batch(frame, "parquet", self.failures, name)

        def round(self, bad=(), **options):
            self.calls = []

            def deliver(alerts, call):
                assert alerts.columns == ALERT.fieldNames()
                ids = [r["order_id"] for r in alerts.collect()]
                self.calls.append(ids)
                if set(ids) & set(bad):
                    raise ValueError("refused")

            return retry_failed(spark, self.failures, self.attempts, deliver, **options)

        def states(self):
            found = read_attempts(spark, self.failures, self.attempts)
            return rows(found, "order_id", "attempts", "state", "reason")

    return Table()


def test_one_bad_alert_is_isolated_and_given_up(table):
    ids = [f"o{k}" for k in range(200)]
    table.fail("one", *ids)
    found = table.round(["o7"])
    # Two calls a level at most, and a level for each bit that tells the bad one apart.
    assert found.delivered == 199 and found.failed == 1 and found.calls <= 2 * 24
    sent = [i for call in table.calls if "o7" not in call for i in call]
    assert sorted(sent) == sorted(set(ids) - {"o7"})
    for attempts in (3, 4, 5):
        assert table.round(["o7"]) == RetryRound(1, 0, 1)
        (state,) = [s for s in table.states() if s[0] == "o7"]
        assert state == ("o7", attempts, "given_up" if attempts == 5 else "open", "refused")
    # Five attempts, and no more.
    assert table.round(["o7"]) == RetryRound(0, 0, 0) and table.calls == []
    good = {s[1:] for s in table.states() if s[0] != "o7"}
    assert good == {(2, "delivered", "receiver is down")}


def test_several_bad_alerts(table):
    table.fail("one", *[f"o{k}" for k in range(60)])
    table.fail("two", *[f"p{k}" for k in range(60)])
    bad = [f"o{k}" for k in range(0, 60, 7)] + ["p3"]
    found = table.round(bad)
    assert (found.delivered, found.failed) == (120 - len(bad), len(bad))
    table.fail("three", "q")
    assert table.round() == RetryRound(1, len(bad) + 1, 0)
    assert {s[2] for s in table.states()} == {"delivered"}


def test_an_outage_ends_the_round(table):
    ids = [f"o{k}" for k in range(100)]
    table.fail("one", *ids)
    found = table.round(ids, outage_calls=10)
    assert (found.calls, found.delivered, found.failed) == (10, 0, 100)
    assert {s[1:3] for s in table.states()} == {(2, "open")}
    assert table.round().delivered == 100


def test_alerts_that_the_receiver_names(spark, table):
    table.fail("one", "a", "b", "c")

    def deliver(alerts, call):
        return alerts.where("order_id = 'b'").select("order_id", F.lit("no such customer").alias("reason"))

    assert retry_failed(spark, table.failures, table.attempts, deliver) == RetryRound(1, 2, 1)
    assert [s for s in table.states() if s[0] == "b"] == [("b", 2, "open", "no such customer")]
    assert table.round() == RetryRound(1, 1, 0)


def test_equal_alerts_stay_together(spark, table):
    table.fail("one", "a", "a", "a", "b")
    assert table.round(["a"]).failed == 1
    assert rows(read_attempts(spark, table.failures, table.attempts), "order_id", "copies", "state") == [
        ("a", 3, "open"), ("b", 1, "delivered"),
    ]
    table.round()
    assert table.calls == [["a", "a", "a"]]


def test_null_order_ids(spark, table):
    table.fail("one", None, "b")

    def deliver(alerts, call):
        return alerts.where("order_id IS NULL").select("order_id", F.lit(None).cast("string").alias("reason"))

    assert retry_failed(spark, table.failures, table.attempts, deliver) == RetryRound(1, 1, 1)


def test_no_failures(table):
    assert table.round() == RetryRound(0, 0, 0) and table.states() == []


def test_a_round_that_ended_early_repeats_nothing(spark, table, monkeypatch):
    """What was written before it ended is not handed over again."""
    table.fail("one", *[f"o{k}" for k in range(40)])
    saved, count = retry.save_batch, []

    def breaks(*args):
        count.append(1)
        if len(count) > 2:
            raise OSError("gone")
        saved(*args)

    with monkeypatch.context() as patch, pytest.raises(OSError, match="gone"):
        patch.setattr(retry, "save_batch", breaks)
        table.round(["o5"])
    done = {s[0] for s in table.states() if s[2] == "delivered"}
    table.round(["o5"])
    again = {i for call in table.calls for i in call}
    assert done and not done & again and done | again == {f"o{k}" for k in range(40)}

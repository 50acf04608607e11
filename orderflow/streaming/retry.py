"""Try failed alerts again until those that cannot be delivered stand alone.

A receiver that raises fails a whole batch, for what may be one bad alert in it.  A round of
retries hands over all open failures; if that fails, halves of them, and so on, until the
bad ones are alone and all others are out.  Splits cost no attempt: an alert has one more
with each round that ends without its delivery, and is given up after a number of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.constants import MAX_ATTEMPTS
from orderflow.schema import ALERT, ATTEMPT, FAILED_ALERT
from orderflow.sources.batches import BATCH, complete_batches
from orderflow.streaming.sinks import save_batch

OPEN, DELIVERED, GIVEN_UP = "open", "delivered", "given_up"
# Calls in a row from the start of a round, none of which got through, that tell an outage.
OUTAGE_CALLS = 64
_BITS = 64


@dataclass(frozen=True)
class RetryRound:
    """Alerts that a round tried, and what became of them; ``calls`` of the receiver."""

    calls: int
    delivered: int
    failed: int


def read_attempts(
    spark: SparkSession, failures: str, attempts: str, most: int = MAX_ATTEMPTS
) -> DataFrame:
    """Every failed alert with its ``failure_id``, ``copies``, ``attempts``, ``state``, ``reason``.

    The delivery that failed first counts as an attempt.  Alerts of a batch that are equal
    in all columns are one failure.  ``reason`` is the last one.
    """
    names = ALERT.fieldNames()
    failed = _read(spark, failures, FAILED_ALERT)
    key = F.sha2(F.to_json(F.struct(BATCH, *names)), 256).alias("failure_id")
    failed = failed.groupBy(key, *names).agg(
        F.count(F.lit(1)).alias("copies"), F.max("reason").alias("first_reason")
    )
    tries = _read(spark, attempts, ATTEMPT).groupBy("failure_id").agg(
        F.count_distinct("round").alias("rounds"),
        F.max("round").alias("last_round"),
        F.bool_or("delivered").alias("delivered"),
        F.max_by("reason", "round").alias("last_reason"),
    )
    tried = F.lit(1) + F.coalesce("rounds", F.lit(0))
    state = (
        F.when(F.coalesce("delivered", F.lit(False)), DELIVERED)
        .when(tried >= most, GIVEN_UP)
        .otherwise(OPEN)
    )
    return failed.join(tries, "failure_id", "left").select(
        "failure_id",
        *names,
        "copies",
        tried.cast("int").alias("attempts"),
        state.alias("state"),
        F.coalesce("last_reason", "first_reason").alias("reason"),
        F.coalesce("last_round", F.lit(0)).alias("last_round"),
    )


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a folder's complete batches; none if there is no batch yet."""
    whole = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
    names = complete_batches(spark, path)
    if names.isEmpty():
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(path).join(names, BATCH, "left_semi")


def _within(depth: int, prefix: int) -> Column:
    """Whether a failure's hash begins with these bits; a split adds one."""
    if depth == 0:
        return F.lit(True)
    return F.shiftrightunsigned(F.col("hash"), _BITS - depth) == prefix


def retry_failed(
    spark: SparkSession,
    failures: str,
    attempts: str,
    deliver: Callable[[DataFrame, int], DataFrame | None],
    most: int = MAX_ATTEMPTS,
    outage_calls: int = OUTAGE_CALLS,
) -> RetryRound:
    """One round over the failures that are open: neither delivered nor given up.

    ``deliver`` is the one of ``start_delivery``; it gets alerts and the number of the call.
    Outcomes are written to ``attempts`` after each call, so a round that ends early
    repeats no alert whose delivery was written.  If the first ``outage_calls`` calls all
    fail, the receiver counts as down: the round ends, as an attempt of all alerts left.
    Alerts are split by a hash of what they are, so halves are about even.
    """
    state = read_attempts(spark, failures, attempts, most)
    rows = state.where(F.col("state") == OPEN).withColumn("hash", F.xxhash64("failure_id"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    number = 1 + (state.agg(F.max("last_round")).first()[0] or 0)

    def note(group: DataFrame, delivered: Column, reason: Column) -> None:
        outcome = group.select(
            "failure_id",
            F.lit(number).alias("round"),
            delivered.alias("delivered"),
            reason.cast("string").alias("reason"),
        )
        save_batch(outcome, "parquet", attempts, uuid.uuid4().hex)

    calls = reached = done = 0
    try:
        total, error = rows.count(), None
        waiting = [(0, 0)] if total else []
        while waiting:
            depth, prefix = waiting.pop()
            group = rows.where(_within(depth, prefix))
            size = group.count()
            if not size:
                continue
            if error is not None and not reached and calls >= outage_calls:
                note(group, F.lit(False), F.lit(str(error)))
                continue
            copies = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))
            alerts = group.select(*ALERT.fieldNames(), copies.alias("copy")).drop("copy")
            calls += 1
            try:
                failed = deliver(alerts, calls)
            except Exception as raised:  # noqa: BLE001  whatever the receiver raises
                error = raised
                if size == 1 or depth == _BITS:
                    note(group, F.lit(False), F.lit(str(raised)))
                else:
                    waiting += [(depth + 1, 2 * prefix + 1), (depth + 1, 2 * prefix)]
                continue
            reached += 1
            if failed is None:
                note(group, F.lit(True), F.lit(None))
            else:
                why = failed.groupBy(F.col("order_id").alias("failed_id")).agg(
                    F.max(F.coalesce("reason", F.lit(""))).alias("why")
                )
                known = group.join(why, F.col("order_id").eqNullSafe(F.col("failed_id")), "left")
                note(known, F.col("why").isNull(), F.col("why"))
        ended = _read(spark, attempts, ATTEMPT).where(F.col("round") == number)
        done = ended.where("delivered").count()
    finally:
        rows.unpersist()
    return RetryRound(calls, done, total - done)

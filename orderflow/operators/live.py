"""Live counters per category and day; one plan for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.constants import CATEGORY_PREFIX, DATE_PREFIX
from orderflow.functions.money import exact_sum
from orderflow.functions.status import counts_live
from orderflow.functions.text import category_key, day_key


def live_metrics(valid: DataFrame) -> DataFrame:
    """Order count and exact revenue by (category, day) of every order not cancelled.

    No watermark: an order of any age still counts.  Spark sums per input
    partition first, so a hot category sends one row per partition and day.
    """
    return (
        valid.where(counts_live())
        .groupBy(category_key().alias("pk"), day_key().alias("sk"))
        .agg(F.count(F.lit(1)).alias("order_count"), exact_sum().alias("revenue"))
    )


def latest_metrics(changes: DataFrame) -> DataFrame:
    """The current value per key from a log of totals numbered by ``batch_id``."""
    return (
        changes.groupBy("pk", "sk")
        .agg(F.max_by(F.struct("order_count", "revenue"), "batch_id").alias("now"))
        .select("pk", "sk", "now.order_count", "now.revenue")
    )


def select_metrics(
    metrics: DataFrame,
    category: str,
    day_from: str | None = None,
    day_to: str | None = None,
) -> DataFrame:
    """One category's counters, over an inclusive range of days (``yyyy-mm-dd``)."""
    found = metrics.where(F.col("pk") == F.lit(CATEGORY_PREFIX + category))
    if day_from is not None:
        found = found.where(F.col("sk") >= F.lit(DATE_PREFIX + day_from))
    if day_to is not None:
        found = found.where(F.col("sk") <= F.lit(DATE_PREFIX + day_to))
    return found

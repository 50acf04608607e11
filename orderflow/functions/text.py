"""Text standardisation, live keys and the alert text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow.constants import (
    ALERT_BODY,
    CATEGORY_PREFIX,
    DATE_PREFIX,
    DEFAULT_CURRENCY,
)
from orderflow.functions.money import cents


def standard(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def category_key(category: str = "category") -> Column:
    return F.concat(F.lit(CATEGORY_PREFIX), F.col(category))


def day_key(timestamp: str = "order_timestamp") -> Column:
    """The day as the event states it: the first ten characters, no zone applied."""
    return F.concat(F.lit(DATE_PREFIX), F.substring(F.col(timestamp), 1, 10))


def alert_body() -> Column:
    return F.format_string(
        ALERT_BODY,
        F.col("order_id"),
        F.col("customer_id"),
        F.col("product_name"),
        F.col("category"),
        cents(),
        F.coalesce(F.col("currency"), F.lit(DEFAULT_CURRENCY)),
        F.col("shipping_city"),
        F.col("shipping_state"),
        F.col("order_timestamp"),
    )

"""High-value orders and the text of their alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.constants import ALERT_SUBJECT, HIGH_VALUE_THRESHOLD
from orderflow.functions.numbers import as_double
from orderflow.functions.status import counts_live
from orderflow.functions.text import alert_body
from orderflow.schema import ALERT

# The order fields an alert cannot be written without.
ALERT_FIELDS = (
    "order_id",
    "customer_id",
    "product_name",
    "category",
    "shipping_city",
    "shipping_state",
    "order_timestamp",
)


def is_high_value(threshold: float = HIGH_VALUE_THRESHOLD) -> Column:
    """Not cancelled and strictly above the threshold."""
    return counts_live() & (as_double("total_amount") > F.lit(float(threshold)))


def high_value_alerts(valid: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    return valid.where(is_high_value(threshold))


def alert_message(alerts: DataFrame) -> DataFrame:
    """Subject and seven-line body of every alert; the amount always shows cents."""
    return alerts.withColumns(
        {"subject": F.lit(ALERT_SUBJECT), "message": alert_body()}
    ).select(*ALERT.fieldNames())

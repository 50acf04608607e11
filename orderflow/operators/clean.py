"""Standardise raw orders into the processed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.numbers import as_double, as_instant, as_int
from orderflow.functions.text import standard
from orderflow.schema import PROCESSED
from orderflow.session import require_utc


def clean_orders(raw: DataFrame) -> DataFrame:
    """The 16 processed columns, in order; every other column is dropped."""
    require_utc(raw.sparkSession)
    return raw.withColumns(
        {
            "order_ts": as_instant("order_timestamp"),
            "total_amount": as_double("total_amount"),
            "unit_price": as_double("unit_price"),
            "quantity": as_int("quantity"),
            "category": standard("category"),
            "order_status": standard("order_status"),
        }
    ).withColumns(
        {
            "order_date": F.to_date("order_ts"),
            "order_hour": F.hour("order_ts"),
        }
    ).select(*PROCESSED.fieldNames())

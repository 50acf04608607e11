"""Raw orders to processed orders."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderflow.operators.clean import clean_orders
from orderflow.operators.dedup import dedup_orders


def curate_orders(raw: DataFrame) -> DataFrame:
    """Clean first: the shuffle by id then carries typed, narrower rows."""
    return dedup_orders(clean_orders(raw))

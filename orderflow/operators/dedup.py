"""Keep one order per id, the same one on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The survivor is the earliest order; further columns only break ties.
SURVIVOR_ORDER = ("order_timestamp", "order_ts", "product_id", "total_amount")


def dedup_orders(
    orders: DataFrame,
    key: str = "order_id",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per ``key``; rows without a key count as one key.

    By default all columns take part in the order, nulls last, so rows that tie
    are equal and the result does not depend on the input's order.  The filter on
    ``row_number`` lets Spark keep the first row per key before the shuffle, so
    a hot key sends one row per input partition.
    """
    if order_by is None:
        leading = [name for name in SURVIVOR_ORDER if name in orders.columns]
        rest = [name for name in orders.columns if name not in leading and name != key]
        order_by = [*leading, *rest]
    earliest = [F.asc_nulls_last(name) for name in order_by]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*earliest))
    return orders.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")

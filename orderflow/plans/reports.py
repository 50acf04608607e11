"""The seven business reports over processed orders.

Every report groups with partial sums before its shuffle and reads only the
columns it names.  Ties are broken by the group keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.constants import REPORT_DAYS, TOP_CITIES, TOP_PRODUCTS
from orderflow.functions.money import average, exact_sum, percent, revenue
from orderflow.functions.status import is_cancelled, is_placed


def _count() -> Column:
    return F.count(F.lit(1))


def _share(part: str) -> Column:
    """Percent of the grand total.  It follows a grouping, so the one task that
    forms the total sees a row per category or payment method, not per order."""
    return percent(F.col(part), F.sum(part).over(Window.partitionBy()))


def daily_revenue(
    orders: DataFrame,
    as_of: Column | dt.date | None = None,
    days: int = REPORT_DAYS,
) -> DataFrame:
    """Revenue and volume by day since ``days`` days before ``as_of`` (today)."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return (
        orders.where(is_placed() & (F.col("order_date") >= F.date_sub(today, days)))
        .groupBy("order_date")
        .agg(
            _count().alias("total_orders"),
            revenue().alias("gross_revenue"),
            average().alias("avg_order_value"),
        )
        .orderBy(F.desc("order_date"))
    )


def category_share(orders: DataFrame) -> DataFrame:
    """Revenue by category and its share of the total."""
    return (
        orders.where(is_placed())
        .groupBy("category")
        .agg(_count().alias("orders"), exact_sum().alias("exact"))
        .select(
            "category",
            "orders",
            F.col("exact").cast("double").alias("revenue"),
            _share("exact").alias("pct_of_revenue"),
        )
        .orderBy(F.desc("revenue"), "category")
    )


def top_products(orders: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """The ``n`` products with the highest revenue."""
    return (
        orders.where(is_placed())
        .groupBy("product_id", "product_name")
        .agg(
            F.sum("quantity").cast("bigint").alias("units_sold"),
            revenue().alias("revenue"),
        )
        .orderBy(F.desc("revenue"), "product_id", "product_name")
        .limit(n)
    )


def hourly_pattern(orders: DataFrame) -> DataFrame:
    """Orders and average value by hour of day."""
    return (
        orders.where(is_placed())
        .groupBy("order_hour")
        .agg(_count().alias("orders"), average().alias("avg_order_value"))
        .orderBy("order_hour")
    )


def cancel_rate(orders: DataFrame) -> DataFrame:
    """Share of cancelled orders by category, over orders of any status."""
    return (
        orders.groupBy("category")
        .agg(_count().alias("total"), F.count_if(is_cancelled()).alias("cancelled"))
        .withColumn("cancel_rate_pct", percent(F.col("cancelled"), F.col("total")))
        .orderBy(F.desc("cancel_rate_pct"), "category")
    )


def top_cities(orders: DataFrame, n: int = TOP_CITIES) -> DataFrame:
    """The ``n`` cities with the highest revenue."""
    return (
        orders.where(is_placed())
        .groupBy("shipping_state", "shipping_city")
        .agg(_count().alias("orders"), revenue().alias("revenue"))
        .orderBy(F.desc("revenue"), "shipping_state", "shipping_city")
        .limit(n)
    )


def payment_mix(orders: DataFrame) -> DataFrame:
    """Orders by payment method and their share."""
    return (
        orders.where(is_placed())
        .groupBy("payment_method")
        .agg(_count().alias("orders"))
        .withColumn("pct", _share("orders"))
        .orderBy(F.desc("orders"), "payment_method")
    )

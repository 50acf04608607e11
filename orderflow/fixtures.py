"""Order data derived from the test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.constants import CANCELLED, DEFAULT_CURRENCY, ORDER_FIELDS, PLACED
from orderflow.operators.clean import clean_orders
from orderflow.operators.dedup import dedup_orders
from orderflow.streaming.sinks import save_batch

RAW_TIE_BREAK = ("order_timestamp", "product_id", "l_suppkey", "total_amount", "l_shipdate")
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one dirty order per line item; ids repeat.

    Customers join orders before line items do: the narrow side is shuffled
    again, not the long one.  Orders and line items both grow with the data, so
    neither is ever broadcast; the other tables are if Spark finds them small.
    """
    placed = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .hint("merge")
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    hour = F.lpad((F.col("l_partkey") % 24).cast("string"), 2, "0")
    even = F.col("l_partkey") % 2 == 0
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.concat(F.lit("C"), "o_custkey").alias("customer_id"),
        F.concat(F.lit("P"), "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(even, F.concat(F.lit("  "), F.lower("p_type"), F.lit(" ")))
        .otherwise(F.col("p_type"))
        .alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("total_amount"),
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        F.col("o_orderpriority").alias("payment_method"),
        F.when(F.col("l_returnflag") == "R", " cancelled")
        .otherwise("Placed")
        .alias("order_status"),
        F.col("n_name").alias("shipping_city"),
        F.col("r_name").alias("shipping_state"),
        F.concat(
            F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T"), hour, F.lit(":00:00+00:00")
        ).alias("order_timestamp"),
        "l_suppkey",
        "l_shipdate",
    )


def processed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 de-duplicated and cleaned."""
    return clean_orders(dedup_orders(raw_orders(spark, sf_dir), order_by=RAW_TIE_BREAK))


def _odd_amount(key: Column) -> Column:
    """Some amounts are very large, some below a cent."""
    large = F.when(key % 103 == 0, F.lit(2e16))
    return large.when(key % 7 == 0, F.lit(0.004)).otherwise(F.col("value"))


def live_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one order per event; some are cancelled, some lack a status."""
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        key.cast("string").alias("order_id"),
        F.concat(F.lit("C"), "user_id").alias("customer_id"),
        F.col("event_type").alias("category"),
        _odd_amount(key).alias("total_amount"),
        F.when(key % 5 == 0, CANCELLED)
        .when(key % 11 == 0, F.lit(None))
        .otherwise(PLACED)
        .alias("order_status"),
        F.date_format("ts", ISO_MICROS).alias("order_timestamp"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one stream record per event, some of them with one of the known faults."""
    key = F.col("event_id")
    order = F.concat(
        F.lit('{"order_id":"'), key,
        F.lit('","customer_id":"C'), "user_id",
        F.when(key % 23 == 0, '"').otherwise(F.concat(F.lit('","category":"'), "event_type", F.lit('"'))),
        F.when(key % 29 == 0, ',"total_amount":"abc"').when(key % 31 == 0, "")
        .otherwise(F.concat(F.lit(',"total_amount":'), "value")),
        F.lit(',"order_status":"PLACED"'),
        F.when(key % 37 == 0, ',"order_timestamp":1767322245').when(key % 41 == 0, "")
        .otherwise(F.concat(F.lit(',"order_timestamp":"'), F.date_format("ts", ISO_MICROS), F.lit('"'))),
        F.lit("}"),
    )
    cancelled = F.concat(F.lit('{"order_id":"'), key, F.lit('","order_status":"CANCELLED"}'))
    payload = (
        F.when(key % 13 == 0, "{bad")
        .when(key % 17 == 0, "[1]")
        .when(key % 43 == 0, cancelled)
        .otherwise(order)
    )
    return table(spark, sf_dir, "events").select(
        key.cast("string").alias("sequence_number"),
        F.when(key % 19 == 0, "@@@").otherwise(_base64(payload)).alias("data"),
    )


def event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a full dirty order per event, with the day it lands on; ids repeat.

    A month of days and five categories, so the processed zone stays small
    enough to write in a test.
    """
    return table(spark, sf_dir, "events").select(
        F.concat_ws("-", "user_id", "event_type", F.date_format("ts", "HH")).alias("order_id"),
        F.concat(F.lit("C"), "user_id").alias("customer_id"),
        F.concat(F.lit("P"), F.get_json_object("props", "$.k")).alias("product_id"),
        F.concat(F.lit("Item "), F.get_json_object("props", "$.k")).alias("product_name"),
        F.concat(F.lit(" "), "event_type", F.lit("  ")).alias("category"),
        F.concat(F.get_json_object("props", "$.k"), F.lit(".0")).alias("quantity"),
        F.col("value").alias("unit_price"),
        F.col("value").alias("total_amount"),
        F.when(F.col("user_id") % 3 > 0, DEFAULT_CURRENCY).alias("currency"),
        F.upper("event_type").alias("payment_method"),
        F.when(F.col("value") < 10, "cancelled ").otherwise(" Placed").alias("order_status"),
        F.concat(F.lit("City "), "user_id").alias("shipping_city"),
        F.lit("NY").alias("shipping_state"),
        F.date_format("ts", ISO_MICROS).alias("order_timestamp"),
        "ts",
        F.date_format("ts", "yyyy").alias("year"),
        F.date_format("ts", "MM").alias("month"),
        F.date_format("ts", "dd").alias("day"),
    )


def order_envelopes(orders: DataFrame, *number: str) -> DataFrame:
    """orders as stream records, numbered by the given columns; null fields are left out."""
    fields = [name for name in ORDER_FIELDS if name in orders.columns]
    return orders.select(
        F.concat_ws("-", *number).alias("sequence_number"),
        _base64(F.to_json(F.struct(*fields))),
    )


def _base64(text: Column) -> Column:
    """On one line, as a stream service sends it; Spark breaks long ones into lines."""
    return F.translate(F.base64(F.encode(text, "UTF-8")), "\r\n", "").alias("data")


def land(orders: DataFrame, path: str) -> None:
    """Append orders to a raw zone under the day in their year, month and day."""
    (
        orders.select(*ORDER_FIELDS, "year", "month", "day")
        .hint("rebalance", "year", "month", "day")
        .write.mode("append")
        .partitionBy("year", "month", "day")
        .json(path)
    )


def land_batch(orders: DataFrame, path: str, name: str) -> None:
    """Land orders as a sink does: a batch of JSON lines with a name, complete at the end."""
    days = ("year", "month", "day")
    lines = orders.select(F.to_json(F.struct(*ORDER_FIELDS)).alias("value"), *days)
    save_batch(lines, "text", path, name, *days)


def stage(records: DataFrame, path: str, batches: int = 4) -> int:
    """Write stream records as JSON files; returns the files that make one of ``batches``.

    Rows stay in the partitions they are read in, without a shuffle; only a
    partition with a large share of all rows is cut into several files.  The
    count reads no column.
    """
    spark = records.sparkSession
    share = max(1, records.count() // (2 * batches))
    records.write.option("maxRecordsPerFile", share).json(path)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part-*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return -(-len(files) // batches)


def move_files(
    spark: SparkSession, source: str, target: str, days_ago: int = 0, prefix: str = ""
) -> None:
    """Move staged files into a stream's folder, as if written some days ago."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(target))
    now = spark._jvm.java.lang.System.currentTimeMillis()
    for status in files.globStatus(path(f"{source}/part-*")):
        place = path(target, prefix + status.getPath().getName())
        files.rename(status.getPath(), place)
        files.setTimes(place, now - days_ago * 86_400_000, -1)

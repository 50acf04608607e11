"""Explicit schemas; nothing in the package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

from orderflow.constants import ORDER_FIELDS

# Raw events are read as text, so that a badly typed field can never drop a row.
ORDER_EVENT = T.StructType([T.StructField(name, T.StringType()) for name in ORDER_FIELDS])

ENVELOPE = T.StructType(
    [
        T.StructField("sequence_number", T.StringType()),
        T.StructField("data", T.StringType()),
    ]
)

PROCESSED = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("shipping_city", T.StringType()),
        T.StructField("shipping_state", T.StringType()),
        T.StructField("order_ts", T.TimestampType()),
        T.StructField("order_hour", T.IntegerType()),
        T.StructField("order_date", T.DateType()),
    ]
)
PROCESSED_PARTITIONS = ("order_date", "category")

METRICS = T.StructType(
    [
        T.StructField("pk", T.StringType()),
        T.StructField("sk", T.StringType()),
        T.StructField("order_count", T.LongType()),
        T.StructField("revenue", T.DecimalType(38, 10)),
    ]
)

REJECT = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)

ALERT = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

# Alerts that could not be delivered.
FAILED = T.StructType(
    [T.StructField("order_id", T.StringType()), T.StructField("reason", T.StringType())]
)

# The whole alerts, as they are kept to be tried again.
FAILED_ALERT = T.StructType([*ALERT.fields, T.StructField("reason", T.StringType())])

# What became of a failed alert in a round of retries.
ATTEMPT = T.StructType(
    [
        T.StructField("failure_id", T.StringType()),
        T.StructField("round", T.IntegerType()),
        T.StructField("delivered", T.BooleanType()),
        T.StructField("reason", T.StringType()),
    ]
)

# What one micro-batch took in, and how many of that were rejected.
BATCH_COUNTS = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("records", T.LongType()),
        T.StructField("failures", T.LongType()),
    ]
)

# What one curation run read and wrote.
RUN_COUNTS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("raw_rows", T.LongType()),
        T.StructField("written_rows", T.LongType()),
    ]
)

# What became of a raw day past its retention, and why it stayed.
EXPIRY = T.StructType(
    [
        T.StructField("landing_day", T.DateType()),
        T.StructField("files", T.LongType()),
        T.StructField("state", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)

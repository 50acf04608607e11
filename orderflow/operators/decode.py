"""Stream envelopes to orders; what cannot be used is set aside with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.functions.money import money
from orderflow.functions.status import counts_live
from orderflow.operators.alerts import ALERT_FIELDS, is_high_value
from orderflow.schema import ORDER_EVENT, REJECT

# Reasons by stage.  Unparsed records reach no sink; unusable orders only the raw
# zone; orders that lack an alert's field the raw zone and the counters.
UNPARSED = ("bad_base64", "bad_json", "not_an_object")
UNUSABLE = (
    "missing_order_timestamp",
    "missing_category",
    "missing_total_amount",
    "bad_total_amount",
    "bad_order_timestamp",
)
NO_ALERT = tuple(
    f"missing_{name}"
    for name in ALERT_FIELDS
    if f"missing_{name}" not in UNUSABLE
)

# A payload is read as the first of two array elements; the second, this mark,
# only comes out as second element if the payload is exactly one JSON value.
_MARK = "_end"
_PAIR = T.ArrayType(T.StructType([*ORDER_EVENT.fields, T.StructField(_MARK, T.StringType())]))
_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def open_envelopes(envelopes: DataFrame) -> DataFrame:
    """``(record_id, payload, raw)``: the payload is null unless it is base64 of UTF-8."""
    payload = F.try_validate_utf8(
        F.try_to_binary("data", F.lit("base64")).cast("string")
    )
    return envelopes.select(
        F.col("sequence_number").alias("record_id"),
        payload.alias("payload"),
        F.coalesce(payload, F.col("data")).alias("raw"),
    )


def _order() -> Column:
    pair = F.from_json(
        F.concat(F.lit("["), F.col("payload"), F.lit(f',{{"{_MARK}":"{_MARK}"}}]')),
        _PAIR,
        _STRICT,
    )
    whole = (F.size(pair) == 2) & (pair[1][_MARK] == F.lit(_MARK))
    return F.when(whole, pair[0])


def _parse_failure() -> Column:
    """Only evaluated for records without an order."""
    value = F.try_parse_json("payload")
    is_object = F.schema_of_variant(value).startswith("OBJECT")
    return (
        F.when(F.col("payload").isNull(), "bad_base64")
        .when(value.isNull() | is_object, "bad_json")
        .otherwise("not_an_object")
    )


def _timestamp_is_text() -> Column:
    """A time must be a JSON string.  Only texts that could be another kind of value are
    looked up in the payload again."""
    value = F.try_variant_get(F.try_parse_json("payload"), "$.order_timestamp", "variant")
    other = F.col("order.order_timestamp").rlike(r"^([-+0-9.eE]+|true|false|[\[{].*)$")
    return F.when(other, F.schema_of_variant(value) == "STRING").otherwise(True)


def _first_missing(names: tuple[str, ...], otherwise: Column) -> Column:
    return F.coalesce(
        *[F.when(F.col(name).isNull(), F.lit(f"missing_{name}")) for name in names],
        otherwise,
    )


def _order_failure(threshold: float | None) -> Column:
    """Cancelled orders reach neither counters nor alerts and need no field."""
    bad_amount = F.when(money().isNull(), F.lit("bad_total_amount")).when(
        ~F.col("timestamp_is_text"), F.lit("bad_order_timestamp")
    )
    unusable = _first_missing(("order_timestamp", "category", "total_amount"), bad_amount)
    if threshold is None:
        return F.when(counts_live(), unusable)
    no_alert = F.when(is_high_value(threshold), _first_missing(ALERT_FIELDS, F.lit(None)))
    return F.when(counts_live(), F.coalesce(unusable, no_alert))


def parse_orders(opened: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row per record: ``record_id``, ``raw``, the order's fields and ``reason``.

    ``reason`` is null for a good order.  With a ``threshold``, orders above it
    must also carry every field of an alert; without one alerts are off.

    The one-element ``explode`` keeps filters on ``reason`` above the parse:
    pushed below it they would parse every payload a second time.
    """
    fields = ORDER_EVENT.fieldNames()
    return (
        opened.withColumn("order", _order())
        .withColumn("order", F.explode(F.array("order")))
        .select(
            "record_id",
            "raw",
            *[F.col("order")[name].alias(name) for name in fields],
            F.when(F.col("order").isNull(), _parse_failure()).alias("parse_failure"),
            F.coalesce(_timestamp_is_text(), F.lit(True)).alias("timestamp_is_text"),
        )
        .select(
            "record_id",
            "raw",
            *fields,
            F.coalesce("parse_failure", _order_failure(threshold)).alias("reason"),
        )
    )


def parsed(records: DataFrame) -> DataFrame:
    """What belongs in the raw zone: every JSON object, usable or not."""
    return records.where(F.col("reason").isNull() | ~F.col("reason").isin(*UNPARSED))


def countable(records: DataFrame) -> DataFrame:
    """What the counters take; an order that only lacks an alert's field counts."""
    return records.where(F.col("reason").isNull() | F.col("reason").isin(*NO_ALERT))


def valid(records: DataFrame) -> DataFrame:
    return records.where(F.col("reason").isNull())


def rejected(records: DataFrame) -> DataFrame:
    return records.where(F.col("reason").isNotNull()).select(*REJECT.fieldNames())


def decode_orders(
    envelopes: DataFrame, threshold: float | None = None
) -> tuple[DataFrame, DataFrame]:
    """The valid orders and the rejected records of a batch or stream of envelopes."""
    records = parse_orders(open_envelopes(envelopes), threshold)
    return valid(records), rejected(records)

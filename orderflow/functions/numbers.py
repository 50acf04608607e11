"""Lenient casts: text that does not fit becomes null, also under ANSI."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(name: str) -> Column:
    return F.col(name).try_cast("double")


def as_int(name: str) -> Column:
    """By way of double, so that the text ``2.0`` is 2."""
    return as_double(name).try_cast("int")


def as_instant(name: str) -> Column:
    return F.col(name).try_cast("timestamp_ltz")

"""Exact money: summed as decimals, so that results do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow.constants import MONEY_TYPE


def money(amount: str = "total_amount") -> Column:
    """The amount as a decimal; null for text that is no number, NaN, infinities and
    amounts from 1e28 on."""
    return F.col(amount).try_cast(MONEY_TYPE)


def exact_sum(amount: str = "total_amount") -> Column:
    """Null, not an error, if the sum itself does not fit."""
    return F.try_sum(money(amount))


def cents(amount: str = "total_amount") -> Column:
    """The amount as text with two places."""
    return F.round(money(amount), 2).cast("decimal(38,2)").cast("string")


def revenue(amount: str = "total_amount") -> Column:
    return exact_sum(amount).cast("double")


def average(amount: str = "total_amount") -> Column:
    """Average to the cent of the amounts that :func:`revenue` adds up; null without any."""
    return F.round(F.try_divide(revenue(amount), F.count(money(amount))), 2)


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")), 2)

"""The two notions of a sale; they differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow.constants import CANCELLED, PLACED


def counts_live(status: str = "order_status") -> Column:
    """Live path: everything but the exact text CANCELLED, so a missing status counts."""
    return ~F.col(status).eqNullSafe(F.lit(CANCELLED))


def is_placed(status: str = "order_status") -> Column:
    """Reports: exactly PLACED, after standardisation."""
    return F.col(status) == F.lit(PLACED)


def is_cancelled(status: str = "order_status") -> Column:
    return F.col(status) == F.lit(CANCELLED)

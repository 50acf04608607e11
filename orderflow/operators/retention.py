"""Which days of the raw zone are still kept."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.constants import RAW_RETENTION_DAYS


def landing_day() -> Column:
    return F.make_date("year", "month", "day")


def _oldest_kept(as_of: Column | dt.date | None, days: int) -> Column:
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.date_sub(today, days)


def raw_retention(
    raw: DataFrame,
    as_of: Column | dt.date | None = None,
    days: int = RAW_RETENTION_DAYS,
) -> DataFrame:
    """Rows landed in the last ``days`` days; on the raw zone it prunes partitions."""
    return raw.where(landing_day() >= _oldest_kept(as_of, days))


def expired_days(
    raw: DataFrame,
    as_of: Column | dt.date | None = None,
    days: int = RAW_RETENTION_DAYS,
) -> DataFrame:
    """The landing days whose partitions may be deleted, with their row counts."""
    return (
        raw.where(landing_day() < _oldest_kept(as_of, days))
        .groupBy("year", "month", "day")
        .agg(F.count(F.lit(1)).alias("orders"))
    )

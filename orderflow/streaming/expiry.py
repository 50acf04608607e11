"""Delete raw days that are past their retention, once they are curated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.constants import RAW_RETENTION_DAYS
from orderflow.schema import EXPIRY
from orderflow.session import path_exists
from orderflow.sources.batches import all_files, forget
from orderflow.sources.records import remove
from orderflow.streaming.incremental import taken

DELETED, KEPT = "deleted", "kept"
NOT_CURATED, NOT_COMPLETE = "not curated", "not complete"
_DAY = "/year=([0-9]+)/month=([0-9]+)/day=([0-9]+)/"


def expiry(
    spark: SparkSession,
    raw_path: str,
    checkpoint: str,
    as_of: dt.date,
    days: int = RAW_RETENTION_DAYS,
) -> DataFrame:
    """The raw days before the last ``days``: ``folder``, ``landing_day``, ``files``, ``reason``.

    ``reason`` says why a day has to stay, null if nothing keeps it: a file that no committed
    run of the curation checkpoint has taken, or a batch that no sink completed.
    """
    files = all_files(spark, raw_path)
    part = [F.regexp_extract("path", _DAY, k) for k in (1, 2, 3)]
    files = files.where(part[0] != "").select(
        "name",
        "complete",
        F.regexp_extract("path", "^(.*" + _DAY[1:-1] + ")/", 1).alias("folder"),
        F.make_date(*[p.cast("int") for p in part]).alias("landing_day"),
    )
    old = files.where(F.col("landing_day") < F.date_sub(F.lit(as_of), days))
    known = taken(spark, checkpoint).select("name").distinct().withColumn("known", F.lit(True))
    judged = old.join(known, "name", "left")
    return judged.groupBy("folder", "landing_day").agg(
        F.count(F.lit(1)).alias("files"),
        F.when(F.bool_or(~F.col("complete")), NOT_COMPLETE)
        .when(F.bool_or(F.col("known").isNull()), NOT_CURATED)
        .alias("reason"),
    )


def expire_raw(
    spark: SparkSession,
    raw_path: str,
    checkpoint: str,
    as_of: dt.date,
    days: int = RAW_RETENTION_DAYS,
) -> DataFrame:
    """Delete the days that :func:`expiry` finds nothing against; tells what it did.

    The log of batches loses those that have no file left.  Not while curation runs.
    """
    if not path_exists(spark, raw_path):
        return spark.createDataFrame([], EXPIRY)
    # A row for each day.
    found = expiry(spark, raw_path, checkpoint, as_of, days).collect()
    report = []
    for row in found:
        if row["reason"] is None:
            remove(spark, row["folder"])
        state = DELETED if row["reason"] is None else KEPT
        report.append((row["landing_day"], row["files"], state, row["reason"]))
    forget(spark, raw_path)
    return spark.createDataFrame(report, EXPIRY)

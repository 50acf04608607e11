"""Raw zone, rejects and alerts.  Each sink is one query with its own checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderflow.schema import ALERT, FAILED, FAILED_ALERT, REJECT
from orderflow.session import ADAPTIVE, conf_scope, path_exists, require_utc
from orderflow.sources.batches import BATCH, complete, is_complete, stream_batches
from orderflow.streaming.runs import batch_name, refuse_foreign, start

RAW_PARTITIONS = {"year": "yyyy", "month": "MM", "day": "dd"}


def save_batch(rows: DataFrame, kind: str, path: str, name: str, *partitions: str) -> None:
    """Add a batch as last partition, then its name to the log of complete batches.

    A batch that is there already stays as it is; one that was left half written is
    replaced.  Other batches are not touched, and a batch without rows leaves no folder.
    The hint gathers the rows of many small tasks into few files.
    """
    spark = rows.sparkSession
    if is_complete(spark, path, name):
        return
    with conf_scope(spark, ADAPTIVE):
        (
            rows.hint("rebalance", *partitions)
            .withColumn(BATCH, F.lit(name))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions, BATCH)
            .format(kind)
            .save(path)
        )
    complete(spark, path, name)


def raw_lines(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Each order's own JSON on one line, with the UTC day it is processed on.

    Line breaks in valid JSON only stand between tokens, so blanks replace them.
    """
    require_utc(records.sparkSession)
    now = F.current_timestamp()
    return records.select(
        *keep,
        F.translate("raw", "\r\n", "  ").alias("value"),
        *[F.date_format(now, pattern).alias(name) for name, pattern in RAW_PARTITIONS.items()],
    )


def write_raw_zone(
    records: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Land parsed records as JSON lines, each record exactly once, in few files a batch.

    A batch that is tried again after it was complete is left alone.  Nothing lists the
    zone's files, so expired days can be deleted as folders.
    """
    refuse_foreign(records.sparkSession, path, checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        save_batch(batch, "text", path, batch_name(batch, batch_id), *RAW_PARTITIONS)

    return start(raw_lines(records).writeStream.foreachBatch(put), checkpoint, available_now)


def write_rejects(
    rejects: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append ``(record_id, reason, raw)`` of every rejected record, once."""
    refuse_foreign(rejects.sparkSession, path, checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        save_batch(batch, "parquet", path, batch_name(batch, batch_id))

    rows = rejects.select(*REJECT.fieldNames())
    return start(rows.writeStream.foreachBatch(put), checkpoint, available_now)


def write_alerts(
    messages: DataFrame, path: str | None, checkpoint: str, available_now: bool = False
) -> StreamingQuery | None:
    """Keep every alert; no ``path`` turns alerts off."""
    if not path:
        return None
    refuse_foreign(messages.sparkSession, path, checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        save_batch(batch, "parquet", path, batch_name(batch, batch_id))

    rows = messages.select(*ALERT.fieldNames())
    return start(rows.writeStream.foreachBatch(put), checkpoint, available_now)


def start_delivery(
    spark: SparkSession,
    alerts: str,
    checkpoint: str,
    deliver: Callable[[DataFrame, int], DataFrame | None],
    failures: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Hand saved alerts to ``deliver``, in a query that no other sink waits for.

    ``deliver`` gets batches as a DataFrame, should work on its partitions, and may
    return the alerts it could not deliver, as ``order_id`` and ``reason``.  If it
    raises, all of the batch's are taken for that.  They are kept in ``failures``,
    and the query goes on.  The query follows the log of complete batches, so an alert
    is handed over once however often its batch was saved; only a delivery that ended
    before its own commit is done again.  It may start before the first alert.
    """

    def put(names: DataFrame, batch_id: int) -> None:
        found = [f"{alerts}/{BATCH}={row[BATCH]}" for row in names.collect()]
        found = [folder for folder in found if path_exists(spark, folder)]
        if not found:
            return
        # Alerts are few; keeping them spares a second read.
        kept = names.sparkSession.read.schema(ALERT).parquet(*found).persist()
        try:
            try:
                failed = deliver(kept, batch_id)
            except Exception as error:  # noqa: BLE001  whatever the receiver raises
                rows = kept.withColumn("reason", F.lit(str(error)))
            else:
                rows = None if failed is None else _failed_alerts(kept, failed)
            if rows is not None:
                rows = rows.select(*FAILED_ALERT.fieldNames())
                save_batch(rows, "parquet", failures, batch_name(names, batch_id))
        finally:
            kept.unpersist()

    refuse_foreign(spark, failures, checkpoint)
    stream = stream_batches(spark, alerts)
    return start(stream.writeStream.foreachBatch(put), checkpoint, available_now)


def _failed_alerts(alerts: DataFrame, failed: DataFrame) -> DataFrame:
    """The alerts of these order ids, to be tried again; an id without one stays by itself."""
    reasons = failed.groupBy("order_id").agg(F.max("reason").alias("reason")).alias("f")
    same = F.col("a.order_id").eqNullSafe(F.col("f.order_id"))
    rest = [F.col(f"a.{name}") for name in ALERT.fieldNames() if name != "order_id"]
    found = reasons.join(alerts.alias("a"), same, "left")
    return found.select(F.col("f.order_id"), *rest, F.col("f.reason"))


def read_failed(spark: SparkSession, path: str) -> DataFrame:
    """What could not be delivered at first; :mod:`orderflow.streaming.retry` tries it again."""
    return spark.read.schema(FAILED).parquet(path).select(*FAILED.fieldNames())


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REJECT).parquet(path).select(*REJECT.fieldNames())


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ALERT).parquet(path).select(*ALERT.fieldNames())

"""One stream of envelopes into all live sinks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderflow.constants import HIGH_VALUE_THRESHOLD
from orderflow.operators import decode
from orderflow.operators.alerts import alert_message, high_value_alerts
from orderflow.operators.live import live_metrics
from orderflow.schema import BATCH_COUNTS
from orderflow.streaming import sinks
from orderflow.streaming.metrics_log import CHANGES, write_live_metrics
from orderflow.streaming.runs import batch_name, refuse_foreign, start


@dataclass(frozen=True)
class LivePaths:
    """Where the live sinks write; an empty ``alerts`` turns alerts off, and ``counts``
    keeps the counts of each batch of a fan-out."""

    raw: str
    rejects: str
    metrics: str
    checkpoints: str
    alerts: str | None = None
    counts: str | None = None


@dataclass(frozen=True)
class BatchCounts:
    """The records one micro-batch took in, and how many of them were rejected."""

    batch_id: int
    records: int
    failures: int


_COUNTS = "counts"


def _records(opened: DataFrame, paths: LivePaths, threshold: float) -> DataFrame:
    return decode.parse_orders(opened, threshold if paths.alerts else None)


def _counted(records: DataFrame) -> DataFrame:
    """Count while the rows pass; this takes no extra pass."""
    return records.observe(
        _COUNTS,
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("reason").isNotNull()).alias("failures"),
    )


def batch_counts(query: StreamingQuery) -> list[BatchCounts]:
    """Counts of the latest micro-batches, as many as Spark remembers; the first query of
    a pipeline has them.  A fan-out keeps all, see :func:`read_counts`."""
    return [
        BatchCounts(progress.batchId, counts["records"], counts["failures"])
        for progress in query.recentProgress
        if (counts := progress.observedMetrics.get(_COUNTS))
    ]


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Records and failures of every micro-batch of a fan-out."""
    return spark.read.schema(BATCH_COUNTS).parquet(path).select(*BATCH_COUNTS.fieldNames())


def _messages(records: DataFrame, threshold: float) -> DataFrame:
    return alert_message(high_value_alerts(decode.valid(records), threshold))


def _start_metrics(
    records: DataFrame, paths: LivePaths, state_partitions: int | None, available_now: bool
) -> StreamingQuery:
    return write_live_metrics(
        live_metrics(decode.countable(records)),
        paths.metrics,
        f"{paths.checkpoints}/metrics",
        state_partitions=state_partitions,
        available_now=available_now,
    )


def start_pipeline(
    opened: DataFrame,
    paths: LivePaths,
    threshold: float = HIGH_VALUE_THRESHOLD,
    state_partitions: int | None = None,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Start one query per sink over opened records.

    Each has its own checkpoint, so a sink that fails neither holds up the
    others nor makes them write twice.  The price is that each parses the stream.
    """
    records = _records(opened, paths, threshold)
    spark, checks = opened.sparkSession, paths.checkpoints
    _refuse(
        spark,
        {
            paths.raw: f"{checks}/raw",
            paths.rejects: f"{checks}/rejects",
            paths.alerts: f"{checks}/alerts",
            _changes(paths): f"{checks}/metrics",
        },
    )
    return _start_all(
        lambda: sinks.write_raw_zone(
            decode.parsed(_counted(records)),
            paths.raw,
            f"{checks}/raw",
            available_now=available_now,
        ),
        lambda: sinks.write_rejects(
            decode.rejected(records),
            paths.rejects,
            f"{checks}/rejects",
            available_now=available_now,
        ),
        lambda: _start_metrics(records, paths, state_partitions, available_now),
        lambda: sinks.write_alerts(
            _messages(records, threshold),
            paths.alerts,
            f"{checks}/alerts",
            available_now=available_now,
        ),
    )


def _refuse(spark: SparkSession, outputs: dict[str | None, str]) -> None:
    """Ask of all outputs, before any query starts, whether they are another stream's."""
    for output, checkpoint in outputs.items():
        if output:
            refuse_foreign(spark, output, checkpoint)


def _changes(paths: LivePaths) -> str:
    return f"{paths.metrics}/kind={CHANGES}"


def _start_all(*starts: Callable[[], StreamingQuery | None]) -> list[StreamingQuery]:
    """Start all queries or none: if one cannot start, those before it are stopped."""
    running: list[StreamingQuery] = []
    try:
        for begin in starts:
            query = begin()
            if query is not None:
                running.append(query)
    except BaseException:
        for query in running:
            query.stop()
        raise
    return running


def start_fan_out(
    opened: DataFrame,
    paths: LivePaths,
    threshold: float = HIGH_VALUE_THRESHOLD,
    state_partitions: int | None = None,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Start two queries: one for all sinks without state, one for the counters.

    The usual choice.  A batch is parsed once and kept, in memory or on disk, while
    its sinks are written; bound its size at the source.  A batch that is tried again
    writes only what it had not completed.  Alerts are only saved here: ``sinks.start_delivery``
    sends them, in a query of its own.
    """
    records = _records(opened, paths, threshold)
    lines = sinks.raw_lines(_counted(records), keep=records.columns)

    def put(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(batch, batch_id)
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            days = sinks.RAW_PARTITIONS
            raw = decode.parsed(kept).select("value", *days)
            sinks.save_batch(raw, "text", paths.raw, name, *days)
            sinks.save_batch(decode.rejected(kept), "parquet", paths.rejects, name)
            if paths.alerts:
                sinks.save_batch(_messages(kept, threshold), "parquet", paths.alerts, name)
            if paths.counts:
                counts = kept.agg(
                    F.lit(batch_id).cast("bigint").alias("batch_id"),
                    F.count(F.lit(1)).alias("records"),
                    F.count_if(F.col("reason").isNotNull()).alias("failures"),
                )
                sinks.save_batch(counts, "parquet", paths.counts, name)
        finally:
            kept.unpersist()

    checks = paths.checkpoints
    outputs = (paths.raw, paths.rejects, paths.alerts, paths.counts)
    _refuse(
        opened.sparkSession,
        {output: f"{checks}/sinks" for output in outputs} | {_changes(paths): f"{checks}/metrics"},
    )
    return _start_all(
        lambda: start(lines.writeStream.foreachBatch(put), f"{checks}/sinks", available_now),
        lambda: _start_metrics(records, paths, state_partitions, available_now),
    )

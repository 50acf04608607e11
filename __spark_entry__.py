
from __future__ import annotations

import datetime
import functools
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle_queries  # noqa: E402
from orderflow import fixtures  # noqa: E402
from orderflow.operators import decode  # noqa: E402
from orderflow.operators.alerts import alert_message, high_value_alerts  # noqa: E402
from orderflow.operators.clean import clean_orders  # noqa: E402
from orderflow.operators.dedup import dedup_orders  # noqa: E402
from orderflow.operators.live import live_metrics  # noqa: E402
from orderflow.operators.retention import expired_days, landing_day, raw_retention  # noqa: E402
from orderflow.plans import reports  # noqa: E402
from orderflow.plans.curate import curate_orders  # noqa: E402
from orderflow.session import pin_utc, shared_dir  # noqa: E402
from orderflow.sources.catalog import (  # noqa: E402
    compact_runs,
    files_table,
    list_partitions,
    register_processed,
)
from orderflow.sources.processed import (  # noqa: E402
    read_evolved,
    read_processed,
    write_processed,
)
from orderflow.sources.raw_zone import read_raw  # noqa: E402
from orderflow.sources.segments import read_segments  # noqa: E402
from orderflow.sources.stream import read_order_stream  # noqa: E402
from orderflow.streaming import sinks  # noqa: E402
from orderflow.streaming.expiry import expire_raw  # noqa: E402
from orderflow.streaming.incremental import RunMetrics, run_incremental  # noqa: E402
from orderflow.streaming.metrics_log import (  # noqa: E402
    metrics_lookup,
    read_live_metrics,
    write_live_metrics,
)
from orderflow.streaming.pipeline import LivePaths, read_counts, start_fan_out  # noqa: E402
from orderflow.streaming.retry import read_attempts, retry_failed  # noqa: E402
from orderflow.streaming.runs import drain, finish, start  # noqa: E402

try:  # The training-data operators are an optional part of the package.
    import corpus_pipeline  # noqa: E402
    from orderflow.llm import queries as llm  # noqa: E402
except ImportError:
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

# The live state is small: a row per category and day.
STATE_PARTITIONS = 8


def _comparable(orders: DataFrame) -> DataFrame:
    """Zone-free times, as the SQL side has them."""
    return orders.withColumn("order_ts", F.col("order_ts").cast("timestamp_ntz"))


# Reports over the processed orders.


def _report(report: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(fixtures.processed_orders(spark, sf_dir))

    return run


def _last_day(orders: DataFrame) -> Column:
    """The test data ends in the past, so its last day stands for today."""
    return orders.agg(F.max("order_date")).scalar()


def report_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Orders with a line item know the last day; the other joins add nothing to that.
    placed = fixtures.table(spark, sf_dir, "orders")
    lines = fixtures.table(spark, sf_dir, "lineitem").hint("merge")
    sold = placed.join(lines, placed["o_orderkey"] == lines["l_orderkey"], "left_semi")
    today = sold.agg(F.max(F.to_date("o_orderdate"))).scalar()
    return reports.daily_revenue(fixtures.processed_orders(spark, sf_dir), as_of=today)


# Curation.


def etl_clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(fixtures.processed_orders(spark, sf_dir))


def etl_dedup_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_orders(
        fixtures.raw_orders(spark, sf_dir), order_by=fixtures.RAW_TIE_BREAK
    )


def etl_time_derivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = clean_orders(fixtures.raw_orders(spark, sf_dir))
    return _comparable(
        times.select("order_id", "product_id", "order_ts", "order_hour", "order_date")
    )


def etl_raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "raw")
    fixtures.land(fixtures.event_orders(spark, sf_dir), path)
    raw = read_raw(spark, path)
    return raw.withColumns(
        {name: F.col(name).cast("double") for name in ("unit_price", "total_amount")}
    )


def etl_processed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "processed")
    write_processed(curate_orders(fixtures.event_orders(spark, sf_dir)), path, "0")
    return _comparable(read_processed(spark, path))


def _two_runs(spark: SparkSession, sf_dir: str) -> tuple[str, list[RunMetrics]]:
    """Land and curate the first half of the month, then the second, then nothing."""
    folder = shared_dir(spark, "nightly")
    raw, out, checkpoint = (f"{folder}/{name}" for name in ("raw", "processed", "checkpoint"))
    orders = fixtures.event_orders(spark, sf_dir)
    second = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    runs = []
    for wave in (~second, second):
        fixtures.land(orders.where(wave), raw)
        runs += run_incremental(spark, raw, out, checkpoint)
    runs += run_incremental(spark, raw, out, checkpoint)
    return out, runs


def etl_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _two_runs(spark, sf_dir)
    return _comparable(read_processed(spark, out))


def _halves() -> tuple[Column, Column]:
    second = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    return ~second, second


def etl_retried_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, each saved once more after a curation run has taken it."""
    folder = shared_dir(spark, "retried")
    raw, out, checkpoint = (f"{folder}/{name}" for name in ("raw", "processed", "checkpoint"))
    orders = fixtures.event_orders(spark, sf_dir)
    for name, wave in zip(("first", "second"), _halves(), strict=True):
        for _ in range(2):
            fixtures.land_batch(orders.where(wave), raw, name)
            run_incremental(spark, raw, out, checkpoint)
    return _comparable(read_processed(spark, out))


def etl_dedup_across_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the first half of the month are not curated again in the second."""
    folder = shared_dir(spark, "across")
    raw, out, checkpoint = (f"{folder}/{name}" for name in ("raw", "processed", "checkpoint"))
    orders = fixtures.event_orders(spark, sf_dir)
    for name, wave in zip(("first", "second"), _halves(), strict=True):
        fixtures.land_batch(orders.where(wave), raw, name)
        run_incremental(spark, raw, out, checkpoint, across_runs=True)
    return _comparable(read_processed(spark, out))


def etl_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, runs = _two_runs(spark, sf_dir)
    rows = [(number, run.raw_rows, run.written_rows) for number, run in enumerate(runs)]
    return spark.createDataFrame(rows, "run int, raw_rows bigint, written_rows bigint")


# Catalog.


def _registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _two_runs(spark, sf_dir)
    name = f"orders_{uuid.uuid4().hex}"
    return register_processed(spark, out, name, database_path=f"{out}_{name}")


def catalog_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_partitions(_registered(spark, sf_dir))


def catalog_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _registered(spark, sf_dir)
    return reports.daily_revenue(orders, as_of=_last_day(orders))


def _on_table(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_registered(spark, sf_dir))


def catalog_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run's files have one column more than the first's."""
    path, later = _evolving(spark, sf_dir)
    later()
    return _comparable(read_evolved(spark, path))


def _evolving(spark: SparkSession, sf_dir: str) -> tuple[str, Callable[[], None]]:
    """A zone with one run, and what adds a second run with a further column."""
    path = shared_dir(spark, "evolved")
    orders = fixtures.event_orders(spark, sf_dir)
    second = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    write_processed(curate_orders(orders.where(~second)), path, "0")
    segment = F.concat(F.lit("S-"), "customer_id")
    more = curate_orders(orders.where(second)).withColumn("segment", segment)
    return path, lambda: write_processed(more, path, "1")


def catalog_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered table takes up the column of a later run."""
    path, later = _evolving(spark, sf_dir)
    name = f"orders_{uuid.uuid4().hex}"
    register_processed(spark, path, name, database_path=f"{path}_{name}")
    later()
    return _comparable(register_processed(spark, path, name, runs=["1"]))


def catalog_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and partitions by day and category, after runs of the same days were merged."""
    folder = shared_dir(spark, "compacted")
    path, name = f"{folder}/processed", f"orders_{uuid.uuid4().hex}"
    orders = fixtures.event_orders(spark, sf_dir)
    for number in range(3):
        # An order's id names its user, so runs share days but no id.
        part = orders.where(F.substring("customer_id", 2, 20).cast("bigint") % 3 == number)
        write_processed(curate_orders(part), path, str(number))
        register_processed(spark, path, name, database_path=f"{folder}/db", runs=[str(number)])
        if number:
            compact_runs(spark, path, name)
    rows = spark.table(f"{name}.{files_table(spark, name)}")
    by_day = rows.groupBy("order_date", "category")
    return by_day.agg(F.count("*").alias("n"), F.count_distinct("run_id").alias("partitions"))


# Retention, on a landed raw zone.  A month of days, so a week is kept.
KEPT_DAYS = 7


def _landed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, datetime.date]:
    path = shared_dir(spark, "raw")
    fixtures.land(fixtures.event_orders(spark, sf_dir), path)
    raw = read_raw(spark, path)
    # The last day as a value, not a subquery: it then prunes folders.
    return raw, raw.agg(F.max(landing_day())).first()[0]


def raw_retention_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, today = _landed(spark, sf_dir)
    kept = raw_retention(raw, as_of=today, days=KEPT_DAYS)
    return kept.groupBy(landing_day().alias("landing_day")).agg(F.count("*").alias("orders"))


def raw_expired_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, today = _landed(spark, sf_dir)
    return expired_days(raw, as_of=today, days=KEPT_DAYS)


def raw_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days past a week are deleted if curated; the second half of the month is not."""
    folder = shared_dir(spark, "expiry")
    raw, out, checkpoint = (f"{folder}/{name}" for name in ("raw", "processed", "checkpoint"))
    orders = fixtures.event_orders(spark, sf_dir)
    first, second = _halves()
    fixtures.land_batch(orders.where(first), raw, "first")
    run_incremental(spark, raw, out, checkpoint)
    fixtures.land_batch(orders.where(second), raw, "second")
    today = read_raw(spark, raw).agg(F.max(landing_day())).first()[0]
    done = expire_raw(spark, raw, checkpoint, today, KEPT_DAYS).drop("files")
    left = read_raw(spark, raw).groupBy(landing_day().alias("landing_day"))
    left = left.agg(F.count("*").alias("orders_left"))
    return done.join(left, "landing_day", "full")


# Live path.


def _stream(spark: SparkSession, records: DataFrame) -> tuple[DataFrame, str]:
    """Records as a stream of several micro-batches, and a folder for its output."""
    folder = shared_dir(spark, "live")
    staged = f"{folder}/stream"
    max_files = fixtures.stage(records, staged)
    return read_order_stream(spark, staged, max_files), folder


def rt_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, folder = _stream(spark, fixtures.envelopes(spark, sf_dir))
    out = f"{folder}/out"
    writer = stream.writeStream.format("parquet").option("path", out)
    finish(start(writer, f"{folder}/checkpoint", available_now=True))
    return spark.read.schema(stream.schema).parquet(out)


def _decoded_columns() -> list[Column]:
    return [
        F.col("order_id"),
        F.col("customer_id"),
        F.col("category"),
        F.col("total_amount").try_cast("double").alias("total_amount"),
        F.substring("order_timestamp", 1, 10).alias("order_day"),
    ]


def rt_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of the files is three months older than what was read before it."""
    folder = shared_dir(spark, "late")
    records = fixtures.envelopes(spark, sf_dir)
    early = F.col("sequence_number").cast("bigint") % 2 == 0
    for wave, days_ago in ((early, 0), (~early, 90)):
        staged = f"{folder}/staged-{days_ago}"
        fixtures.stage(records.where(wave), staged)
        fixtures.move_files(spark, staged, f"{folder}/stream", days_ago)
        stream = read_order_stream(spark, f"{folder}/stream")
        writer = stream.writeStream.format("parquet").option("path", f"{folder}/out")
        finish(start(writer, f"{folder}/checkpoint", available_now=True))
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def rt_latest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that come after the stream was started behind those there were."""
    folder = shared_dir(spark, "segments")
    records = fixtures.envelopes(spark, sf_dir)
    early = F.col("sequence_number").cast("bigint") % 2 == 0
    # Eight batches or so, at any size.
    bound = 1 + records.where(~early).count() // 8
    for number, wave in enumerate((early, ~early)):
        fixtures.stage(records.where(wave), f"{folder}/staged-{number}")
        fixtures.move_files(
            spark, f"{folder}/staged-{number}", f"{folder}/segments", prefix=f"{number:05d}-"
        )
        stream = read_segments(spark, f"{folder}/segments", bound)
        writer = stream.writeStream.format("parquet").option("path", f"{folder}/out")
        drain(writer, f"{folder}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def rt_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, _ = decode.decode_orders(fixtures.envelopes(spark, sf_dir))
    return orders.select(*_decoded_columns())


def rt_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, folder = _stream(spark, fixtures.envelopes(spark, sf_dir))
    _, rejects = decode.decode_orders(stream)
    out = f"{folder}/rejects"
    finish(sinks.write_rejects(rejects, out, f"{folder}/checkpoint", available_now=True))
    return sinks.read_rejects(spark, out)


def rt_raw_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, folder = _stream(spark, fixtures.envelopes(spark, sf_dir))
    records = decode.parse_orders(decode.open_envelopes(stream))
    out = f"{folder}/orders"
    finish(
        sinks.write_raw_zone(
            decode.parsed(records), out, f"{folder}/checkpoint", available_now=True
        )
    )
    raw = read_raw(spark, out)
    return raw.select(*_decoded_columns(), "year", "month", "day")


def rt_live_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = live_metrics(fixtures.live_orders(spark, sf_dir))
    return metrics.withColumn("revenue", F.col("revenue").cast("double"))


def _live_metrics_folder(spark: SparkSession, sf_dir: str) -> str:
    orders = fixtures.live_orders(spark, sf_dir)
    stream, folder = _stream(spark, fixtures.order_envelopes(orders, "order_id"))
    records = decode.parse_orders(decode.open_envelopes(stream))
    out = f"{folder}/metrics"
    finish(
        write_live_metrics(
            live_metrics(decode.countable(records)),
            out,
            f"{folder}/checkpoint",
            state_partitions=STATE_PARTITIONS,
            available_now=True,
        )
    )
    return out


def rt_live_metrics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = read_live_metrics(spark, _live_metrics_folder(spark, sf_dir))
    return metrics.withColumn("revenue", F.col("revenue").cast("double"))


def rt_metrics_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _live_metrics_folder(spark, sf_dir)
    found = metrics_lookup(spark, path, "click", "2024-01-05", "2024-01-20")
    return found.withColumn("revenue", F.col("revenue").cast("double"))


def rt_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_value_alerts(fixtures.live_orders(spark, sf_dir)).select(
        "order_id", "customer_id", "category", "total_amount"
    )


def rt_alert_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_message(high_value_alerts(fixtures.raw_orders(spark, sf_dir), 50_000))


def rt_alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixtures.event_orders(spark, sf_dir)
    stream, folder = _stream(
        spark, fixtures.order_envelopes(orders, "order_id", "order_timestamp")
    )
    accepted, _ = decode.decode_orders(stream, threshold=250)
    out = f"{folder}/alerts"
    finish(
        sinks.write_alerts(
            alert_message(high_value_alerts(accepted)),
            out,
            f"{folder}/checkpoint",
            available_now=True,
        )
    )
    return sinks.read_alerts(spark, out)


def rt_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in every sink of one stream whose alerts cannot be delivered."""
    orders = fixtures.event_orders(spark, sf_dir)
    good = fixtures.order_envelopes(orders, "order_id", "order_timestamp")
    stream, folder = _stream(spark, good.unionByName(fixtures.envelopes(spark, sf_dir)))
    names = ("raw", "rejects", "metrics", "checkpoints", "alerts", "counts")
    paths = LivePaths(**{name: f"{folder}/{name}" for name in names})
    for query in start_fan_out(
        decode.open_envelopes(stream),
        paths,
        state_partitions=STATE_PARTITIONS,
        available_now=True,
    ):
        finish(query)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        raise ConnectionError("receiver is down")

    failures, checkpoint = f"{folder}/failed", f"{folder}/checkpoints/delivery"
    finish(
        sinks.start_delivery(
            spark, paths.alerts, checkpoint, deliver, failures, available_now=True
        )
    )
    counts = read_counts(spark, paths.counts)
    empty, one = F.lit(""), F.lit(1)
    found = [
        ("raw", read_raw(spark, paths.raw), empty, one),
        ("rejects", sinks.read_rejects(spark, paths.rejects), F.col("reason"), one),
        ("alerts", sinks.read_alerts(spark, paths.alerts), empty, one),
        ("failed", sinks.read_failed(spark, failures), F.col("reason"), one),
        ("counted", counts, F.lit("records"), F.col("records")),
        ("counted", counts, F.lit("failures"), F.col("failures")),
        ("metrics", read_live_metrics(spark, paths.metrics), empty, F.col("order_count")),
    ]
    return functools.reduce(
        DataFrame.unionByName,
        [
            rows.groupBy(F.lit(sink).alias("sink"), detail.alias("detail")).agg(
                F.sum(n).cast("bigint").alias("n")
            )
            for sink, rows, detail, n in found
        ],
    )


def rt_retried_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A receiver that is down at first, then refuses any batch with one customer's alerts."""
    orders = fixtures.event_orders(spark, sf_dir)
    stream, folder = _stream(
        spark, fixtures.order_envelopes(orders, "order_id", "order_timestamp")
    )
    accepted, _ = decode.decode_orders(stream, threshold=250)
    saved, failures, attempts = (f"{folder}/{name}" for name in ("alerts", "failed", "attempts"))
    messages = alert_message(high_value_alerts(accepted))
    finish(sinks.write_alerts(messages, saved, f"{folder}/checkpoint", available_now=True))
    number = F.substring("customer_id", 2, 20).cast("bigint")
    refused = f"C{sinks.read_alerts(spark, saved).agg(F.max(number)).first()[0]}"

    def down(alerts: DataFrame, batch_id: int) -> None:
        raise ConnectionError("receiver is down")

    def picky(alerts: DataFrame, call: int) -> None:
        if not alerts.where(F.col("customer_id") == refused).isEmpty():
            raise ValueError("refused")

    finish(
        sinks.start_delivery(
            spark, saved, f"{folder}/sent", down, failures, available_now=True
        )
    )
    while retry_failed(spark, failures, attempts, picky).calls:
        pass
    states = read_attempts(spark, failures, attempts)
    return states.groupBy("order_id", "attempts", "state", "reason").agg(
        F.sum("copies").alias("n")
    )


_QUERIES: dict[str, Query] = {
    "report_daily_revenue": report_daily_revenue,
    "report_category_share": _report(reports.category_share),
    "report_top_products": _report(reports.top_products),
    "report_hourly": _report(reports.hourly_pattern),
    "report_cancel_rate": _report(reports.cancel_rate),
    "report_top_cities": _report(reports.top_cities),
    "report_payment_mix": _report(reports.payment_mix),
    "etl_clean_orders": etl_clean_orders,
    "etl_dedup_orders": etl_dedup_orders,
    "etl_time_derivation": etl_time_derivation,
    "etl_raw_scan": etl_raw_scan,
    "etl_processed_roundtrip": etl_processed_roundtrip,
    "etl_incremental": etl_incremental,
    "etl_retried_batch": etl_retried_batch,
    "etl_dedup_across_runs": etl_dedup_across_runs,
    "etl_run_metrics": etl_run_metrics,
    "catalog_partitions": catalog_partitions,
    "catalog_daily_revenue": catalog_daily_revenue,
    "catalog_category_share": _on_table(reports.category_share),
    "catalog_top_products": _on_table(reports.top_products),
    "catalog_hourly": _on_table(reports.hourly_pattern),
    "catalog_cancel_rate": _on_table(reports.cancel_rate),
    "catalog_top_cities": _on_table(reports.top_cities),
    "catalog_payment_mix": _on_table(reports.payment_mix),
    "catalog_merge_schema": catalog_merge_schema,
    "catalog_evolved": catalog_evolved,
    "catalog_compacted": catalog_compacted,
    "raw_retention": raw_retention_days,
    "raw_expired_days": raw_expired_days,
    "raw_expiry": raw_expiry,
    "rt_stream_ingest": rt_stream_ingest,
    "rt_late_files": rt_late_files,
    "rt_latest_records": rt_latest_records,
    "rt_fan_out": rt_fan_out,
    "rt_decode": rt_decode,
    "rt_quarantine": rt_quarantine,
    "rt_raw_zone": rt_raw_zone,
    "rt_live_metrics": rt_live_metrics,
    "rt_live_metrics_stream": rt_live_metrics_stream,
    "rt_metrics_lookup": rt_metrics_lookup,
    "rt_alerts": rt_alerts,
    "rt_alert_message": rt_alert_message,
    "rt_alert_stream": rt_alert_stream,
    "rt_retried_alerts": rt_retried_alerts,
}


def _optional() -> dict[str, Query]:
    if llm is None:
        return {}
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}


def _in_utc(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(pin_utc(spark), sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: revenue by category and its share of the total."""
    return queries()["report_category_share"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {name: _in_utc(query) for name, query in {**_QUERIES, **_optional()}.items()}


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return dict(oracle_queries.SQL)
    sql = {**oracle_queries.SQL, **llm.SQL}
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql

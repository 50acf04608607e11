"""Curate only the raw batches and files that no earlier run has taken."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderflow.plans.curate import curate_orders
from orderflow.schema import PROCESSED, RUN_COUNTS
from orderflow.session import path_exists, require_utc
from orderflow.sources.batches import files_handed_over
from orderflow.sources.processed import run_path, write_processed
from orderflow.sources.raw_zone import read_files
from orderflow.sources.records import folder_names, put_once, read_text, remove
from orderflow.sources.run_ids import drop_known, write_filter
from orderflow.streaming.runs import refuse_foreign, time_limit

_PLAN = "path string, name string"


@dataclass(frozen=True)
class RunMetrics:
    """What one run read and wrote."""

    run_id: str
    raw_rows: int
    written_rows: int


def run_incremental(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    checkpoint: str,
    timeout: float | None = None,
    again: bool = False,
    across_runs: bool = False,
) -> list[RunMetrics]:
    """Curate all that is new in the raw zone as one run; the list is empty if there is nothing.

    New are complete batches that no run has taken, by their names, and files that no sink
    wrote, by their place.  A run first plans what it takes, then writes, then commits.
    After a failure the list may hold two: the planned run tried again, which takes the
    same and overwrites its own folder, then a new one.  Ids are unique within a run; with
    ``across_runs`` an order whose id an earlier run of the output has is left out, too.  A
    new checkpoint would read all again, so it is refused on an output that
    has runs, unless ``again`` asks for that.
    """
    require_utc(spark)
    if not again:
        refuse_foreign(spark, out_path, checkpoint)
    if path_exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{checkpoint} was made by a stream; it does not know batches")
    if not path_exists(spark, raw_path):
        return []
    done = []
    with time_limit(spark, timeout):
        put_once(spark, f"{checkpoint}/identity", uuid.uuid4().hex)
        open_runs = [n for n in _planned(spark, checkpoint) if n not in _committed(spark, checkpoint)]
        for number in open_runs:
            done += _run(spark, out_path, checkpoint, number, across_runs)
        number = _plan(spark, raw_path, checkpoint)
        if number is not None:
            done += _run(spark, out_path, checkpoint, number, across_runs)
    return done


def read_runs(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``run_id``, ``raw_rows`` and ``written_rows`` of all runs of a checkpoint."""
    if not path_exists(spark, f"{checkpoint}/commits"):
        return spark.createDataFrame([], RUN_COUNTS)
    return spark.read.schema(RUN_COUNTS).json(f"{checkpoint}/commits")


def taken(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``path`` and ``name`` of all that committed runs have taken."""
    plans = [f"{checkpoint}/plans/{_name(n)}" for n in sorted(_committed(spark, checkpoint))]
    if not plans:
        return spark.createDataFrame([], _PLAN)
    return spark.read.schema(_PLAN).parquet(*plans)


def _name(number: int) -> str:
    return f"{number:08d}"


def _planned(spark: SparkSession, checkpoint: str) -> list[int]:
    names = folder_names(spark, f"{checkpoint}/plans")
    return [int(n) for n in names if path_exists(spark, f"{checkpoint}/plans/{n}/_SUCCESS")]


def _committed(spark: SparkSession, checkpoint: str) -> set[int]:
    return {int(name) for name in folder_names(spark, f"{checkpoint}/commits")}


def _plan(spark: SparkSession, raw_path: str, checkpoint: str) -> int | None:
    """Write down what the next run takes; None if there is nothing."""
    planned = _planned(spark, checkpoint)
    found = files_handed_over(spark, raw_path)
    if planned:
        plans = [f"{checkpoint}/plans/{_name(n)}" for n in planned]
        seen = spark.read.schema(_PLAN).parquet(*plans).select("name").distinct()
        found = found.join(seen, "name", "left_anti")
    number = max(planned, default=-1) + 1
    folder = f"{checkpoint}/plans/{_name(number)}"
    # A row for each new file: the sinks write few a batch.
    new = found.select("path", "name").coalesce(1)
    new.write.mode("overwrite").parquet(folder)
    if spark.read.schema(_PLAN).parquet(folder).isEmpty():
        return None
    return number


def _run(
    spark: SparkSession, out_path: str, checkpoint: str, number: int, across_runs: bool
) -> list[RunMetrics]:
    plan = spark.read.schema(_PLAN).parquet(f"{checkpoint}/plans/{_name(number)}")
    files = [row["path"] for row in plan.toLocalIterator()]
    run_id = f"{read_text(spark, f'{checkpoint}/identity')}-{number}"
    counts = RunMetrics(run_id, 0, 0)
    if files:
        seen = Observation()
        raw = read_files(spark, files).observe(seen, F.count(F.lit(1)).alias("rows"))
        orders = curate_orders(raw)
        if across_runs:
            # Looked at twice, for their ids and to be written, so they are kept meanwhile.
            staged = f"{checkpoint}/staged"
            orders.write.mode("overwrite").parquet(f"{staged}/orders")
            kept = spark.read.schema(orders.schema).parquet(f"{staged}/orders")
            new = drop_known(spark, kept, out_path, run_id, f"{staged}/hits")
            write_processed(new, out_path, run_id)
            write_filter(spark, out_path, run_id)
            remove(spark, staged)
        else:
            write_processed(orders, out_path, run_id)
        # Counting the files reads footers only, and stays right if tasks ran twice.
        written = spark.read.schema(PROCESSED).parquet(run_path(out_path, run_id)).count()
        counts = RunMetrics(run_id, seen.get["rows"], written)
    put_once(spark, f"{checkpoint}/commits/{_name(number)}", json.dumps(asdict(counts)) + "\n")
    # A run without a row that is new leaves nothing to register.
    return [counts] if counts.written_rows else []

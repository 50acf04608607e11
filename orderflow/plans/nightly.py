"""The nightly run: curate what is new, then refresh the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow.constants import DATABASE, TABLE
from orderflow.sources.catalog import register_processed, unregistered_runs
from orderflow.streaming.incremental import RunMetrics, run_incremental


def nightly_run(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    checkpoint: str,
    database: str = DATABASE,
    table: str = TABLE,
    database_path: str | None = None,
    timeout: float | None = None,
    across_runs: bool = False,
) -> tuple[list[RunMetrics], DataFrame]:
    """The runs made and the registered table.

    A run that fails raises its error, and the table stays as it was.  If an earlier
    night ended between its run and its refresh, or during that, this night makes up
    for it, with new files or without.
    """
    runs = run_incremental(spark, raw_path, out_path, checkpoint, timeout, across_runs=across_runs)
    # What this night wrote is added, and what the table lacks of earlier nights, by its log.
    # All runs are listed only after a night that wrote nothing, or if there is no table.
    new = unregistered_runs(spark, out_path, database, table) if runs else None
    if new is not None:
        new = sorted({*new, *(run.run_id for run in runs)})
    return runs, register_processed(spark, out_path, database, table, database_path, new)

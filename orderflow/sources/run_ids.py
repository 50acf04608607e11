"""Which ids earlier runs have: a Bloom filter beside each run, then its ids themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.bloom import block_count, build_filter, may_contain
from orderflow.session import path_exists
from orderflow.sources.processed import RUN, merges, read_merges, run_folder, run_path
from orderflow.sources.records import folder_names

KEY = "order_id"
_IDS = f"{KEY} string"
_FILTER = f"blocks bigint, block bigint, bits binary, {RUN} string"


def _filters(path: str) -> str:
    return f"{path}/_ids"


def _filter_path(path: str, run_id: str) -> str:
    return f"{_filters(path)}/{RUN}={run_id}"


def write_filter(spark: SparkSession, path: str, run_id: str) -> None:
    """Make the filter of a run from its files, in place of an earlier one."""
    folder = run_path(path, run_id)
    if not _has_rows(spark, folder):
        return
    ids = spark.read.schema(_IDS).parquet(folder)
    # Footers tell how many there are.
    made = build_filter(ids, KEY, block_count(ids.count()))
    made.write.mode("overwrite").parquet(_filter_path(path, run_id))


def _has_rows(spark: SparkSession, folder: str) -> bool:
    return any("=" in name for name in folder_names(spark, folder))


def earlier_runs(spark: SparkSession, path: str, run_id: str) -> list[str]:
    """The zone's other runs."""
    names = folder_names(spark, path)
    runs = [name.partition("=")[2] for name in names if name.startswith(f"{RUN}=")]
    return [run for run in runs if run != run_id]


def hits(spark: SparkSession, orders: DataFrame, path: str, run_id: str) -> DataFrame:
    """``order_id`` and the earlier ``run_id`` whose filter may have it.

    Runs without a filter, as older ones are, get theirs first.
    """
    runs = [r for r in earlier_runs(spark, path, run_id) if _has_rows(spark, run_path(path, r))]
    for run in runs:
        if not path_exists(spark, f"{_filter_path(path, run)}/_SUCCESS"):
            write_filter(spark, path, run)
    if not path_exists(spark, _filters(path)):
        return spark.createDataFrame([], f"{KEY} string, {RUN} string")
    filters = spark.read.schema(_FILTER).parquet(_filters(path)).where(F.col(RUN) != run_id)
    # Powers of two: a few, however many runs there are.
    sizes = [row["blocks"] for row in filters.select("blocks").distinct().collect()]
    if not sizes:
        return spark.createDataFrame([], f"{KEY} string, {RUN} string")
    return may_contain(orders.select(KEY), KEY, filters, sizes)


def folders_of(spark: SparkSession, path: str, runs: list[str]) -> list[str]:
    """Where the ids of these runs are; what was merged may be in any merged folder."""
    folders = [run_path(path, run) for run in runs if _has_rows(spark, run_path(path, run))]
    moved = read_merges(spark, path).where(F.col(RUN).isin(runs or [""]))
    if not moved.isEmpty():
        folders += [run_folder(spark, path, f"merged-{n}") for n in merges(spark, path)]
    return [folder for folder in folders if _has_rows(spark, folder)]


def drop_known(
    spark: SparkSession, orders: DataFrame, path: str, run_id: str, staged: str
) -> DataFrame:
    """The orders whose id no earlier run has; those without an id stay.

    Only runs whose filter has a hit are read, and only their ids, to tell true hits from
    false ones.  The hits are kept in the folder ``staged`` until the result is written.
    """
    hits(spark, orders, path, run_id).write.mode("overwrite").parquet(staged)
    found = spark.read.schema(f"{KEY} string, {RUN} string").parquet(staged)
    runs = [row[RUN] for row in found.select(RUN).distinct().collect()]
    folders = folders_of(spark, path, runs)
    if not folders:
        return orders
    stored = spark.read.schema(_IDS).option("recursiveFileLookup", "true").parquet(*folders)
    known = stored.join(found.select(KEY).distinct(), KEY, "left_semi").distinct()
    return orders.join(known, KEY, "left_anti")

"""Register the processed zone as a table, and merge its runs.

The files are partitioned by run first.  They are the table ``<table>_files``; ``<table>``
is a view on it.  Once runs are merged, the view moves to a new table of files,
``<table>_files_<n>``; that is one statement, so readers see the old files or the new.
What is registered is known from a log with a record for each run, beside the files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.constants import DATABASE, TABLE
from orderflow.schema import PROCESSED, PROCESSED_PARTITIONS
from orderflow.sources.processed import (
    MERGED,
    RUN,
    merges,
    read_merges,
    replaced_partitions,
    run_folder,
)
from orderflow.sources.records import folder_names, put_once, qualified, remove

# How a partition without a value is written, and partitions added by one statement.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_AT_ONCE = 500
# Properties: of a table of files, its log; of the view, the table of files that it shows.
_LOG = "orderflow.log"
_FILES = "orderflow.files"
_PARTITION = "struct<order_date: string, category: string, location: string>"
_REGISTERED = f"{RUN} string, partitions array<{_PARTITION}>"


def _quoted(*names: str) -> str:
    return ".".join("`" + name.replace("`", "``") + "`" for name in names)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _existing(spark: SparkSession, files: str) -> tuple[str, list[str]] | None:
    """Location and columns of the table, if it is there."""
    if not spark.catalog.tableExists(files):
        return None
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {files}").collect()
    location = next(row["data_type"] for row in detail if row["col_name"] == "Location")
    return location, spark.table(files).columns


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def files_table(spark: SparkSession, database: str = DATABASE, table: str = TABLE) -> str:
    """The name of the table of files that the view shows."""
    view = _quoted(database, table)
    if not spark.catalog.tableExists(view):
        return f"{table}_files"
    return _properties(spark, view).get(_FILES, f"{table}_files")


def _log(spark: SparkSession, files: str, path: str) -> str | None:
    """The folder of a table's log; a table that was made without one has none."""
    name = _properties(spark, files).get(_LOG)
    return None if name is None else f"{path}/_registered/{name}"


def registered_runs(
    spark: SparkSession, path: str, database: str = DATABASE, table: str = TABLE
) -> DataFrame:
    """A row for each registered run: ``run_id`` and its ``partitions``."""
    files = _quoted(database, files_table(spark, database, table))
    log = _log(spark, files, path) if spark.catalog.tableExists(files) else None
    if log is None or not folder_names(spark, log):
        return spark.createDataFrame([], _REGISTERED)
    return spark.read.schema(_REGISTERED).json(log)


def _add_columns(spark: SparkSession, files: str, path: str, runs: Sequence[str]) -> None:
    """Give the table the columns that files of these runs have and it lacks."""
    for run_id in runs:
        folder = run_folder(spark, path, run_id)
        if not _has_files(spark, folder):
            continue
        known = {name.lower() for name in spark.table(files).columns}
        new = [f for f in spark.read.parquet(folder).schema.fields if f.name.lower() not in known]
        if new:
            columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE {files} ADD COLUMNS ({columns})")


def _partitions(spark: SparkSession, path: str, run_id: str) -> list[dict]:
    """A run's partitions that no later merge has replaced."""
    folder, found = run_folder(spark, path, run_id), []
    gone = replaced_partitions(spark, path, run_id)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/order_date=*/category=*")
    for status in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []:
        place = status.getPath()
        names = (place.getParent().getName(), place.getName())
        values = [unquote(name.partition("=")[2]) for name in names]
        day, category = (None if value == _NO_VALUE else value for value in values)
        if (day, category) not in gone:
            found.append({"order_date": day, "category": category, "location": place.toString()})
    return found


def _attach(spark: SparkSession, files: str, run_id: str, partitions: list[dict]) -> None:
    specs = []
    for one in partitions:
        day, category = (
            "NULL" if one[name] is None else _text(one[name]) for name in PROCESSED_PARTITIONS
        )
        specs.append(
            f"PARTITION ({RUN} = {_text(run_id)}, order_date = {day}, category = {category})"
            f" LOCATION {_text(one['location'])}"
        )
    for k in range(0, len(specs), _AT_ONCE):
        part = " ".join(specs[k : k + _AT_ONCE])
        spark.sql(f"ALTER TABLE {files} ADD IF NOT EXISTS {part}")


def _add_partitions(
    spark: SparkSession, files: str, path: str, runs: Sequence[str]
) -> list[list[dict]]:
    """Add the partitions of these runs, without a look at others; gives them by run."""
    found = [_partitions(spark, path, run_id) for run_id in runs]
    for run_id, partitions in zip(runs, found, strict=True):
        _attach(spark, files, run_id, partitions)
    return found


def _take_in(spark: SparkSession, files: str, path: str, runs: Sequence[str]) -> None:
    """Add runs and record each after its last partition: one half added is added again."""
    log = _log(spark, files, path)
    for run_id in runs:
        (partitions,) = _add_partitions(spark, files, path, [run_id])
        if log is not None:
            record = {RUN: run_id, "partitions": partitions}
            put_once(spark, f"{log}/{run_id}", json.dumps(record) + "\n")


def _create_files(
    spark: SparkSession, database: str, name: str, path: str, columns: Sequence | None = None
) -> str:
    """A table of files without a partition, unless it is there; with a log of its own."""
    files = _quoted(database, name)
    fields = PROCESSED.fields if columns is None else columns
    shown = ", ".join(
        f"{_quoted(field.name)} {field.dataType.simpleString()}" for field in fields
    )
    partitions = ", ".join([RUN, *PROCESSED_PARTITIONS])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {files} ({shown}, {RUN} string) USING parquet"
        f" PARTITIONED BY ({partitions}) LOCATION {_text(path)}"
        f" TBLPROPERTIES ({_text(_LOG)} = {_text(uuid.uuid4().hex)})"
    )
    return files


def _show(spark: SparkSession, database: str, table: str, name: str) -> DataFrame:
    """Let the view show this table of files."""
    files, view = _quoted(database, name), _quoted(database, table)
    spark.catalog.refreshTable(files)
    known = PROCESSED.fieldNames()
    extra = [c for c in spark.table(files).columns if c not in (*known, RUN)]
    shown = ", ".join(_quoted(c) for c in [*known, *extra])
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ({_text(_FILES)} = {_text(name)})"
        f" AS SELECT {shown} FROM {files}"
    )
    return spark.table(view)


def register_processed(
    spark: SparkSession,
    path: str,
    database: str = DATABASE,
    table: str = TABLE,
    database_path: str | None = None,
    runs: Sequence[str] | None = None,
) -> DataFrame:
    """Create or refresh ``database.table`` over the processed zone.

    Filters on ``order_date`` and ``category`` pass through the view and prune partitions.

    ``runs`` names the runs to take in; without it the whole zone is listed, which is
    what repairs need.  Columns that these runs have and the table lacks are added to
    both; older runs have null there.  A table that stands for another path is refused.
    """
    location = f" LOCATION {_text(database_path)}" if database_path else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}{location}")
    name = files_table(spark, database, table)
    files = _quoted(database, name)
    found = _existing(spark, files)
    if found is not None and found[0] != qualified(spark, path):
        raise ValueError(f"{database}.{table} stands for {found[0]}, not for {path}")
    _create_files(spark, database, name, path)
    runs = all_runs(spark, path) if runs is None else runs
    _add_columns(spark, files, path, runs)
    _take_in(spark, files, path, runs)
    return _show(spark, database, table, name)


def unregistered_runs(
    spark: SparkSession, path: str, database: str = DATABASE, table: str = TABLE
) -> list[str] | None:
    """Runs of the zone that the table's log lacks; None if there is no table."""
    files = _quoted(database, files_table(spark, database, table))
    if not spark.catalog.tableExists(files):
        return None
    log = _log(spark, files, path)
    known = set() if log is None else set(folder_names(spark, log))
    return [run for run in all_runs(spark, path) if run not in known]


def compact_runs(
    spark: SparkSession, path: str, database: str = DATABASE, table: str = TABLE
) -> DataFrame:
    """Merge the runs of each day and category into one folder; gives the table.

    Afterwards the table has one partition for each day and category.  Rows are written
    to a run of their own, hidden from who reads the zone, and a new table of files is made
    of them and of the partitions that stay.  Then a record of the merge moves readers of
    the zone (``read_processed``) to it, and the view readers of the table.  What was read
    before stays as it is until :func:`remove_replaced`.  A merge that ended half way is
    ended or made again by the next.  Not while a nightly run is under way.
    """
    number = max(merges(spark, path), default=0)
    if number and files_table(spark, database, table) != _generation(table, number):
        _move(spark, path, database, table, number)
    merged_id = f"merged-{number + 1}"
    files = _quoted(database, files_table(spark, database, table))
    days = list(PROCESSED_PARTITIONS)
    log = registered_runs(spark, path, database, table).select(
        RUN, F.explode("partitions").alias("p")
    )
    every = log.select(RUN, *[f"p.{name}" for name in days])
    several = every.groupBy(*days).agg(F.count("*").alias("runs")).where(F.col("runs") > 1)
    several = several.select(*days).persist()
    try:
        if several.isEmpty():
            return spark.table(_quoted(database, table))
        rows, pick = spark.table(files).alias("r"), several.alias("s")
        same = F.col("r.order_date").eqNullSafe(F.col("s.order_date").cast("date"))
        same = same & F.col("r.category").eqNullSafe(F.col("s.category"))
        (
            rows.join(pick, same, "left_semi")
            .drop(RUN)
            .hint("rebalance", *days)
            .write.mode("overwrite")
            .partitionBy(*days)
            .option("compression", "snappy")
            .parquet(f"{path}/{MERGED}/{RUN}={merged_id}")
        )
        # A row for each partition that is replaced; the catalog holds as many.
        e = every.alias("e")
        same = F.col("e.order_date").eqNullSafe(F.col("s.order_date"))
        same = same & F.col("e.category").eqNullSafe(F.col("s.category"))
        gone = e.join(pick, same, "left_semi").toLocalIterator()
        record = {"merged": merged_id, "replaced": [row.asDict() for row in gone]}
    finally:
        several.unpersist()
    put_once(spark, f"{path}/{MERGED}/_log/{number + 1}", json.dumps(record) + "\n")
    return _move(spark, path, database, table, number + 1)


def _generation(table: str, number: int) -> str:
    return f"{table}_files_{number}"


def _move(spark: SparkSession, path: str, database: str, table: str, number: int) -> DataFrame:
    """Make the table of files after this merge, and let the view show it."""
    old = _quoted(database, files_table(spark, database, table))
    name = _generation(table, number)
    columns = [field for field in spark.table(old).schema.fields if field.name != RUN]
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(database, name)}")
    files = _create_files(spark, database, name, path, columns)
    _take_in(spark, files, path, all_runs(spark, path))
    return _show(spark, database, table, name)


def remove_replaced(
    spark: SparkSession, path: str, database: str = DATABASE, table: str = TABLE
) -> None:
    """Delete what merges have replaced, files and tables of files.

    Whoever still reads from before the last merge loses them, so wait for them first.
    """
    shown = files_table(spark, database, table)
    for number in range(max(merges(spark, path), default=0)):
        old = f"{table}_files" if number == 0 else _generation(table, number)
        if old != shown:
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(database, old)}")
    for row in read_merges(spark, path).toLocalIterator():
        names = [
            f"{name}={_NO_VALUE if row[name] is None else _escaped(spark, row[name])}"
            for name in PROCESSED_PARTITIONS
        ]
        remove(spark, "/".join([run_folder(spark, path, row[RUN]), *names]))


def _escaped(spark: SparkSession, value: str) -> str:
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.escapePathName(value)


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return sorted(status.getPath().getName() for status in found or [])


def all_runs(spark: SparkSession, path: str) -> list[str]:
    """The runs of the zone and those that they were merged into."""
    folders = [
        *_folders(spark, f"{path}/{RUN}=*"),
        *(f"{RUN}=merged-{number}" for number in merges(spark, path)),
    ]
    return [name.partition("=")[2] for name in folders]


def _has_files(spark: SparkSession, folder: str) -> bool:
    """Whether a run has a partition: one without a row has none, nor one that was merged."""
    return bool(_folders(spark, folder + "".join(f"/{name}=*" for name in PROCESSED_PARTITIONS)))


def list_partitions(orders: DataFrame) -> DataFrame:
    """Orders by (order_date, category), over all runs."""
    return orders.groupBy(*PROCESSED_PARTITIONS).agg(F.count(F.lit(1)).alias("n"))

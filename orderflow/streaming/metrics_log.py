"""Live counters as a log of totals: the newest total of a key is its value.

Below the log's folder, ``kind=changes/batch_id=N`` holds the totals that batch N
changed and ``kind=snapshot/batch_id=N`` all totals as of batch N.  Readers need
not tell them apart, and folders older than a snapshot can go at any time.  A snapshot is
in the order of its keys, with a note of the keys that each of its files reaches over, so a
lookup opens the files that may have its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderflow.constants import CATEGORY_PREFIX, DATE_PREFIX
from orderflow.operators.live import latest_metrics, select_metrics
from orderflow.schema import METRICS
from orderflow.session import ADAPTIVE, conf_scope, path_exists
from orderflow.streaming.runs import refuse_foreign, start

CHANGES = "changes"
SNAPSHOT = "snapshot"
SNAPSHOT_EVERY = 1000
LOG_FILES = 4

KEYS = ("pk", "sk")
_BOUNDS = "file string, low struct<pk: string, sk: string>, high struct<pk: string, sk: string>"
_LOG = T.StructType([*METRICS.fields, T.StructField("batch_id", T.LongType())])


def _folder(path: str, kind: str, batch_id: int) -> str:
    return f"{path}/kind={kind}/batch_id={batch_id}"


def _write(totals: DataFrame, folder: str) -> None:
    """Few files, however many tasks hold the state: totals are small."""
    rows = totals.select(*METRICS.fieldNames()).repartition(LOG_FILES)
    rows.write.mode("overwrite").parquet(folder)


def _write_snapshot(totals: DataFrame, folder: str) -> None:
    """In the order of the keys, in as many files as the size asks for."""
    spark = totals.sparkSession
    with conf_scope(spark, ADAPTIVE):
        rows = totals.select(*METRICS.fieldNames()).repartitionByRange(*KEYS)
        rows.sortWithinPartitions(*KEYS).write.mode("overwrite").parquet(folder)
    # A row for each file.
    stored = spark.read.schema(METRICS).parquet(folder)
    key = F.struct(*KEYS)
    bounds = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high")
    )
    bounds.coalesce(1).write.mode("overwrite").json(_bounds(folder))


def _bounds(folder: str) -> str:
    return f"{folder}/_bounds"


def _parts(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Folders of the newest snapshot, one or none, and of the changes since."""
    snapshots, changes = (_numbers(spark, f"{path}/kind={kind}") for kind in (SNAPSHOT, CHANGES))
    newest = max(snapshots, default=-1)
    later = [_folder(path, CHANGES, n) for n in changes if n > newest]
    return [_folder(path, SNAPSHOT, newest)] if snapshots else [], later


def _totals(spark: SparkSession, path: str, places: list[str]) -> DataFrame:
    if not places:
        return latest_metrics(spark.createDataFrame([], _LOG))
    return latest_metrics(spark.read.schema(_LOG).option("basePath", path).parquet(*places))


def read_live_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The current count and revenue of every (category, day).

    Reads the newest snapshot and the changes since.
    """
    snapshot, changes = _parts(spark, path)
    return _totals(spark, path, [*snapshot, *changes])


def _files_with(
    spark: SparkSession, folder: str, pk: str, low: str | None, high: str | None
) -> list[str]:
    """The files of a snapshot whose keys reach over some of the keys asked for."""
    if not path_exists(spark, f"{_bounds(folder)}/_SUCCESS"):
        return [folder]
    after = F.col("high.pk") > pk
    before = F.col("low.pk") < pk
    reaches_low = F.lit(True) if low is None else F.col("high.sk") >= low
    reaches_high = F.lit(True) if high is None else F.col("low.sk") <= high
    fits = (after | ((F.col("high.pk") == pk) & reaches_low)) & (
        before | ((F.col("low.pk") == pk) & reaches_high)
    )
    rows = spark.read.schema(_BOUNDS).json(_bounds(folder)).where(fits).select("file").collect()
    return [f"{folder}/{row['file']}" for row in rows]


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Batch numbers whose folders are complete."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch_id=*/_SUCCESS")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(path) or []
    return sorted(int(f.getPath().getParent().getName().partition("=")[2]) for f in found)


def metrics_lookup(
    spark: SparkSession,
    path: str,
    category: str,
    day_from: str | None = None,
    day_to: str | None = None,
) -> DataFrame:
    """One category's counters, for a day or a range of days.

    Of the snapshot, files without the category or the days are not opened; in those that
    are, the filters skip what they can by the bounds of its pages.
    """
    snapshot, changes = _parts(spark, path)
    ends = [None if day is None else DATE_PREFIX + day for day in (day_from, day_to)]
    files = [
        file
        for folder in snapshot
        for file in _files_with(spark, folder, CATEGORY_PREFIX + category, *ends)
    ]
    found = _totals(spark, path, [*files, *changes])
    return select_metrics(found, category, day_from, day_to)


def compact_live_metrics(
    spark: SparkSession, path: str, batch_id: int, keep_from: int
) -> None:
    """Write all totals as of ``batch_id`` and drop the folders before ``keep_from``.

    Keep the folders back to the previous snapshot: readers may be on them.
    """
    _write_snapshot(read_live_metrics(spark, path), _folder(path, SNAPSHOT, batch_id))

    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for kind in (CHANGES, SNAPSHOT):
        for status in files.listStatus(hadoop(f"{path}/kind={kind}")):
            folder = status.getPath()
            name, _, number = folder.getName().partition("=")
            if name == "batch_id" and int(number) < keep_from:
                files.delete(folder, True)


def write_live_metrics(
    metrics: DataFrame,
    path: str,
    checkpoint: str,
    state_partitions: int | None = None,
    snapshot_every: int = SNAPSHOT_EVERY,
    available_now: bool = False,
) -> StreamingQuery:
    """Write the new totals of the keys each batch changed.

    Totals are absolute and a batch replaces its own folder, so a batch that is
    tried again changes nothing.  State holds one row per category and day;
    ``state_partitions`` sets how many tasks share it (fixed at the first start).
    Every ``snapshot_every`` batches the log is compacted.
    """

    def put(changed: DataFrame, batch_id: int) -> None:
        _write(changed, _folder(path, CHANGES, batch_id))
        if batch_id > 0 and batch_id % snapshot_every == 0:
            session = changed.sparkSession
            compact_live_metrics(session, path, batch_id, batch_id - snapshot_every)

    refuse_foreign(metrics.sparkSession, f"{path}/kind={CHANGES}", checkpoint)
    settings = {}
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    with conf_scope(metrics.sparkSession, settings):
        writer = metrics.writeStream.outputMode("update").foreachBatch(put)
        return start(writer, checkpoint, available_now)

"""The log of a folder's complete batches, by which they are handed over.

A sink writes a batch below ``batch=<name>`` and then its name into ``_batches``.  A batch
whose name is there never changes again: tried once more, it is left as it is.  Whoever
reads on by batch names so takes every batch once, whole, whatever its files are called.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.constants import ANY_AGE
from orderflow.session import path_exists
from orderflow.sources.records import make_folder, put_once, remove

BATCH = "batch"
_LOG = "_batches"
_SCHEMA = f"{BATCH} string"


def log_path(path: str) -> str:
    return f"{path}/{_LOG}"


def is_complete(spark: SparkSession, path: str, name: str) -> bool:
    return path_exists(spark, f"{log_path(path)}/{name}")


def complete(spark: SparkSession, path: str, name: str) -> None:
    """Say that all files of a batch are written."""
    put_once(spark, f"{log_path(path)}/{name}", json.dumps({BATCH: name}) + "\n")


def complete_batches(spark: SparkSession, path: str) -> DataFrame:
    """The names of all complete batches, as column ``batch``."""
    if not path_exists(spark, log_path(path)):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).json(log_path(path))


def stream_batches(spark: SparkSession, path: str) -> DataFrame:
    """The names of batches as a stream, each once; the folder may be empty yet."""
    make_folder(spark, log_path(path))
    return spark.readStream.schema(_SCHEMA).option("maxFileAge", ANY_AGE).json(log_path(path))


def batch_of(path: Column) -> Column:
    """The batch that a sink's file belongs to; null for files from elsewhere."""
    name = F.regexp_extract(path, f"/{BATCH}=([^/]+)/part-[^/]*$", 1)
    return F.when(name != "", name)


def all_files(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``name``, ``batch`` and ``complete`` of all files, at any depth.

    ``name`` is what a file is handed over by: its batch, or its own place for files that
    no sink of ours wrote, which count as complete.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # Listing reads no file.
    files = files.select("path", batch_of(F.col("path")).alias(BATCH))
    done = complete_batches(spark, path).distinct().withColumn("logged", F.lit(True))
    place = F.regexp_replace("path", "^[a-zA-Z0-9+.-]+:(//[^/]*)?", "")
    return files.join(done, BATCH, "left").select(
        "path",
        F.coalesce(BATCH, place).alias("name"),
        BATCH,
        (F.col(BATCH).isNull() | F.col("logged").isNotNull()).alias("complete"),
    )


def files_handed_over(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``name`` of the files that are complete.

    Files of a batch that is still being written, or was left half written, are not.
    """
    return all_files(spark, path).where("complete").select("path", "name")


def forget(spark: SparkSession, path: str) -> None:
    """Drop batches without a file from the log; only while no sink writes there.

    Curation keeps the names of what it took, so none is taken again.
    """
    there = all_files(spark, path).where(F.col(BATCH).isNotNull()).select(BATCH)
    gone = complete_batches(spark, path).join(there.distinct(), BATCH, "left_anti")
    for row in gone.toLocalIterator():
        remove(spark, f"{log_path(path)}/{row[BATCH]}")


def adopt_batches(spark: SparkSession, path: str) -> None:
    """Take all batches of a folder for complete, as one written without a log needs it.

    Only while no sink writes there.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    names = files.select(batch_of(F.col("path")).alias(BATCH)).distinct()
    for row in names.where(F.col(BATCH).isNotNull()).toLocalIterator():
        complete(spark, path, row[BATCH])

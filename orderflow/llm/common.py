"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.session import shared_dir

# Texts are handled in blocks of about this many bytes, whose arrays stay in the processor's
# caches; only a longer text makes a larger one.
BLOCK_BYTES = 1 << 17
ROWS_PER_BATCH = 1000


def long_rows(spark: SparkSession) -> None:
    """Send texts to Python in batches of a thousand rows at most, not Spark's 10,000:
    that bounds what a task holds."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS_PER_BATCH:
        spark.conf.set(name, ROWS_PER_BATCH)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    long_rows(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(frame: DataFrame, label: str, narrow: bool = False) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage, survives lost executors.

    A ``narrow`` table, of ids and the like, is written by a few tasks for each core:
    its rows cost less than a task does, and the next step opens fewer files.
    """
    if narrow:
        frame = frame.coalesce(4 * frame.sparkSession.sparkContext.defaultParallelism)
    path = shared_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``hash`` of the text and ``text``, without any other column.

    ``doc_id`` and ``hash`` identify a text even where ids repeat or are null.
    """
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("hash"),
        F.col("text").cast("string").alias("text"),
    )


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """These names, longer by underscores where the frame has a column of that name."""
    taken, free = {name.lower() for name in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def in_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text has this remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus == remainder


def text_blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of rows with about ``limit`` bytes of text.

    Gives the rows, their texts' UTF-8 bytes end to end, and where each text
    begins (and the last ends).  Null texts are empty.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        array = batch.column(column)
        array = array.cast(pa.large_binary())
        _, offsets, data = array.buffers()
        bounds = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        row = 0
        while row < len(array):
            end = int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1
            end = min(max(end, row + 1), len(array))
            cut = bounds[row : end + 1]
            yield batch.slice(row, end - row), data[cut[0] : cut[-1]], cut - cut[0]
            row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values: an invertible mixing function."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))

"""Start streaming queries and wait for them."""

from __future__ import annotations

import contextlib
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from orderflow.constants import MICRO_BATCH_SECONDS
from orderflow.session import path_exists
from orderflow.sources.records import folder_names


def start(writer: DataStreamWriter, checkpoint: str, available_now: bool) -> StreamingQuery:
    """Run until stopped, or over what is available now and then end."""
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{MICRO_BATCH_SECONDS} seconds").start()


def drain(writer: DataStreamWriter, checkpoint: str) -> None:
    """Run over all there is, in as many batches as the source makes of it, and stop.

    For sources that bound a batch by records; those of files can end by themselves.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def refuse_foreign(spark: SparkSession, output: str, checkpoint: str) -> None:
    """Raise if ``output`` was written by a stream with another checkpoint.

    A new checkpoint starts over with batch 0, and a sink that goes by batch
    numbers would take its first batches for ones it already has.  A folder that
    holds nothing but its log of batches was written by none.
    """
    if folder_names(spark, output) and not path_exists(spark, checkpoint):
        raise ValueError(f"{output} belongs to another checkpoint than {checkpoint}")


def finish(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait for a query that ends by itself; a failed query raises its error."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} ran over {timeout} s")
    return query


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """A name for a ``foreachBatch`` batch: its checkpoint's identity and its number.

    A batch tried again gets the same name; another checkpoint never does.
    """
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{stream}-{batch_id}"


@contextlib.contextmanager
def time_limit(spark: SparkSession, seconds: float | None) -> Iterator[None]:
    """Cancel the block's Spark jobs after so many seconds and raise ``TimeoutError``."""
    if seconds is None:
        yield
        return
    context, group, late = spark.sparkContext, uuid.uuid4().hex, threading.Event()

    def end() -> None:
        late.set()
        # Those that start later, too: a run is many jobs, with pauses between them.
        context._jsc.sc().cancelJobGroupAndFutureJobs(group)

    timer = threading.Timer(seconds, end)
    context.setJobGroup(group, "limited in time", interruptOnCancel=True)
    timer.start()
    try:
        yield
    except Exception as error:
        if late.is_set():
            raise TimeoutError(f"jobs ran over {seconds} s") from error
        raise
    finally:
        timer.cancel()
        context.setLocalProperty("spark.jobGroup.id", None)

"""The order stream, from files or from Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.constants import ANY_AGE
from orderflow.schema import ENVELOPE


def read_order_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Envelopes from JSON files that arrive below ``path``, whatever their age.

    ``max_files`` bounds a micro-batch; without it a batch takes all that is new.
    Files that a batch has read move to ``archive``, if given: that bounds what
    later batches list.
    """
    reader = spark.readStream.schema(ENVELOPE).option("maxFileAge", ANY_AGE)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def read_kafka_stream(
    spark: SparkSession, servers: str, topic: str, max_records: int | None = None
) -> DataFrame:
    """Messages of a topic, from its end on.  Needs Spark's Kafka package.

    ``max_records`` bounds a micro-batch over all partitions of the topic.  The
    published bound, ``MICRO_BATCH_RECORDS``, suits a single small consumer only.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
    )
    if max_records is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return reader.load()


def open_messages(messages: DataFrame) -> DataFrame:
    """Kafka messages as opened records: their value is the JSON itself, not base64."""
    payload = F.try_validate_utf8(F.col("value").cast("string"))
    return messages.select(
        F.concat_ws("-", "topic", "partition", "offset").alias("record_id"),
        payload.alias("payload"),
        F.coalesce(payload, F.base64("value")).alias("raw"),
    )

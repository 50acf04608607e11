"""Read the raw zone: one JSON order per line below ``year=/month=/day=``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow.schema import ORDER_EVENT


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """All raw orders as text, with the landing ``year``, ``month`` and ``day``."""
    return spark.read.schema(ORDER_EVENT).json(path).drop("batch")


def read_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """The raw orders of these files, as text."""
    return spark.read.schema(ORDER_EVENT).json(files)

"""The processed zone: Parquet by run, order date and category.

Merged runs lie in a hidden folder of the zone, with a log of what each merge replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.schema import PROCESSED, PROCESSED_PARTITIONS
from orderflow.session import conf_scope, path_exists
from orderflow.sources.records import folder_names

RUN = "run_id"
MERGED = "_merged"
_MERGE = (
    f"merged string, replaced array<struct<{RUN}: string, order_date: string, category: string>>"
)
_INFER_PARTITION_TYPES = "spark.sql.sources.partitionColumnTypeInference.enabled"


def run_path(path: str, run_id: str) -> str:
    return f"{path}/{RUN}={run_id}"


def merges(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the merges that are done."""
    return sorted(int(name) for name in folder_names(spark, f"{path}/{MERGED}/_log"))


def read_merges(spark: SparkSession, path: str) -> DataFrame:
    """``run_id``, ``order_date`` and ``category`` of the partitions that merges replaced."""
    if not merges(spark, path):
        return spark.createDataFrame([], f"{RUN} string, order_date string, category string")
    log = spark.read.schema(_MERGE).json(f"{path}/{MERGED}/_log")
    return log.select(F.inline("replaced"))


def replaced_partitions(spark: SparkSession, path: str, run_id: str) -> set[tuple]:
    """Day and category of a run's partitions that merges replaced."""
    if not merges(spark, path):
        return set()
    mine = read_merges(spark, path).where(F.col(RUN) == run_id)
    return {(row["order_date"], row["category"]) for row in mine.toLocalIterator()}


def run_folder(spark: SparkSession, path: str, run_id: str) -> str:
    """Where a run's files are; a merged one's are hidden."""
    hidden = f"{path}/{MERGED}/{RUN}={run_id}"
    return hidden if path_exists(spark, hidden) else run_path(path, run_id)


def write_processed(orders: DataFrame, path: str, run_id: str) -> None:
    """Write one run; writing it again replaces it, so a retry adds nothing.

    The hint gathers a partition's rows into few files and splits a partition
    that holds too much for one task.
    """
    (
        orders.hint("rebalance", *PROCESSED_PARTITIONS)
        .write.mode("overwrite")
        .partitionBy(*PROCESSED_PARTITIONS)
        .option("compression", "snappy")
        .parquet(run_path(path, run_id))
    )


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Every run's orders, merged or not.  The schema is stated, so category ``007`` stays text."""
    schema = T.StructType([*PROCESSED.fields, T.StructField(RUN, T.StringType())])
    orders = spark.read.schema(schema).parquet(path)
    if numbers := merges(spark, path):
        hidden = [f"{path}/{MERGED}/{RUN}=merged-{number}" for number in numbers]
        merged = spark.read.schema(schema).option("basePath", f"{path}/{MERGED}").parquet(*hidden)
        o, gone = orders.unionByName(merged).alias("o"), read_merges(spark, path).alias("g")
        same = F.col(f"o.{RUN}") == F.col(f"g.{RUN}")
        same = same & F.col("o.order_date").eqNullSafe(F.col("g.order_date").cast("date"))
        same = same & F.col("o.category").eqNullSafe(F.col("g.category"))
        orders = o.join(gone, same, "left_anti")
    return orders.select(*PROCESSED.fieldNames())


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """Every run's orders with columns that only some runs have; others hold null.

    Spark reads all file footers to merge their schemas, so this is for looking
    at a changed layout; reports use :func:`read_processed`.
    """
    with conf_scope(spark, {_INFER_PARTITION_TYPES: "false"}):
        merged = spark.read.option("mergeSchema", "true").parquet(path)
    known = PROCESSED.fieldNames()
    extra = [name for name in merged.columns if name not in known and name != RUN]
    return merged.withColumn("order_date", F.col("order_date").cast("date")).select(*known, *extra)

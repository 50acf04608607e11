"""Session checks and the shared folder for scratch tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

TIME_ZONE = "spark.sql.session.timeZone"
SHARED_DIR = "spark.checkpoint.dir"


def engine_session(
    master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with what the engine relies on; ``settings`` come last.

    AQE sizes shuffles, splits skewed joins and skewed writes while a query runs.
    """
    builder = (
        SparkSession.builder.appName("orderflow")
        .config(TIME_ZONE, "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Set the session zone to UTC: order_date and order_hour depend on it."""
    spark.conf.set(TIME_ZONE, "UTC")
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get(TIME_ZONE)
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        raise ValueError(f"{TIME_ZONE} is {zone!r}; order dates and hours need UTC")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder:
    on a cluster, executors could not see one.
    """
    base = spark.conf.get(SHARED_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {SHARED_DIR} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="orderflow-")
    return f"{base.rstrip('/')}/orderflow/{label}-{uuid.uuid4().hex}"


# Inside a stream Spark turns its adaptive planning off; what a batch writes can have it.
ADAPTIVE = {"spark.sql.adaptive.enabled": "true"}


def path_exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


@contextlib.contextmanager
def conf_scope(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply runtime settings for the block; a stream keeps those it started with."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)

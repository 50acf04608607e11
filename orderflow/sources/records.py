"""Small records as files of their own: logs of what is complete, written once each."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from orderflow.session import path_exists


def _place(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def put_once(spark: SparkSession, name: str, text: str) -> bool:
    """Write a record whole or not at all; one that is there stays, and False comes back."""
    if path_exists(spark, name):
        return False
    path, files = _place(spark, name)
    draft, _ = _place(spark, f"{path.getParent().toString()}/.{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return files.rename(draft, path)


def read_text(spark: SparkSession, name: str) -> str:
    path, files = _place(spark, name)
    stream = files.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, without hidden files; empty if there is no folder."""
    path, files = _place(spark, folder)
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(name for name in names if not name.startswith((".", "_")))


def make_folder(spark: SparkSession, folder: str) -> None:
    path, files = _place(spark, folder)
    files.mkdirs(path)


def remove(spark: SparkSession, name: str) -> None:
    path, files = _place(spark, name)
    files.delete(path, True)


def qualified(spark: SparkSession, name: str) -> str:
    path, files = _place(spark, name)
    return files.makeQualified(path).toString()

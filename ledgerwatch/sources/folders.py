"""Folders of the shared storage, whatever file system holds them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def exists(spark: SparkSession, folder: str) -> bool:
    system, path = _located(spark, folder)
    return system.exists(path)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names of what lies in a folder; nothing if it is not there."""
    system, path = _located(spark, folder)
    return sorted(status.getPath().getName() for status in system.listStatus(path)) if system.exists(path) else []


def remove(spark: SparkSession, folder: str) -> None:
    system, path = _located(spark, folder)
    system.delete(path, True)

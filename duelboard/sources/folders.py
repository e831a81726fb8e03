"""Names and times in folders of any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists."""
    fs, place = _located(spark, path)
    return bool(fs.exists(place))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    fs, place = _located(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(place)) if fs.exists(place) else []


def modified(spark: SparkSession, path: str) -> int | None:
    """When a file was last written, in milliseconds; None if there is none."""
    fs, place = _located(spark, path)
    return fs.getFileStatus(place).getModificationTime() if fs.exists(place) else None


def remove_path(spark: SparkSession, path: str) -> None:
    fs, place = _located(spark, path)
    fs.delete(place, True)

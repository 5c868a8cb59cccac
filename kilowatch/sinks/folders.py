"""Folders of a file system that Spark reaches; only names pass the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, store = _place(spark, path)
    return store.exists(place)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``, in order; none if it does not exist."""
    place, store = _place(spark, path)
    if not store.exists(place):
        return []
    return sorted(f.getPath().getName() for f in store.listStatus(place) if f.isDirectory())


def has_files(spark: SparkSession, path: str) -> bool:
    place, store = _place(spark, path)
    return any(f.isFile() for f in store.listStatus(place))


def make(spark: SparkSession, path: str) -> None:
    place, store = _place(spark, path)
    store.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    place, store = _place(spark, path)
    store.delete(place, True)

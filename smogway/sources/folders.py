"""Folders and commit markers, through the Hadoop file system that holds the tables."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of the files and folders in `path`, none if it does not exist."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(where))


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file. It is there whole or not at all; one that exists already is an error."""
    system, where = _at(spark, path)
    system.create(where, False).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all that is in it; what does not exist is left alone."""
    system, where = _at(spark, path)
    system.delete(where, True)

"""Intermediate results on shared storage.

A staged frame is an ordinary Parquet table: it cuts lineage, survives lost executors, and is read back
with column pruning. The folder is the one the cluster names in `spark.checkpoint.dir`.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


@functools.cache
def _private_folder() -> str:
    return tempfile.mkdtemp(prefix="smogway-")


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a private one only in local mode, as in tests."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    return _private_folder()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/smogway/{label}-{uuid.uuid4().hex}"


@contextmanager
def comparable_times(spark: SparkSession) -> Iterator[None]:
    """Parquet files written inside have bounds of their times, by which readers skip files and row groups.

    Spark's default way of writing instants, INT96, has none.
    """
    setting = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and continue from the written copy."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with comparable_times(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

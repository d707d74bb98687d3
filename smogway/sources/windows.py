"""A table that holds the last hours of a feed.

Rows are appended to the day on which they were fetched, those without a time to a day of their own. Nothing stored is
ever rewritten: days that have passed out of the window are deleted whole, and readers cut off the edge.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogway.functions.timestamps import TimeLike, time_value, utc_wall_clock
from smogway.operators.filters import in_window, moment
from smogway.settings import DEFAULTS
from smogway.sources.folders import exists, names_in, remove
from smogway.sources.staging import comparable_times

_UNDATED = "undated"


@dataclass(frozen=True)
class Window:
    """Where a window lives, its columns, and which one says when a row was fetched (text or a time)."""

    path: str
    schema: T.StructType
    column: str = "_fetched_at"
    retention_hours: float = DEFAULTS.retention_hours
    tz: str = DEFAULTS.timezone

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("fetch_day", T.StringType()), T.StructField("batch_id", T.LongType())])


def _day(df: DataFrame, window: Window) -> Column:
    """The UTC day, as text that sorts like the day."""
    fetched = moment(df, window.column, window.tz)
    is_clock = isinstance(df.schema[window.column].dataType, T.TimestampNTZType)
    return F.coalesce((fetched if is_clock else utc_wall_clock(fetched)).cast("date").cast("string"), F.lit(_UNDATED))


def append_window(new: DataFrame, window: Window, batch_id: int) -> None:
    """Add rows; the same `batch_id` again replaces what it added before."""
    dated = new.select(*window.schema.fieldNames(), _day(new, window).alias("fetch_day"), F.lit(batch_id).cast("long").alias("batch_id"))
    writer = dated.hint("rebalance", "fetch_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with comparable_times(new.sparkSession):
        writer.partitionBy("fetch_day", "batch_id").parquet(window.path)


def _first_day(empty: DataFrame, window: Window, as_of: TimeLike) -> str:
    """The day on which the window begins."""
    if isinstance(empty.schema[window.column].dataType, T.StringType):
        empty = empty.select(F.lit(None).cast("timestamp").alias(window.column))
    cutoff = time_value(as_of, empty, window.column, window.tz) - timedelta(hours=window.retention_hours)
    return cutoff.date().isoformat()


def read_window(spark: SparkSession, window: Window, as_of: TimeLike) -> DataFrame:
    """The rows inside the window, and the undated ones; reads only the days that it touches."""
    if not exists(spark, window.path):
        raise FileNotFoundError(window.path)
    stored = spark.read.schema(window.stored_schema).parquet(window.path)
    day = F.col("fetch_day")
    recent = stored.where((day == _UNDATED) | (day >= _first_day(stored, window, as_of)))
    return in_window(recent, as_of, window.retention_hours, window.column, window.tz).select(*window.schema.fieldNames())


def expire_window(spark: SparkSession, window: Window, as_of: TimeLike) -> list[str]:
    """Delete the days that lie wholly before the window and return them."""
    first = _first_day(spark.createDataFrame([], window.schema), window, as_of)
    days = [name.split("=", 1)[1] for name in names_in(spark, window.path) if name.startswith("fetch_day=")]
    gone = [day for day in days if day != _UNDATED and day < first]
    for day in gone:
        remove(spark, f"{window.path}/fetch_day={day}")
    return gone


def collect_window(new: DataFrame, window: Window, batch_id: int, as_of: TimeLike) -> list[str]:
    """One round of a collector: add the new rows, expire old days."""
    append_window(new, window, batch_id)
    return expire_window(new.sparkSession, window, as_of)

"""Row filters whose bound is a constant or a fact about another frame."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogway.functions.numbers import nan_to_null
from smogway.functions.timestamps import (
    TimeLike,
    hours,
    is_wall_clock,
    like_column,
    parse_instant,
    prune,
    time_bucket,
    time_literal,
    time_value,
)
from smogway.settings import DEFAULTS


def valid_pm25(air: DataFrame, column: str = "pm25") -> DataFrame:
    """Drop zeros, negative error flags, NaN and NULL."""
    return air.where(nan_to_null(F.col(column)) > 0)


def time_range(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """One row (lo, hi) with the first and last time; both NULL for an empty frame."""
    return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))


def hour_range(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """One row (start_hour, end_hour, n_hours): the hours covered by the data, both ends included."""
    # Flooring is monotone, so it is done once on the two extremes rather than on every row.
    ends = time_range(df, column).select(F.explode(F.array("lo", "hi")).alias("edge"))
    floored = ends.select(time_bucket("edge").alias("edge"))
    span = floored.agg(F.min("edge").alias("start_hour"), F.max("edge").alias("end_hour"))
    return span.withColumn("n_hours", whole_hours("start_hour", "end_hour") + 1)


def whole_hours(start: str, end: str) -> Column:
    """Completed hours from column `start` to column `end`."""
    elapsed = (F.col(end) - F.col(start)).cast("interval hour")
    return elapsed.cast("bigint")


def within_range_of(df: DataFrame, other: DataFrame, column: str = "timestamp") -> DataFrame:
    """Rows between the first and last hour of `other`, both included."""
    hours_covered = hour_range(other, column)
    return df.where(
        (F.col(column) >= hours_covered.select("start_hour").scalar())
        & (F.col(column) <= hours_covered.select("end_hour").scalar())
    )


def recent_or_all(
    df: DataFrame,
    as_of: TimeLike,
    recency_hours: float = DEFAULTS.recency_hours,
    column: str = "timestamp",
) -> DataFrame:
    """Rows of the last `recency_hours`, or every row that has a time when that would leave none.

    Looks for one recent row, in the recent partitions only; an older table is read whole. Give it a stored view.
    """
    since = time_value(as_of, df, column) - timedelta(hours=recency_hours)
    recent = prune(df, since, column=column)
    return df.where(F.col(column).isNotNull()) if recent.isEmpty() else recent


def ended_since(
    measurements: DataFrame, as_of: TimeLike, last_hours: float, column: str = "datetime_to"
) -> DataFrame:
    """Measurements whose interval ended within the last `last_hours`; a missing end is kept."""
    cutoff = like_column(as_of, measurements, column) - hours(last_hours)
    return measurements.where(F.col(column).isNull() | (F.col(column) >= cutoff))


def pm25_sensors(sensors: DataFrame, column: str = "parameter") -> DataFrame:
    return sensors.where(F.lower(F.col(column)).isin("pm25", "pm2.5"))


def in_window(
    df: DataFrame,
    as_of: TimeLike,
    retention_hours: float = DEFAULTS.retention_hours,
    column: str = "_fetched_at",
    tz: str = DEFAULTS.timezone,
) -> DataFrame:
    """Rows no older than the window; undated rows are kept."""
    now = time_literal(as_of, not _is_text(df, column) and is_wall_clock(df, column), tz)
    return df.where(F.coalesce(moment(df, column, tz) >= now - hours(retention_hours), F.lit(True)))


def moment(df: DataFrame, column: str, tz: str = DEFAULTS.timezone) -> Column:
    """`column` as a time: text is parsed, NULL where it is none."""
    return parse_instant(F.col(column), tz) if _is_text(df, column) else F.col(column)


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def retained(
    existing: DataFrame,
    new: DataFrame,
    as_of: TimeLike,
    retention_hours: float = DEFAULTS.retention_hours,
    column: str = "_fetched_at",
    tz: str = DEFAULTS.timezone,
) -> DataFrame:
    """existing ++ new without the rows older than the window; undated rows are kept."""
    return in_window(existing.unionByName(new, allowMissingColumns=True), as_of, retention_hours, column, tz)

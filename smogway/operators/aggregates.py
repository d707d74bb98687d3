"""Hourly views and their re-aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogway.functions.numbers import nan_to_null
from smogway.functions.timestamps import (
    TimeLike,
    between_times,
    hours,
    is_wall_clock,
    like_column,
    local_wall_clock,
    time_bucket,
)
from smogway.operators.filters import valid_pm25, whole_hours
from smogway.operators.quality import validate_columns
from smogway.settings import DEFAULTS
from smogway.sources.staging import stage


#: Logarithm of the registers of a location sketch: its standard error is about 1.04 / sqrt(2**12), 1.6 percent.
SKETCH_BITS = 12


def hourly_traffic(
    readings: DataFrame,
    width: str = "1 hour",
    since: TimeLike | None = None,
    until: TimeLike | None = None,
) -> DataFrame:
    """Mean, min, max and count of speed per bucket and road segment.

    Without a `segment_id` column the buckets alone are grouped. Rows with a NULL key are dropped.
    `since`/`until` bound the raw times, where the Parquet reader can use them.
    """
    validate_columns(readings, ["timestamp", "velocity"], "traffic data")
    keys = [time_bucket("timestamp", width).alias("timestamp")]
    source = between_times(readings, since, until)
    if "segment_id" in readings.columns:
        source = source.where(F.col("segment_id").isNotNull())
        keys.append(F.col("segment_id").alias("road_segment_id"))
    speed = nan_to_null(F.col("velocity"))
    return (
        source.select(*keys, speed.alias("velocity"))
        .groupBy("timestamp", *(["road_segment_id"] if len(keys) == 2 else []))
        .agg(
            F.avg("velocity").alias("avg_speed"),
            F.min("velocity").alias("min_speed"),
            F.max("velocity").alias("max_speed"),
            F.count("velocity").alias("record_count"),
        )
    )


def air_by_location(air: DataFrame, width: str = "1 hour") -> DataFrame:
    """Partial hourly sums per location: the first level of `hourly_air`, also used on streams."""
    return (
        valid_pm25(air)
        .select(time_bucket("timestamp", width).alias("timestamp"), "location", "pm25")
        .groupBy("timestamp", "location")
        .agg(F.sum("pm25").alias("pm25_sum"), F.count("pm25").alias("pm25_count"))
    )


def hourly_air(
    air: DataFrame,
    width: str = "1 hour",
    since: TimeLike | None = None,
    until: TimeLike | None = None,
    sketch: bool = False,
) -> DataFrame:
    """Mean and count of valid PM2.5 and number of locations per bucket.

    Two levels, (bucket, location) then bucket, so that a bucket holding most of the data is spread
    over its locations and the distinct count becomes a plain count. With `sketch` a HyperLogLog of the
    locations is kept beside it in `location_sketch`, from which merged buckets get distinct locations.
    """
    validate_columns(air, ["timestamp", "location", "pm25"], "air quality data")
    return _over_locations(air_by_location(between_times(air, since, until), width), sketch)


def _over_locations(by_location: DataFrame, sketch: bool = False) -> DataFrame:
    kept = [F.hll_sketch_agg("location", F.lit(SKETCH_BITS)).alias("location_sketch")] if sketch else []
    return by_location.groupBy("timestamp").agg(
        (F.sum("pm25_sum") / F.sum("pm25_count")).alias("avg_pm25"),
        F.sum("pm25_count").alias("pm25_count"),
        F.count("location").alias("location_count"),
        *kept,
    )


def merge_air_sums(partials: DataFrame) -> DataFrame:
    """`air_by_location` of all parts together from that of any parts."""
    return partials.groupBy("timestamp", "location").agg(
        F.sum("pm25_sum").alias("pm25_sum"), F.sum("pm25_count").alias("pm25_count")
    )


def merge_traffic_sums(partials: DataFrame) -> DataFrame:
    """`traffic_by_segment` of all parts together from that of any parts."""
    return partials.groupBy("timestamp", "road_segment_id").agg(
        F.sum("speed_sum").alias("speed_sum"), F.min("min_speed").alias("min_speed"),
        F.max("max_speed").alias("max_speed"), F.sum("record_count").alias("record_count"),
    )


def merge_air(partials: DataFrame) -> DataFrame:
    """The hourly air view from `air_by_location` of any parts of the data, e.g. of micro-batches."""
    return _over_locations(merge_air_sums(partials))


def traffic_by_segment(readings: DataFrame, width: str = "1 hour", also: Sequence[str] = ()) -> DataFrame:
    """Partial hourly sums per road segment, which `merge_traffic` adds up; kept apart by the columns `also`."""
    return (
        readings.where(F.col("segment_id").isNotNull())
        .select(
            time_bucket("timestamp", width).alias("timestamp"),
            F.col("segment_id").alias("road_segment_id"),
            nan_to_null(F.col("velocity")).alias("velocity"),
            *also,
        )
        .groupBy("timestamp", "road_segment_id", *also)
        .agg(
            F.sum("velocity").alias("speed_sum"),
            F.min("velocity").alias("min_speed"),
            F.max("velocity").alias("max_speed"),
            F.count("velocity").alias("record_count"),
        )
    )


def merge_traffic(partials: DataFrame) -> DataFrame:
    """The hourly traffic view from `traffic_by_segment` of any parts of the data."""
    return partials.groupBy("timestamp", "road_segment_id").agg(
        F.try_divide(F.sum("speed_sum"), F.sum("record_count")).alias("avg_speed"),
        F.min("min_speed").alias("min_speed"),
        F.max("max_speed").alias("max_speed"),
        F.sum("record_count").alias("record_count"),
    )


def reaggregate_traffic(batch: DataFrame, weighted: bool = False) -> DataFrame:
    """One row per (timestamp[, segment]); the mean of means is unweighted unless `weighted`."""
    keys = [c for c in ("timestamp", "road_segment_id") if c in batch.columns]
    mean = (
        F.sum(F.col("avg_speed") * F.col("record_count")) / F.sum("record_count")
        if weighted
        else F.avg("avg_speed")
    )
    return batch.groupBy(*keys).agg(
        mean.alias("avg_speed"),
        F.min("min_speed").alias("min_speed"),
        F.max("max_speed").alias("max_speed"),
        F.sum("record_count").alias("record_count"),
    )


def reaggregate_air(air: DataFrame, weighted: bool = False) -> DataFrame:
    """One row per timestamp; location counts are added, as the locations are no longer known.

    Views with a `location_sketch` get the number of distinct locations from it instead, within a few percent.
    """
    mean = (
        F.sum(F.col("avg_pm25") * F.col("pm25_count")) / F.sum("pm25_count")
        if weighted
        else F.avg("avg_pm25")
    )
    return air.groupBy("timestamp").agg(
        mean.alias("avg_pm25"),
        F.sum("pm25_count").alias("pm25_count"),
        *_merged_locations(air),
    )


def _merged_locations(air: DataFrame) -> list[Column]:
    if "location_sketch" not in air.columns:
        return [F.sum("location_count").alias("location_count")]
    union = F.hll_union_agg("location_sketch")
    return [F.hll_sketch_estimate(union).alias("location_count"), union.alias("location_sketch")]


def hourly_mean_pm25(air: DataFrame) -> DataFrame:
    """Plain mean per hour, error flags included, as the critical-hour search uses it."""
    pm25 = nan_to_null(F.col("pm25"))
    return (
        air.select(time_bucket("timestamp").alias("timestamp"), pm25.alias("pm25"))
        .groupBy("timestamp")
        .agg(F.avg("pm25").alias("avg_pm25"))
    )


def critical_hours(
    air: DataFrame,
    start: TimeLike | None = None,
    n_hours: int | None = None,
    threshold: float = DEFAULTS.pm25_threshold,
) -> DataFrame:
    """Hours with mean PM2.5 above `threshold` inside [start, start + n_hours), with their 0-based offset.

    Without `start` the range of the data itself is searched; the hours are staged, so the data is read once.
    """
    if start is None:
        hourly = stage(hourly_mean_pm25(air), "hourly-pm25")  # a row per calendar hour, read twice
        first = hourly.agg(F.min("timestamp")).scalar()
    else:
        if n_hours is None:
            raise ValueError("n_hours is needed with start")
        first = like_column(start, air, "timestamp")
        ts = F.col("timestamp")
        hourly = hourly_mean_pm25(air.where((ts >= first) & (ts < first + hours(n_hours))))
        hourly = hourly.where(ts.between(first, first + hours(n_hours - 1)))  # whole hours, if `start` is inside one
    return (
        hourly.where(F.col("avg_pm25") > threshold)
        .withColumn("_start", first)
        .withColumn("hour_offset", whole_hours("_start", "timestamp"))
        .drop("_start")
    )


def day_band(hour_of_day: Column) -> Column:
    """rush (7-9, 17-19), night (22-6) or normal."""
    h = hour_of_day
    return (
        F.when(((h >= 7) & (h < 9)) | ((h >= 17) & (h < 19)), F.lit("rush"))
        .when((h >= 22) | (h < 6), F.lit("night"))
        .otherwise(F.lit("normal"))
    )


def fine_day_band(hour_of_day: Column) -> Column:
    """early_morning, rush, daytime, evening or late_night, the finer profile."""
    # Hours of each band; every other hour is late night.
    bands = {
        "early_morning": [0, 1, 5, 6],
        "rush": [7, 8, 17, 18],
        "daytime": [9, 10, 11, 12, 13, 14, 15, 16],
        "evening": [19, 20, 21],
    }
    column = None
    for name, members in bands.items():
        matches = hour_of_day.isin(*members)
        column = F.when(matches, F.lit(name)) if column is None else column.when(matches, F.lit(name))
    return column.otherwise(F.lit("late_night"))


def time_of_day_profile(
    readings: DataFrame, band=day_band, tz: str = DEFAULTS.timezone
) -> DataFrame:
    """Speed statistics per band of the local day."""
    ts = F.col("timestamp")
    local = ts if is_wall_clock(readings, "timestamp") else local_wall_clock(ts, tz)
    speed = nan_to_null(F.col("velocity"))
    return (
        readings.select(band(F.hour(local)).alias("day_band"), speed.alias("velocity"))
        .groupBy("day_band")
        .agg(
            F.avg("velocity").alias("avg_speed"),
            F.min("velocity").alias("min_speed"),
            F.max("velocity").alias("max_speed"),
            F.count("velocity").alias("record_count"),
        )
    )

"""Streaming DataFrames. Time columns are TIMESTAMP, as watermarks reject TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogway.functions.numbers import nan_to_null
from smogway.operators.filters import valid_pm25
from smogway.operators.parsing import parse_air, parse_traffic
from smogway.settings import DEFAULTS


def air_stream(raw: DataFrame) -> DataFrame:
    """Parsed measurements, late ones and corrections included: an upsert needs no bound on lateness."""
    return parse_air(raw).accepted


def dedupe_stream(air: DataFrame, watermark: str = DEFAULTS.watermark) -> DataFrame:
    """Keep the first arrival per (timestamp, location); state is dropped behind the watermark."""
    return air.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["timestamp", "location"])


def traffic_stream(raw: DataFrame, as_of, watermark: str = DEFAULTS.watermark) -> DataFrame:
    """Parsed readings. `as_of` stamps records without a fetch time; in a job that runs on it should be a column of `raw`,
    such as the time of the message, as a point in time given at the start falls behind the watermark.
    """
    return parse_traffic(raw, as_of).accepted.withWatermark("timestamp", watermark)


def hourly_air_stream(air: DataFrame, width: str = "1 hour") -> DataFrame:
    """Hourly air view over a watermarked stream.

    Streams refuse distinct counts, so locations are grouped first and counted second; that also
    spreads one busy hour over its locations.
    """
    per_location = (
        valid_pm25(air)
        .groupBy(F.window("timestamp", width), "location")
        .agg(F.sum("pm25").alias("pm25_sum"), F.count("pm25").alias("pm25_count"))
    )
    return per_location.groupBy("window").agg(
        (F.sum("pm25_sum") / F.sum("pm25_count")).alias("avg_pm25"),
        F.sum("pm25_count").alias("pm25_count"),
        F.count("location").alias("location_count"),
    )


def hourly_traffic_stream(readings: DataFrame, width: str = "1 hour") -> DataFrame:
    """Hourly traffic view over a watermarked stream."""
    return (
        readings.where(F.col("segment_id").isNotNull())
        .withColumn("velocity", nan_to_null(F.col("velocity")))
        .groupBy(F.window("timestamp", width), F.col("segment_id").alias("road_segment_id"))
        .agg(
            F.avg("velocity").alias("avg_speed"),
            F.min("velocity").alias("min_speed"),
            F.max("velocity").alias("max_speed"),
            F.count("velocity").alias("record_count"),
        )
    )


def combined_stream(readings: DataFrame, air: DataFrame, width: str = "1 hour") -> DataFrame:
    """Full outer join of the two hourly views; an hour comes out once the watermark has passed it.

    The newest hours are not merged here: alignment needs the final maxima of both sides.
    """
    return hourly_traffic_stream(readings, width).join(hourly_air_stream(air, width), "window", "full_outer")


def with_hour(windowed: DataFrame) -> DataFrame:
    """Replace the window struct by its start, first column."""
    rest = [c for c in windowed.columns if c != "window"]
    return windowed.select(F.col("window.start").alias("timestamp"), *rest)

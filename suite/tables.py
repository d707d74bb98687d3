"""The test tables read as traffic readings, air measurements, raw JSON and stations.

Each mapping has its SQL twin in `suite/oracle.py`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogway.functions.timestamps import instant_from_wall_clock, time_bucket

AS_OF = "2024-01-31 00:00:00"
TRAFFIC_TYPES = ("view", "click")
AIR_TYPES = ("purchase", "error", "signup")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def as_traffic(events_df: DataFrame) -> DataFrame:
    return events_df.where(F.col("event_type").isin(*TRAFFIC_TYPES)).select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("segment_"), F.col("user_id") % 5).alias("segment_id"),
        F.col("value").alias("velocity"),
    )


def as_air(events_df: DataFrame, *extra: str) -> DataFrame:
    return events_df.where(F.col("event_type").isin(*AIR_TYPES)).select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("loc_"), F.col("user_id") % 20).alias("location"),
        (F.col("value") - 5).alias("pm25"),
        *extra,
    )


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_traffic(events(spark, sf_dir))


def air(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return as_air(events(spark, sf_dir), *extra)


def later(air_df: DataFrame) -> DataFrame:
    """The same measurements five hours later: either end then has hours with data of one side only."""
    return air_df.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 5 HOURS"))


def hourly_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air measurements stamped with their hour, so that (timestamp, location) repeats."""
    return air(spark, sf_dir, "event_id", "event_type").withColumn("timestamp", time_bucket("timestamp"))


def daily_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("timestamp"),
        F.concat(F.lit("segment_"), F.col("l_suppkey") % 5).alias("segment_id"),
        F.col("l_quantity").alias("velocity"),
    )


def daily_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("timestamp"),
        F.concat(F.lit("loc_"), F.col("o_custkey") % 20).alias("location"),
        F.floor(F.col("o_totalprice") / 2000).cast("double").alias("pm25"),
    )


def position(key: str) -> dict[str, Column]:
    """A fixed position in and around the study area for an integer key."""
    return {
        "latitude": (F.lit(10600) + F.col(key) * 37 % 350) / 1000,
        "longitude": (F.lit(106500) + F.col(key) * 53 % 350) / 1000,
    }


def stations(spark: SparkSession, sf_dir: str, source: str = "supplier", prefix: str = "s") -> DataFrame:
    key = {"supplier": "s_suppkey", "customer": "c_custkey"}[source]
    return table(spark, sf_dir, source).select(
        F.col(key).alias("station_id"),
        F.col(f"{prefix}_name").alias("name"),
        *[column.alias(name) for name, column in position(key).items()],
    )


# --- raw JSON ----------------------------------------------------------------------------------


def _clock(suffix: str = "", shift_hours: int = 0) -> Column:
    shifted = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(shift_hours))
    return F.concat(F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(suffix))


def _json(struct: Column) -> Column:
    return F.to_json(struct, {"ignoreNullFields": "true"})


def raw_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a raw traffic response; each event type has its own shape or defect."""
    value = F.col("value")
    point = F.struct(
        (F.lit(10) + F.col("user_id") / 1000).alias("latitude"),
        (F.lit(106) + F.col("user_id") / 500).alias("longitude"),
    )
    coordinates = F.struct(F.array(point).alias("coordinate")).alias("coordinates")
    moving = _json(F.struct(
        F.struct(value.alias("currentSpeed"), F.lit(33.0).alias("freeFlowSpeed"), coordinates).alias("flowSegmentData"),
        _clock("Z").alias("_fetched_at"),
    ))
    standing = _json(F.struct(
        F.struct(F.lit(0).alias("currentSpeed"), value.alias("freeFlowSpeed"), coordinates).alias("flowSegmentData"),
        _clock().alias("_fetched_at"),
    ))
    explicit_null = F.concat(
        F.lit('{"flowSegmentData":{"currentSpeed":null,"freeFlowSpeed":'), value, F.lit("}}")
    )
    quoted = _json(F.struct(F.struct(value.cast("string").alias("currentSpeed")).alias("flowSegmentData")))
    unplaced = _json(F.struct(F.struct(value.alias("currentSpeed")).alias("flowSegmentData")))
    no_segment = _json(F.struct(_clock("Z").alias("_fetched_at")))
    body = (
        F.when(F.col("event_type") == "view", moving)
        .when(F.col("event_type") == "click", standing)
        .when(F.col("event_type") == "signup", explicit_null)
        .when(F.col("event_type") == "purchase", F.when(value > 50, quoted).otherwise(unplaced))
        .otherwise(no_segment)
    )
    return events(spark, sf_dir).select("event_id", body.alias("value"))


def raw_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a raw air measurement of its hour; each event type has its own shape or defect."""
    value = F.col("value")
    place = F.concat(F.lit("loc_"), F.col("user_id") % 20)
    at = F.struct(
        (F.lit(10) + F.col("user_id") / 1000).alias("latitude"),
        (F.lit(106) + F.col("user_id") / 500).alias("longitude"),
    )
    hourly = events(spark, sf_dir).withColumn("ts", time_bucket("ts"))
    canonical = _json(F.struct(
        F.struct(
            F.struct(_clock("Z").alias("utc"), _clock("+07:00", 7).alias("local")).alias("datetimeFrom")
        ).alias("period"),
        value,
        F.struct(F.lit("pm25").alias("name")).alias("parameter"),
        at.alias("coordinates"),
        place.alias("location"),
    ))
    flat = _json(F.struct(
        F.struct(_clock("Z").alias("utc")).alias("date"),
        value.cast("string").alias("value"),
        F.lit("PM2.5").alias("parameter"),
        place.alias("locationName"),
    ))
    nested = _json(F.struct(
        _clock().alias("datetime"),
        value,
        F.struct(place.alias("name"), at.alias("coordinates")).alias("location"),
    ))
    other_pollutant = _json(F.struct(
        F.struct(_clock("Z").alias("datetime_to")).alias("period"), value, F.lit("o3").alias("parameter")
    ))
    unnamed = _json(F.struct(
        F.struct(_clock("Z").alias("datetime_to")).alias("period"), value, F.lit(3).alias("parameter_id")
    ))
    not_a_number = F.concat(F.lit('{"datetime":"'), _clock("Z"), F.lit('","value":NaN,"location":"'), place, F.lit('"}'))
    valueless = F.concat(F.lit('{"datetime":"'), _clock("Z"), F.lit('","value":null}'))
    undated = _json(F.struct(F.lit("yesterday").alias("datetime"), value))
    body = (
        F.when(F.col("event_type") == "view", canonical)
        .when(F.col("event_type") == "click", flat)
        .when(F.col("event_type") == "signup", nested)
        .when(F.col("event_type") == "purchase", F.when(value > 50, other_pollutant).otherwise(unnamed))
        .when(value < 20, valueless)
        .when(value > 100, undated)
        .otherwise(not_a_number)
    )
    return hourly.select(F.col("event_id").alias("ingest_seq"), body.alias("value"))


def sensor_feed_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed raw traffic of five road segments."""
    point = F.struct(
        (F.lit(10.77) + (F.col("user_id") % 5) / 100).alias("latitude"), F.lit(106.66).alias("longitude")
    )
    body = F.struct(
        F.struct(
            F.col("value").alias("currentSpeed"),
            F.struct(F.array(point).alias("coordinate")).alias("coordinates"),
        ).alias("flowSegmentData"),
        _clock("Z").alias("_fetched_at"),
    )
    return (
        events(spark, sf_dir)
        .where(F.col("event_type").isin(*TRAFFIC_TYPES))
        .select(_json(body).alias("value"), F.col("event_id").alias("ingest_seq"))
    )


def sensor_feed_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed raw air measurements of twenty stations."""
    body = F.struct(
        F.struct(F.struct(_clock("Z").alias("utc")).alias("datetimeFrom")).alias("period"),
        (F.col("value") - 5).alias("value"),
        F.concat(F.lit("loc_"), F.col("user_id") % 20).alias("location"),
    )
    return (
        events(spark, sf_dir)
        .where(F.col("event_type").isin(*AIR_TYPES))
        .select(_json(body).alias("value"), F.col("event_id").alias("ingest_seq"))
    )


def as_instant(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.withColumn(column, instant_from_wall_clock(F.col(column)))

"""Monitoring stations: radius search, sampling grid and enrichment of measurements."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogway.functions.spatial import KM_PER_DEGREE, haversine_km, linspace_index, linspace_value
from smogway.operators.quality import validate_columns
from smogway.settings import DEFAULTS, Settings


def stations_within_radius(
    stations: DataFrame,
    lat: float = DEFAULTS.center_lat,
    lon: float = DEFAULTS.center_lon,
    radius_km: float = DEFAULTS.radius_km,
    max_locations: int | None = None,
    tie_break: str = "station_id",
) -> DataFrame:
    """Stations at most `radius_km` away with `distance_km`, nearest first when limited.

    A latitude/longitude box in front of the exact test is plain enough to reach the file reader.
    """
    dlat = radius_km / KM_PER_DEGREE * 1.01
    dlon = dlat / max(math.cos(math.radians(lat)), 0.01)
    boxed = stations.where(
        F.col("latitude").between(lat - dlat, lat + dlat)
        & F.col("longitude").between(lon - dlon, lon + dlon)
    )
    distance = haversine_km(F.lit(lat), F.lit(lon), F.col("latitude"), F.col("longitude"))
    near = boxed.withColumn("distance_km", distance).where(F.col("distance_km") <= radius_km)
    if max_locations is None:
        return near
    return near.orderBy("distance_km", tie_break).limit(max_locations)


def sampling_grid(spark: SparkSession, settings: Settings = DEFAULTS) -> DataFrame:
    """The n x n query points of the study area, corners included."""
    n = settings.grid_size
    cell = F.col("id")
    row, col = (cell / n).cast("int"), (cell % n).cast("int")
    return spark.range(n * n).select(
        row.alias("grid_row"),
        col.alias("grid_col"),
        linspace_value(row, settings.lat_min, settings.lat_max, n).alias("latitude"),
        linspace_value(col, settings.lon_min, settings.lon_max, n).alias("longitude"),
    )


def nearest_grid_point(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add grid_row and grid_col of the nearest sampling point; NULL outside the box. No join."""
    validate_columns(df, ["latitude", "longitude"], "positions")
    n = settings.grid_size
    return df.withColumns(
        {
            "grid_row": linspace_index(F.col("latitude"), settings.lat_min, settings.lat_max, n),
            "grid_col": linspace_index(F.col("longitude"), settings.lon_min, settings.lon_max, n),
        }
    )


def enrich_with_station(measurements: DataFrame, stations: DataFrame, key: str = "station_id") -> DataFrame:
    """Add the station name and fill in missing coordinates from the station.

    No broadcast hint: Spark broadcasts the stations if they are small and otherwise splits hot ones.
    """
    st = stations.select(
        key,
        F.col("name").alias("_name"),
        F.col("latitude").alias("_lat"),
        F.col("longitude").alias("_lon"),
    )
    return (
        measurements.join(st, key, "left")
        .withColumn("location", F.col("_name"))
        .withColumn("latitude", F.coalesce("latitude", "_lat"))
        .withColumn("longitude", F.coalesce("longitude", "_lon"))
        .drop("_name", "_lat", "_lon")
    )

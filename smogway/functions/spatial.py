"""Grid cells, sampling points and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088
KM_PER_DEGREE = 111.0


def grid_cell(lat: Column, lon: Column) -> Column:
    """`segment_<lat*100>_<lon*100>` with half-even rounding, `segment_unknown` without a position."""

    def hundredths(x: Column) -> Column:
        return F.rint(x * 100).try_cast("bigint").cast("string")

    cell = F.concat(F.lit("segment_"), hundredths(lat), F.lit("_"), hundredths(lon))
    return F.coalesce(cell, F.lit("segment_unknown"))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    h = F.sin(half_dlat) * F.sin(half_dlat) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_dlon) * F.sin(half_dlon)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def linspace_index(x: Column, low: float, high: float, n: int) -> Column:
    """Index of the nearest of `n` evenly spaced points on [low, high]; NULL outside the interval."""
    step = (high - low) / (n - 1)
    return F.when(x.between(low, high), F.round((x - F.lit(low)) / F.lit(step)).cast("int"))


def linspace_value(index: Column, low: float, high: float, n: int) -> Column:
    return F.lit(low) + F.lit(high - low) * index / F.lit(n - 1)

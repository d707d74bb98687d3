"""Business constants of the pipeline, in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Thresholds, zones and windows. Every operator takes them as arguments with these defaults."""

    # They decide which rows are critical and must not drift.
    timezone: str = "Asia/Ho_Chi_Minh"
    pm25_threshold: float = 50.0
    speed_threshold: float = 20.0
    pm25_full_scale: float = 200.0
    speed_full_scale: float = 100.0
    kmh_per_ms: float = 3.6
    tolerance_hours: int = 2
    recency_hours: int = 24
    retention_hours: int = 24
    polling_minutes: int = 5

    # Study area: sampling box, grid and search circle.
    lat_min: float = 10.7600
    lat_max: float = 10.7830
    lon_min: float = 106.6500
    lon_max: float = 106.6830
    grid_size: int = 5
    center_lat: float = 10.7715
    center_lon: float = 106.6664
    radius_km: float = 3.0

    # Event-time delay tolerated by the streaming queries.
    watermark: str = "2 hours"


DEFAULTS = Settings()

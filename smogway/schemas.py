"""Canonical schemas. Frames that follow them hold NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import types as T

_D, _L, _S, _TS = T.DoubleType(), T.LongType(), T.StringType(), T.TimestampType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


RAW_TEXT = _struct(value=_S)

READINGS = _struct(timestamp=_TS, segment_id=_S, velocity=_D)

BATCH_VIEW = _struct(
    timestamp=_TS, road_segment_id=_S, avg_speed=_D, min_speed=_D, max_speed=_D, record_count=_L
)

SPEED_VIEW = _struct(timestamp=_TS, location=_S, pm25=_D, latitude=_D, longitude=_D)

# Raw measurements with the number of the append that brought them.
AIR_RAW = T.StructType([*SPEED_VIEW.fields, T.StructField("arrival", _L)])

# The air view with the micro-batch that brought each row.
LIVE_VIEW = T.StructType([*SPEED_VIEW.fields, T.StructField("arrival", _L)])

REJECTED = _struct(reason=_S, raw=_S, batch_id=_L)

# Messages taken from a topic, those that were undecodable, and how far each consumer group has come.
DRAINED = _struct(key=_S, value=_S, topic=_S, partition=T.IntegerType(), offset=_L, sent=_TS, drain=_L)
UNDECODABLE = _struct(
    reason=_S, key=_S, value=T.BinaryType(), topic=_S, partition=T.IntegerType(), offset=_L, sent=_TS, drain=_L
)
OFFSETS = _struct(consumer=_S, topic=_S, partition=T.IntegerType(), next_offset=_L, drain=_L)

# Hourly sums per road segment, which add up to the batch view.
TRAFFIC_SUMS = _struct(timestamp=_TS, road_segment_id=_S, speed_sum=_D, min_speed=_D, max_speed=_D, record_count=_L)

RAW_FILES = _struct(path=_S, length=_L, modified=_TS)

MIGRATIONS = _struct(name=_S, status=_S, rows=_L, error=_S)

HOURLY_AIR = _struct(timestamp=_TS, avg_pm25=_D, pm25_count=_L, location_count=_L)

COMBINED = _struct(
    timestamp=_TS,
    road_segment_id=_S,
    avg_speed=_D,
    min_speed=_D,
    max_speed=_D,
    record_count=_L,
    avg_pm25=_D,
    pm25_count=_L,
    location_count=_L,
    is_critical=T.BooleanType(),
    severity_index=_D,
)

def names(schema: T.StructType) -> list[str]:
    return schema.fieldNames()

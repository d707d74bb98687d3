"""DuckDB SQL twins of `suite/queries.py`."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

# --- mappings of the test tables (see suite/tables.py) --------------------------------------------

TRAFFIC = """traffic AS (
  SELECT ts AS timestamp, 'segment_' || (user_id % 5) AS segment_id, value AS velocity
  FROM events WHERE event_type IN ('view', 'click'))"""
AIR = """air AS (
  SELECT ts AS timestamp, 'loc_' || (user_id % 20) AS location, value - 5 AS pm25, event_id, event_type
  FROM events WHERE event_type IN ('purchase', 'error', 'signup'))"""
AIR_LATER = AIR + ", air_later AS (SELECT * REPLACE (timestamp + INTERVAL 5 HOUR AS timestamp) FROM air)"


def batch(source: str = "traffic", name: str = "batch", unit: str = "hour") -> str:
    return f"""{name} AS (
  SELECT date_trunc('{unit}', timestamp) AS timestamp, segment_id AS road_segment_id, avg(velocity) AS avg_speed,
         min(velocity) AS min_speed, max(velocity) AS max_speed, count(velocity) AS record_count
  FROM {source} GROUP BY 1, 2)"""


def hourly(source: str = "air", name: str = "hourly", unit: str = "hour") -> str:
    return f"""{name} AS (
  SELECT date_trunc('{unit}', timestamp) AS timestamp, avg(pm25) AS avg_pm25, count(pm25) AS pm25_count,
         count(DISTINCT location) AS location_count
  FROM {source} WHERE pm25 > 0 GROUP BY 1)"""


def aligned(batch_name: str = "batch", hourly_name: str = "hourly") -> str:
    return f"""newest AS (
  SELECT (SELECT max(timestamp) FROM {batch_name}) AS b, (SELECT max(timestamp) FROM {hourly_name}) AS a),
target AS (
  SELECT CASE WHEN abs(epoch(b) - epoch(a)) <= 7200 THEN date_trunc('hour', greatest(a, b)) END AS t FROM newest),
batch_a AS (
  SELECT CASE WHEN timestamp BETWEEN t - INTERVAL 2 HOUR AND t + INTERVAL 2 HOUR THEN t ELSE timestamp END AS timestamp,
         road_segment_id, avg(avg_speed) AS avg_speed, min(min_speed) AS min_speed, max(max_speed) AS max_speed,
         sum(record_count)::BIGINT AS record_count
  FROM {batch_name}, target GROUP BY 1, 2),
hourly_a AS (
  SELECT CASE WHEN timestamp BETWEEN t - INTERVAL 2 HOUR AND t + INTERVAL 2 HOUR THEN t ELSE timestamp END AS timestamp,
         avg(avg_pm25) AS avg_pm25, sum(pm25_count)::BIGINT AS pm25_count, sum(location_count)::BIGINT AS location_count
  FROM {hourly_name}, target GROUP BY 1)"""


def combined(batch_name: str = "batch", hourly_name: str = "hourly") -> str:
    return f"""combined AS (
  SELECT coalesce(b.timestamp, h.timestamp) AS timestamp, road_segment_id, avg_speed, min_speed, max_speed,
         record_count, avg_pm25, pm25_count, location_count
  FROM {batch_name} b FULL OUTER JOIN {hourly_name} h ON b.timestamp = h.timestamp)"""


FLAGGED = """flagged AS (
  SELECT *, coalesce(avg_pm25 > 50 AND avg_speed < 20, false) AS is_critical,
         CASE WHEN avg_pm25 IS NULL OR avg_speed IS NULL THEN NULL
              ELSE (least(greatest(avg_pm25 / 200, 0), 1) + (1 - least(greatest(avg_speed / 100, 0), 1))) / 2
         END AS severity_index
  FROM combined)"""

PLAIN = [TRAFFIC, AIR, batch(), hourly(), combined(), FLAGGED]
GAPS = [TRAFFIC, AIR_LATER, batch(), hourly("air_later"), combined(), FLAGGED]
ALIGNED = [TRAFFIC, AIR, batch(), hourly(), aligned(), combined("batch_a", "hourly_a"), FLAGGED]

CRITICAL_HOURS = """critical_hours AS (
  SELECT date_trunc('hour', timestamp) AS timestamp, avg(pm25) AS avg_pm25
  FROM air GROUP BY 1 HAVING avg(pm25) > 50)"""


def sql(ctes: list[str], body: str) -> str:
    return f"WITH {', '.join(ctes)}\n{body}"


def batch_columns(digits: int = 6) -> str:
    return f"""timestamp, road_segment_id, round(avg_speed, {digits}) AS avg_speed, round(min_speed, {digits}) AS min_speed,
  round(max_speed, {digits}) AS max_speed, record_count"""


def air_columns(digits: int = 8) -> str:
    return f"round(avg_pm25, {digits}) AS avg_pm25, pm25_count, location_count"


CRITICAL_COLUMNS = "is_critical, round(severity_index, 10) AS severity_index"


def runs(source: str, key: str = "") -> str:
    """Runs of consecutive hours of `source`, per `key`."""
    keys = f"{key}, " if key else ""
    part = f"PARTITION BY {key} " if key else ""
    return f"""SELECT {keys}min(timestamp) AS period_start, max(timestamp) + INTERVAL 1 HOUR AS period_end, count(*) AS n_hours
FROM (SELECT *, timestamp - to_hours(row_number() OVER ({part}ORDER BY timestamp)) AS run
      FROM (SELECT DISTINCT {keys}timestamp FROM {source}))
GROUP BY {keys}run"""


def rint(expression: str) -> str:
    return f"CAST(round_even({expression}, 0) AS BIGINT)"


CELL = "'segment_' || " + rint("({lat}) * 100") + " || '_' || " + rint("({lon}) * 100")
EVENT_CELL = CELL.format(lat="10 + user_id / 1000", lon="106 + user_id / 500")

# --- raw JSON (see raw_traffic and raw_air) --------------------------------------------------------

SECOND = "date_trunc('second', ts)"

PARSED_TRAFFIC = f"""parsed AS (
  SELECT event_id,
         CASE event_type WHEN 'view' THEN {SECOND} + INTERVAL 7 HOUR WHEN 'click' THEN {SECOND}
              ELSE {AS_OF} END AS timestamp,
         CASE WHEN event_type = 'purchase' THEN 'segment_unknown' ELSE {EVENT_CELL} END AS segment_id,
         round(CASE WHEN event_type = 'view' AND value <= 0 THEN 33.0::DOUBLE ELSE value END * 3.6::DOUBLE, 2) AS velocity,
         CASE WHEN event_type = 'signup' THEN 'bad_speed'
              WHEN event_type = 'error' THEN 'no_flow_segment'
              WHEN event_type = 'purchase' AND value > 50 THEN 'bad_speed'
              WHEN value <= 0 AND event_type <> 'view' THEN 'non_positive_speed' END AS reason
  FROM events)"""

PARSED_AIR = """parsed AS (
  SELECT event_id AS ingest_seq, date_trunc('hour', ts) + INTERVAL 7 HOUR AS timestamp,
         CASE WHEN event_type = 'purchase' THEN 'Unknown' ELSE 'loc_' || (user_id % 20) END AS location,
         CASE WHEN event_type <> 'error' THEN value END AS pm25,
         CASE WHEN event_type IN ('view', 'signup') THEN 10 + user_id / 1000 END AS latitude,
         CASE WHEN event_type IN ('view', 'signup') THEN 106 + user_id / 500 END AS longitude,
         CASE WHEN event_type = 'purchase' AND value > 50 THEN 'not_pm25'
              WHEN event_type = 'error' AND value < 20 THEN 'missing_value'
              WHEN event_type = 'error' AND value > 100 THEN 'bad_timestamp' END AS reason
  FROM events),
air_parsed AS (
  SELECT timestamp, location, pm25, latitude, longitude FROM parsed WHERE reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY timestamp, location ORDER BY ingest_seq) = 1)"""

FEED = """feed_traffic AS (
  SELECT date_trunc('second', ts) + INTERVAL 7 HOUR AS timestamp,
         'segment_' || CAST(round_even((10.77::DOUBLE + (user_id % 5) / 100) * 100, 0) AS BIGINT) || '_10666' AS segment_id,
         round(value * 3.6::DOUBLE, 2) AS velocity
  FROM events WHERE event_type IN ('view', 'click') AND value > 0),
feed_air AS (
  SELECT date_trunc('second', ts) + INTERVAL 7 HOUR AS timestamp, 'loc_' || (user_id % 20) AS location, value - 5 AS pm25
  FROM events WHERE event_type IN ('purchase', 'error', 'signup')
  QUALIFY row_number() OVER (PARTITION BY date_trunc('second', ts), user_id % 20 ORDER BY event_id) = 1)"""


def station_rows(source: str, key: str, name: str) -> str:
    return f"""stations AS (
  SELECT {key} AS station_id, {name} AS name, (10600 + {key} * 37 % 350) / 1000 AS latitude,
         (106500 + {key} * 53 % 350) / 1000 AS longitude
  FROM {source})"""


DISTANCES = """distances AS (
  SELECT station_id, name,
         2 * 6371.0088::DOUBLE * asin(sqrt(least(1.0::DOUBLE,
           power(sin(radians(latitude - 10.7715::DOUBLE) / 2), 2)
           + cos(radians(10.7715::DOUBLE)) * cos(radians(latitude))
             * power(sin(radians(longitude - 106.6664::DOUBLE) / 2), 2)))) AS distance_km
  FROM stations)"""

STAMPED = """stamped AS (
  SELECT event_id, timestamp_text, offset_hours, CASE WHEN day_only THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END AS clock
  FROM (SELECT *, event_type = 'purchase' AS day_only, event_type AS timestamp_text,
               CASE event_type WHEN 'click' THEN 0 ELSE 7 END AS offset_hours
        FROM events WHERE event_type <> 'error'))"""


def profile(bands: str) -> str:
    return sql([TRAFFIC], f"""SELECT {bands} AS day_band, round(avg(velocity), 5) AS avg_speed,
  round(min(velocity), 5) AS min_speed, round(max(velocity), 5) AS max_speed, count(velocity) AS record_count
FROM (SELECT *, hour(timestamp) AS h FROM traffic) GROUP BY 1""")


ORACLE: dict[str, str] = {
    "hourly_traffic_by_segment": sql([TRAFFIC, batch()], f"SELECT {batch_columns()} FROM batch"),
    "hourly_traffic_overall": sql([TRAFFIC], """SELECT date_trunc('hour', timestamp) AS timestamp,
  round(avg(velocity), 6) AS avg_speed, round(min(velocity), 6) AS min_speed, round(max(velocity), 6) AS max_speed,
  count(velocity) AS record_count
FROM traffic GROUP BY 1"""),
    "hourly_air_quality": sql([AIR, hourly()], f"SELECT timestamp, {air_columns()} FROM hourly"),
    "time_of_day_profile": profile("""CASE WHEN (h >= 7 AND h < 9) OR (h >= 17 AND h < 19) THEN 'rush'
  WHEN h >= 22 OR h < 6 THEN 'night' ELSE 'normal' END"""),
    "time_of_day_profile_fine": profile("""CASE WHEN h IN (0, 1, 5, 6) THEN 'early_morning' WHEN h IN (7, 8, 17, 18) THEN 'rush'
  WHEN h BETWEEN 9 AND 16 THEN 'daytime' WHEN h BETWEEN 19 AND 21 THEN 'evening' ELSE 'late_night' END"""),
    "day_grain_volume": sql(
        [
            """traffic AS (SELECT l_shipdate AS timestamp, 'segment_' || (l_suppkey % 5) AS segment_id,
  l_quantity AS velocity FROM lineitem)""",
            """air AS (SELECT o_orderdate AS timestamp, 'loc_' || (o_custkey % 20) AS location,
  floor(o_totalprice / 2000) AS pm25 FROM orders)""",
            batch(unit="day"), hourly(unit="day"), combined(), FLAGGED,
        ],
        f"SELECT {batch_columns()}, {air_columns(6)}, is_critical, round(severity_index, 9) AS severity_index FROM flagged",
    ),
    "combined_outer": sql(GAPS, f"SELECT {batch_columns(8)}, {air_columns()} FROM combined"),
    "combined_no_air": sql([TRAFFIC, batch()], f"""SELECT {batch_columns()}, NULL::DOUBLE AS avg_pm25,
  0::BIGINT AS pm25_count, 0::BIGINT AS location_count FROM batch"""),
    "recent_or_all": sql([TRAFFIC, AIR, batch(), hourly()], f"""SELECT 'traffic' AS side, timestamp, count(*) AS n FROM batch
WHERE timestamp >= {AS_OF} - INTERVAL 24 HOUR GROUP BY 2
UNION ALL SELECT 'air', timestamp, count(*) FROM hourly GROUP BY 2"""),
    "aligned_batch": sql(ALIGNED, f"SELECT {batch_columns()} FROM batch_a"),
    "aligned_air": sql(ALIGNED, f"SELECT timestamp, {air_columns()} FROM hourly_a"),
    "aligned_air_locations": sql([*ALIGNED[:5], """placed AS (
  SELECT CASE WHEN date_trunc('hour', timestamp) BETWEEN t - INTERVAL 2 HOUR AND t + INTERVAL 2 HOUR THEN t
              ELSE date_trunc('hour', timestamp) END AS timestamp, location
  FROM air, target WHERE pm25 > 0)"""], """SELECT timestamp, round(any_value(avg_pm25), 8) AS avg_pm25,
  any_value(pm25_count) AS pm25_count, count(DISTINCT location) AS location_count
FROM hourly_a JOIN placed USING (timestamp) GROUP BY timestamp"""),
    "combined_aligned": sql(ALIGNED, f"SELECT {batch_columns(8)}, {air_columns()} FROM combined"),
    "combined_recent_aligned": sql(
        [
            TRAFFIC, AIR, batch(), hourly(),
            f"batch_r AS (SELECT * FROM batch WHERE timestamp >= {AS_OF} - INTERVAL 24 HOUR)",
            f"hourly_r AS (SELECT * FROM hourly WHERE timestamp >= {AS_OF} - INTERVAL 24 HOUR)",
            aligned("batch_r", "hourly_r"), combined("batch_a", "hourly_a"),
        ],
        f"SELECT {batch_columns(8)}, {air_columns()} FROM combined",
    ),
    "combined_too_far_apart": sql(
        [
            TRAFFIC, AIR_LATER, batch(), hourly("air_later"), aligned(), combined("batch_a", "hourly_a"),
        ],
        f"SELECT {batch_columns(8)}, {air_columns()} FROM combined",
    ),
    "coverage": sql(GAPS, """SELECT count(*) AS total_rows, count(avg_speed) AS rows_with_traffic, count(avg_pm25) AS rows_with_air,
  count(*) FILTER (avg_speed IS NOT NULL AND avg_pm25 IS NOT NULL) AS rows_with_both,
  min(timestamp) FILTER (avg_speed IS NOT NULL) AS traffic_start, max(timestamp) FILTER (avg_speed IS NOT NULL) AS traffic_end,
  min(timestamp) FILTER (avg_pm25 IS NOT NULL) AS air_start, max(timestamp) FILTER (avg_pm25 IS NOT NULL) AS air_end,
  count(*) FILTER (avg_speed IS NOT NULL AND avg_pm25 IS NOT NULL) = 0 AND count(avg_pm25) > 0 AS ranges_do_not_overlap
FROM combined"""),
    "critical_flags": sql(GAPS, f"SELECT timestamp, road_segment_id, {CRITICAL_COLUMNS} FROM flagged"),
    "critical_periods": sql(PLAIN, f"""SELECT {batch_columns(8)}, {air_columns()}, {CRITICAL_COLUMNS}
FROM flagged WHERE is_critical"""),
    "critical_periods_aligned": sql(ALIGNED, f"""SELECT {batch_columns(8)}, {air_columns()}, {CRITICAL_COLUMNS}
FROM flagged WHERE is_critical"""),
    "summary_stats": sql(ALIGNED, """SELECT count(*) AS total_records, count(avg_speed) AS records_with_speed,
  round(avg(avg_speed), 6) AS avg_speed_mean, round(min(avg_speed), 6) AS avg_speed_min, round(max(avg_speed), 6) AS avg_speed_max,
  count(avg_pm25) AS records_with_pm25, round(avg(avg_pm25), 6) AS avg_pm25_mean, round(min(avg_pm25), 6) AS avg_pm25_min,
  round(max(avg_pm25), 6) AS avg_pm25_max, count(*) FILTER (is_critical) AS critical_count,
  round(CASE WHEN count(*) > 0 THEN count(*) FILTER (is_critical) / count(*) * 100 ELSE 0 END, 6) AS critical_percentage,
  round(avg(avg_speed) FILTER (is_critical), 6) AS critical_speed_mean,
  round(avg(avg_pm25) FILTER (is_critical), 6) AS critical_pm25_mean,
  round(avg(severity_index) FILTER (is_critical), 6) AS critical_severity_mean
FROM flagged"""),
    "quadrants": sql(GAPS, """SELECT timestamp, road_segment_id, CASE WHEN avg_pm25 IS NULL OR avg_speed IS NULL THEN NULL
  WHEN avg_pm25 > 50 AND avg_speed < 20 THEN 'critical' WHEN avg_pm25 > 50 THEN 'high_pm25_normal_speed'
  WHEN avg_speed < 20 THEN 'low_speed_good_air' ELSE 'normal' END AS quadrant
FROM combined"""),
    "scatter_pairs": sql(GAPS, """SELECT timestamp, road_segment_id, round(avg_speed, 8) AS avg_speed,
  round(avg_pm25, 8) AS avg_pm25, is_critical
FROM flagged WHERE avg_speed IS NOT NULL AND avg_pm25 IS NOT NULL"""),
    "critical_timeline": sql(PLAIN, """SELECT timestamp AS start_time, timestamp + INTERVAL 1 HOUR AS end_time, road_segment_id,
  strftime(timestamp, '%H:%M') AS time_label,
  'PM2.5: ' || printf('%.1f', round(avg_pm25, 1)) || ' µg/m³' || chr(10)
    || 'Speed: ' || printf('%.1f', round(avg_speed, 1)) || ' km/h' AS info,
  round(severity_index, 9) AS severity_index,
  round(0.4::DOUBLE + 0.6::DOUBLE * (severity_index / max(severity_index) OVER ()), 9) AS shade
FROM flagged WHERE is_critical"""),
    "timeline_summary": sql(PLAIN, """SELECT count(*) AS critical_count, round(avg(avg_pm25), 6) AS mean_pm25,
  round(max(avg_pm25), 6) AS max_pm25, round(avg(avg_speed), 6) AS mean_speed, round(min(avg_speed), 6) AS min_speed
FROM flagged WHERE is_critical"""),
    "time_series": sql(GAPS, """SELECT timestamp AS local_time, road_segment_id, round(avg_speed, 8) AS avg_speed,
  round(avg_pm25, 8) AS avg_pm25, 20::DOUBLE AS speed_threshold, 50::DOUBLE AS pm25_threshold, is_critical
FROM flagged"""),
    "top_severe": sql(PLAIN, """SELECT timestamp, road_segment_id, round(severity_index, 10) AS severity_index
FROM flagged WHERE is_critical ORDER BY flagged.severity_index DESC, timestamp, road_segment_id LIMIT 10"""),
    "critical_hour_offsets": sql([AIR, CRITICAL_HOURS], """SELECT timestamp, round(avg_pm25, 8) AS avg_pm25,
  CAST(date_diff('hour', TIMESTAMP '2024-01-10 00:00:00', timestamp) AS BIGINT) AS hour_offset
FROM critical_hours
WHERE timestamp BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-10 00:00:00' + INTERVAL 239 HOUR"""),
    "critical_islands": sql([AIR, CRITICAL_HOURS], runs("critical_hours")),
    "critical_periods_by_segment": sql(
        [*PLAIN, "bad AS (SELECT * FROM flagged WHERE is_critical)"], runs("bad", "road_segment_id")
    ),
    "time_range": sql([AIR], """SELECT date_trunc('hour', min(timestamp)) AS start_hour, date_trunc('hour', max(timestamp)) AS end_hour,
  CAST(date_diff('hour', date_trunc('hour', min(timestamp)), date_trunc('hour', max(timestamp))) + 1 AS BIGINT) AS n_hours
FROM air"""),
    "range_filter": sql([TRAFFIC, AIR], """SELECT * FROM traffic
WHERE timestamp >= (SELECT date_trunc('hour', min(timestamp)) FROM air WHERE pm25 > 200)
  AND timestamp <= (SELECT date_trunc('hour', max(timestamp)) FROM air WHERE pm25 > 200)"""),
    "readings_in_bad_air_hours": sql([TRAFFIC, AIR, CRITICAL_HOURS], """SELECT * FROM traffic
WHERE date_trunc('hour', timestamp) IN (SELECT timestamp FROM critical_hours)"""),
    "readings_in_ok_hours": sql([TRAFFIC, AIR, CRITICAL_HOURS], """SELECT * FROM traffic
WHERE date_trunc('hour', timestamp) NOT IN (SELECT timestamp FROM critical_hours)"""),
    "parse_traffic": sql([PARSED_TRAFFIC], "SELECT event_id, timestamp, segment_id, velocity FROM parsed WHERE reason IS NULL"),
    "parse_traffic_rejected": sql([PARSED_TRAFFIC], "SELECT event_id, reason FROM parsed WHERE reason IS NOT NULL"),
    "parse_traffic_query_point": sql([PARSED_TRAFFIC], """SELECT
  CASE segment_id WHEN 'segment_unknown' THEN 'segment_1077_10667' ELSE segment_id END AS segment_id, count(*) AS readings
FROM parsed WHERE reason IS NULL GROUP BY 1"""),
    "parse_air": sql([PARSED_AIR], "SELECT * FROM air_parsed"),
    "parse_air_rejected": sql([PARSED_AIR], "SELECT ingest_seq, reason FROM parsed WHERE reason IS NOT NULL"),
    "parse_timestamps": sql([STAMPED], """SELECT event_id, clock + to_hours(offset_hours) AS local_time,
  date_trunc('hour', clock + to_hours(offset_hours)) AS local_hour FROM stamped"""),
    "grid_cells": "SELECT " + CELL.format(lat="10 + value / 8", lon="106 + user_id / 16")
    + " AS cell, count(*) AS readings FROM events GROUP BY 1",
    "air_payload_roundtrip": """SELECT date_trunc('second', ts) + INTERVAL 7 HOUR AS timestamp, 'loc_' || user_id AS location, value AS pm25,
  CASE WHEN event_type <> 'error' THEN 10.5::DOUBLE END AS latitude,
  CASE WHEN event_type <> 'error' THEN 106.5::DOUBLE END AS longitude
FROM events""",
    "dedupe_first": sql([AIR], """SELECT date_trunc('hour', timestamp) AS timestamp, location, round(pm25, 6) AS pm25, event_id
FROM air QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', timestamp), location ORDER BY event_id) = 1"""),
    "upsert_last": sql([AIR], """SELECT date_trunc('hour', timestamp) AS timestamp, location, round(pm25, 6) AS pm25, event_id
FROM air
QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', timestamp), location
                           ORDER BY (event_type = 'error')::INT DESC, event_id DESC) = 1"""),
    "latest_reading": sql([TRAFFIC], """SELECT * FROM traffic
QUALIFY row_number() OVER (PARTITION BY segment_id ORDER BY timestamp DESC) = 1"""),
    "distinct_readings": sql(
        [TRAFFIC, "unique_readings AS (SELECT DISTINCT * FROM traffic)", batch("unique_readings")],
        f"SELECT {batch_columns()} FROM batch",
    ),
    "rolling_retention": f"""SELECT event_id FROM events
WHERE event_type IN ('error', 'signup')
   OR date_trunc('second', ts) + CASE event_type WHEN 'view' THEN INTERVAL 7 HOUR ELSE INTERVAL 0 HOUR END
      >= {AS_OF} - INTERVAL 24 HOUR""",
    "sampling_grid": """WITH located AS (
  SELECT 10.755::DOUBLE + c_custkey % 331 / 10000 AS latitude, 106.645::DOUBLE + c_custkey % 431 / 10000 AS longitude FROM customer),
placed AS (
  SELECT CASE WHEN latitude BETWEEN 10.76::DOUBLE AND 10.783::DOUBLE
              THEN CAST(round((latitude - 10.76::DOUBLE) / ((10.783::DOUBLE - 10.76::DOUBLE) / 4)) AS INT) END AS grid_row,
         CASE WHEN longitude BETWEEN 106.65::DOUBLE AND 106.683::DOUBLE
              THEN CAST(round((longitude - 106.65::DOUBLE) / ((106.683::DOUBLE - 106.65::DOUBLE) / 4)) AS INT) END AS grid_col
  FROM located),
counts AS (SELECT grid_row, grid_col, count(*) AS customers FROM placed GROUP BY 1, 2)
SELECT r::INT AS grid_row, c::INT AS grid_col,
  round(10.76::DOUBLE + (10.783::DOUBLE - 10.76::DOUBLE) * r / 4, 6) AS latitude,
  round(106.65::DOUBLE + (106.683::DOUBLE - 106.65::DOUBLE) * c / 4, 6) AS longitude, coalesce(customers, 0) AS customers
FROM range(5) rows(r), range(5) cols(c) LEFT JOIN counts ON grid_row = r AND grid_col = c""",
    "stations_within_radius": sql(
        [station_rows("customer", "c_custkey", "c_name"), DISTANCES],
        "SELECT station_id, name, round(distance_km, 6) AS distance_km FROM distances WHERE distance_km <= 40",
    ),
    "nearest_stations": sql(
        [station_rows("customer", "c_custkey", "c_name"), DISTANCES],
        """SELECT station_id, round(distance_km, 6) AS distance_km FROM distances
WHERE distances.distance_km <= 25 ORDER BY distances.distance_km, station_id LIMIT 10""",
    ),
    "recent_measurements": f"""SELECT event_id, CASE event_type WHEN 'view' THEN 'PM2.5' ELSE 'pm25' END AS parameter,
  ts + INTERVAL 1 HOUR AS datetime_to
FROM events WHERE event_type IN ('view', 'click') AND ts + INTERVAL 1 HOUR >= {AS_OF} - INTERVAL 72 HOUR""",
    "station_enrichment": sql([station_rows("supplier", "s_suppkey", "s_name")], """SELECT e.user_id % 12 AS station_id, event_id,
  CASE WHEN event_type = 'view' THEN 10.5::DOUBLE ELSE latitude END AS latitude,
  CASE WHEN event_type = 'view' THEN 106.5::DOUBLE ELSE longitude END AS longitude, name AS location
FROM events e LEFT JOIN stations s ON e.user_id % 12 = s.station_id"""),
    "partition_columns": """SELECT event_id, year(l)::INT AS year, month(l)::INT AS month, day(l)::INT AS day
FROM (SELECT event_id, ts + INTERVAL 7 HOUR AS l FROM events)""",
    "kafka_records_traffic": sql([PARSED_TRAFFIC], """SELECT CASE event_type WHEN 'signup' THEN 'unknown' WHEN 'purchase' THEN 'unknown'
    WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS key, count(*) AS messages,
  count(*) FILTER (reason IS NULL) AS readings, round(sum(velocity) FILTER (reason IS NULL), 3) AS total_speed
FROM events JOIN parsed USING (event_id) GROUP BY 1"""),
    "kafka_records_air": sql([PARSED_AIR], """SELECT CASE WHEN event_type = 'view' THEN 'loc_' || (user_id % 20)
    WHEN event_type = 'error' AND value BETWEEN 20 AND 100 THEN 'loc_' || (user_id % 20)
    WHEN event_type = 'error' AND value < 20 THEN 'unknown'
    ELSE CAST(value AS VARCHAR) END AS key, count(*) AS messages,
  count(*) FILTER (reason IS NULL) AS measurements, round(sum(pm25) FILTER (reason IS NULL), 3) AS total_pm25
FROM events JOIN parsed ON event_id = ingest_seq GROUP BY 1"""),
    "topic_reload": sql([PARSED_AIR], """SELECT CASE WHEN event_type = 'view' THEN 'loc_' || (user_id % 20)
    WHEN event_type = 'error' AND value BETWEEN 20 AND 100 THEN 'loc_' || (user_id % 20)
    WHEN event_type = 'error' AND value < 20 THEN 'unknown'
    ELSE CAST(value AS VARCHAR) END AS key, count(*) AS messages,
  count(*) FILTER (reason IS NULL) AS measurements, round(sum(pm25) FILTER (reason IS NULL), 3) AS total_pm25, 0::BIGINT AS altered
FROM events JOIN parsed ON event_id = ingest_seq GROUP BY 1"""),
    "topic_drain": sql([PARSED_AIR, """placed AS (
  SELECT ingest_seq % 3 AS partition, row_number() OVER (PARTITION BY ingest_seq % 3 ORDER BY ingest_seq) - 1 AS place,
         ingest_seq % 50 IN (7, 8, 9) AS bad, CASE WHEN reason IS NULL THEN pm25 END AS pm25 FROM parsed)""", """drained AS (
  SELECT *, least((row_number() OVER (ORDER BY place, partition) - 1) // (count(*) OVER () // 3), 2) + 1 AS drain FROM placed)"""],
        """SELECT drain::BIGINT AS drain, partition::INT AS partition, count(*) AS messages, count(*) FILTER (bad) AS undecodable,
  min(place) AS first_offset, max(place) AS last_offset, round(sum(pm25) FILTER (NOT bad), 3) AS total_pm25
FROM drained GROUP BY 1, 2"""),
    "array_file_roundtrip": sql([PARSED_AIR], """SELECT timestamp, location, count(*) AS n, count(*) AS arrivals, round(sum(pm25), 3) AS total_pm25
FROM parsed WHERE reason IS NULL GROUP BY 1, 2"""),
    "broken_files_rejected": sql([PARSED_AIR, """files AS (
  SELECT *, ingest_seq // 500 AS file, (ingest_seq // 500) % 3 AS kind FROM parsed)"""], """SELECT reason, count(*) AS n FROM (
  SELECT coalesce(reason, 'accepted') AS reason FROM files WHERE kind <> 1
  UNION ALL SELECT 'invalid_json' FROM (SELECT DISTINCT file FROM files WHERE kind = 1)
  UNION ALL SELECT 'not_an_object' FROM (SELECT DISTINCT file FROM files WHERE kind = 2), range(3))
GROUP BY 1"""),
    "table_roundtrip": sql([TRAFFIC, batch()], f"""SELECT * REPLACE (timestamp + INTERVAL 7 HOUR AS timestamp),
  year(timestamp + INTERVAL 7 HOUR)::INT AS year, month(timestamp + INTERVAL 7 HOUR)::INT AS month,
  day(timestamp + INTERVAL 7 HOUR)::INT AS day
FROM (SELECT {batch_columns()} FROM batch)"""),
    "csv_roundtrip": sql([TRAFFIC, batch()], f"""SELECT * REPLACE (timestamp + INTERVAL 7 HOUR AS timestamp)
FROM (SELECT {batch_columns()} FROM batch)"""),
    "json_roundtrip": sql([PARSED_TRAFFIC], "SELECT timestamp, segment_id, velocity FROM parsed WHERE reason IS NULL"),
    "pruned_range": sql([TRAFFIC], """SELECT * FROM (
  SELECT timestamp + INTERVAL 7 HOUR AS timestamp, segment_id, velocity FROM traffic)
WHERE timestamp BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-12 18:00:00'"""),
    "source_fallback": sql([AIR], "SELECT timestamp + INTERVAL 7 HOUR AS timestamp, location, round(pm25, 6) AS pm25 FROM air"),
    "migrate_summary": sql(
        [TRAFFIC, AIR, batch(), hourly(), combined(), PARSED_AIR, PARSED_TRAFFIC.replace("parsed AS", "parsed_traffic AS", 1),
         """sizes AS (
  SELECT 'traffic_raw' AS name, count(*) AS rows FROM parsed_traffic WHERE reason IS NULL
  UNION ALL SELECT 'air_raw', count(*) FROM air_parsed UNION ALL SELECT 'batch_view', count(*) FROM batch
  UNION ALL SELECT 'speed_view', count(*) FROM air UNION ALL SELECT 'combined_view', count(*) FROM combined)"""],
        """SELECT run::INT AS run, name, CASE WHEN run = 1 AND name = 'combined_view' THEN 'missing' ELSE 'migrated' END AS status,
  CASE WHEN run = 1 AND name = 'combined_view' THEN 0 ELSE rows END AS rows,
  CASE name WHEN 'combined_view' THEN 2 ELSE 1 END::BIGINT AS attempts
FROM sizes, range(1, 3) runs(run)""",
    ),
    "migrate_datasets": sql(
        [TRAFFIC, AIR, batch(), hourly(), combined(), FLAGGED, PARSED_AIR, PARSED_TRAFFIC.replace("parsed AS", "parsed_traffic AS", 1),
         "shift AS (SELECT INTERVAL 7 HOUR AS h)"],
        """SELECT 'traffic_raw' AS name, timestamp, segment_id AS place, round(velocity, 10) AS first_measure, NULL::DOUBLE AS second_measure
FROM parsed_traffic WHERE reason IS NULL
UNION ALL SELECT 'air_raw', timestamp, location, round(pm25, 10), round(latitude, 10) FROM air_parsed
UNION ALL SELECT 'batch_view', timestamp + h, road_segment_id, round(avg_speed, 10), record_count::DOUBLE FROM batch, shift
UNION ALL SELECT 'speed_view', timestamp + h, location, round(pm25, 10), NULL FROM air, shift
UNION ALL SELECT 'combined_view', timestamp + h, road_segment_id, round(severity_index, 10), round(avg_pm25, 10) FROM flagged, shift""",
    ),
    "overwrite_while_reading": sql([TRAFFIC, batch()], """SELECT 'before' AS side, road_segment_id, count(*) AS n,
  sum(record_count)::BIGINT AS readings, round(max(avg_speed), 6) AS fastest FROM batch GROUP BY 2
UNION ALL SELECT 'after', road_segment_id, count(*), sum(record_count)::BIGINT, round(max(avg_speed), 6)
FROM batch WHERE avg_speed > 50 GROUP BY 2"""),
    "sorted_files": sql([TRAFFIC, batch()], """SELECT year(l)::INT AS year, month(l)::INT AS month, count(*) AS rows,
  0::BIGINT AS rows_out_of_order, 0::BIGINT AS files_overlapping
FROM (SELECT timestamp + INTERVAL 7 HOUR AS l FROM batch) GROUP BY 1, 2"""),
    "create_table_once": sql([TRAFFIC, batch()], """SELECT road_segment_id, 'refused' AS again, count(*) AS n
FROM batch GROUP BY 1"""),
    "columns_validated": sql([TRAFFIC, AIR], """SELECT 'air' AS name, count(*) AS n, 'none' AS missing FROM air
UNION ALL SELECT 'traffic', 0 * count(*), '[''location'', ''pm25'']' FROM traffic"""),
    "stored_view_reused": sql(
        [PARSED_TRAFFIC, "accepted AS (SELECT * FROM parsed WHERE reason IS NULL AND event_id % 2 = 0)", batch("accepted")],
        f"SELECT {batch_columns()} FROM batch",
    ),
    "incremental_batch_view": sql(
        [PARSED_TRAFFIC, "accepted AS (SELECT * FROM parsed WHERE reason IS NULL)", batch("accepted")],
        f"SELECT {batch_columns()} FROM batch",
    ),
    "first_arrival_from_raw": sql([PARSED_AIR], """SELECT timestamp, location, pm25, latitude, longitude FROM parsed WHERE reason IS NULL
QUALIFY row_number() OVER (PARTITION BY timestamp, location ORDER BY ingest_seq % 3, ingest_seq) = 1"""),
    "full_job": sql(
        [FEED, batch("feed_traffic"), hourly("feed_air"), aligned(), combined("batch_a", "hourly_a"), FLAGGED],
        f"SELECT {batch_columns(8)}, {air_columns()}, {CRITICAL_COLUMNS} FROM flagged",
    ),
    "ingest_and_refresh": sql(
        [PARSED_TRAFFIC, "accepted AS (SELECT * FROM parsed WHERE reason IS NULL)", batch("accepted")],
        f"SELECT {batch_columns()} FROM batch",
    ),
    "stream_hourly_air": sql([AIR, hourly()], f"SELECT timestamp, {air_columns()} FROM hourly"),
    "stream_dedupe": sql([AIR], """SELECT date_trunc('hour', timestamp) AS timestamp, location, round(pm25, 6) AS pm25, event_id
FROM air QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', timestamp), location ORDER BY event_id) = 1"""),
    "stream_polling": sql([TRAFFIC], "SELECT * FROM traffic"),
    "stream_speed_view": sql([PARSED_AIR], """SELECT timestamp, location, pm25, latitude, longitude, ingest_seq % 3 AS arrival
FROM parsed WHERE reason IS NULL
QUALIFY row_number() OVER (PARTITION BY timestamp, location ORDER BY ingest_seq % 3 DESC, ingest_seq DESC) = 1"""),
    "stream_rejected": sql([PARSED_AIR], """SELECT ingest_seq % 3 AS batch_id, reason, count(*) AS n,
  CASE reason WHEN 'missing_value' THEN count(DISTINCT timestamp)
              WHEN 'bad_timestamp' THEN count(DISTINCT value) ELSE count(DISTINCT (timestamp, value)) END AS payloads
FROM parsed JOIN events ON event_id = ingest_seq WHERE reason IS NOT NULL GROUP BY 1, 2"""),
    "stream_combined": sql(GAPS[:-1], f"SELECT {batch_columns(8)}, {air_columns()} FROM combined"),
    "stream_upsert": sql([AIR], """SELECT date_trunc('hour', timestamp) AS timestamp, location, round(pm25, 6) AS pm25, event_id
FROM air QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', timestamp), location ORDER BY event_id DESC) = 1"""),
    "stream_retention": f"""SELECT event_id FROM events
WHERE date_trunc('second', ts) >= {AS_OF} - INTERVAL 24 HOUR""",
}

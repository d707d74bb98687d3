"""One query per operator of the blueprint, each over whole test tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogway.functions.spatial import grid_cell
from smogway.functions.timestamps import (
    add_partition_columns,
    floor_to_hour,
    instant_from_wall_clock,
    local_wall_clock,
    parse_timestamp,
    prune,
    time_bucket,
    utc_wall_clock,
)
from smogway.operators import aggregates as A
from smogway.operators import critical as C
from smogway.operators import filters as FL
from smogway.operators import integrate as I
from smogway.operators import parsing as P
from smogway.operators import quality as Q
from smogway.operators import stations as S
from smogway.plans import jobs, live
from smogway.schemas import BATCH_VIEW, LIVE_VIEW, READINGS, SPEED_VIEW, names
from smogway.sources import drain, files, tables, topics, windows
from smogway.sources.staging import fresh_path, stage
from smogway.streaming import sinks
from suite import tables as src

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round doubles, as two engines add them up in different orders."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, special.get(c, digits)) for c in doubles})


def stored(readings: DataFrame, measurements: DataFrame, width: str = "1 hour") -> tuple[DataFrame, DataFrame]:
    """Both hourly views behind the layer boundary: raw data is read once, the views several times."""
    return stage(A.hourly_traffic(readings, width), "batch-view"), stage(A.hourly_air(measurements, width), "hourly-air")


def views(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return stored(src.traffic(spark, d), src.air(spark, d))


def views_with_outages(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The traffic view ends, and the air view begins, hours before the other; every row is in."""
    return stored(src.traffic(spark, d), src.later(src.air(spark, d)))


def flagged(spark: SparkSession, d: str) -> DataFrame:
    return C.flag_critical(I.combine(*views(spark, d), aligned=False))


# --- aggregation -------------------------------------------------------------------------------


@query
def hourly_traffic_by_segment(spark, d):
    return rounded(A.hourly_traffic(src.traffic(spark, d)))


@query
def hourly_traffic_overall(spark, d):
    return rounded(A.hourly_traffic(src.traffic(spark, d).drop("segment_id")))


@query
def hourly_air_quality(spark, d):
    return rounded(A.hourly_air(src.air(spark, d)), 8)


@query
def time_of_day_profile(spark, d):
    return rounded(A.time_of_day_profile(src.traffic(spark, d)), 5)


@query
def time_of_day_profile_fine(spark, d):
    return rounded(A.time_of_day_profile(src.traffic(spark, d), A.fine_day_band), 5)


@query
def day_grain_volume(spark, d):
    daily = stored(src.daily_traffic(spark, d), src.daily_air(spark, d), "1 day")
    combined = C.flag_critical(I.combine(*daily, aligned=False))
    return rounded(combined, severity_index=9)


# --- integration -------------------------------------------------------------------------------


@query
def combined_outer(spark, d):
    return rounded(I.combine(*views_with_outages(spark, d), aligned=False), 8)


@query
def combined_no_air(spark, d):
    broken = src.air(spark, d).withColumn("pm25", F.lit(-999.0))
    return rounded(I.combine(*stored(src.traffic(spark, d), broken), aligned=False))


@query
def recent_or_all(spark, d):
    batch, air = views(spark, d)
    recent = FL.recent_or_all(batch.select("timestamp"), src.AS_OF)
    everything = FL.recent_or_all(air.select("timestamp"), "2024-03-01 00:00:00")
    both = recent.withColumn("side", F.lit("traffic")).unionByName(everything.withColumn("side", F.lit("air")))
    return both.groupBy("side", "timestamp").agg(F.count(F.lit(1)).alias("n"))


@query
def aligned_batch(spark, d):
    return rounded(I.align(*views(spark, d))[0])


@query
def aligned_air(spark, d):
    return rounded(I.align(*views(spark, d))[1], 8)


@query
def aligned_air_locations(spark, d):
    """Merged hours with distinct locations, from the sketches of the hours."""
    air = stage(A.hourly_air(src.air(spark, d), sketch=True), "hourly-air")
    batch = stage(A.hourly_traffic(src.traffic(spark, d)), "batch-view")
    return rounded(I.align(batch, air)[1].drop("location_sketch"), 8)


@query
def combined_aligned(spark, d):
    return rounded(I.combine(*views(spark, d)), 8)


@query
def combined_recent_aligned(spark, d):
    return rounded(I.combine(*views(spark, d), as_of=src.AS_OF), 8)


@query
def combined_too_far_apart(spark, d):
    return rounded(I.combine(*views_with_outages(spark, d)), 8)


@query
def coverage(spark, d):
    return I.coverage(I.combine(*views_with_outages(spark, d), aligned=False))


# --- critical periods and reports ---------------------------------------------------------------


@query
def critical_flags(spark, d):
    combined = C.flag_critical(I.combine(*views_with_outages(spark, d), aligned=False))
    return rounded(combined.select("timestamp", "road_segment_id", "is_critical", "severity_index"), 10)


@query
def critical_periods(spark, d):
    return rounded(C.critical_only(flagged(spark, d)), 8, severity_index=10)


@query
def critical_periods_aligned(spark, d):
    combined = I.combine(*views(spark, d))
    return rounded(C.critical_only(C.flag_critical(combined)), 8, severity_index=10)


@query
def summary_stats(spark, d):
    return rounded(C.summary_stats(stage(C.flag_critical(I.combine(*views(spark, d))), "combined")))


@query
def quadrants(spark, d):
    combined = C.quadrant(I.combine(*views_with_outages(spark, d), aligned=False))
    return combined.select("timestamp", "road_segment_id", "quadrant")


@query
def scatter_pairs(spark, d):
    pairs = C.scatter_pairs(C.flag_critical(I.combine(*views_with_outages(spark, d), aligned=False)))
    return rounded(pairs.select("timestamp", "road_segment_id", "avg_speed", "avg_pm25", "is_critical"), 8)


@query
def critical_timeline(spark, d):
    return rounded(C.critical_timeline(stage(flagged(spark, d), "combined")), 9)


@query
def timeline_summary(spark, d):
    return rounded(C.timeline_summary(flagged(spark, d)))


@query
def time_series(spark, d):
    series = C.time_series(C.flag_critical(I.combine(*views_with_outages(spark, d), aligned=False)))
    return rounded(series, 8)


@query
def top_severe(spark, d):
    top = C.top_severe(flagged(spark, d), 10)
    return rounded(top.select("timestamp", "road_segment_id", "severity_index"), 10)


@query
def critical_hour_offsets(spark, d):
    return rounded(A.critical_hours(src.air(spark, d), "2024-01-10 00:00:00", 240), 8)


@query
def critical_islands(spark, d):
    return C.consecutive_periods(A.critical_hours(src.air(spark, d)))


@query
def critical_periods_by_segment(spark, d):
    return C.consecutive_periods(C.critical_only(flagged(spark, d)), ["road_segment_id"])


@query
def time_range(spark, d):
    return FL.hour_range(src.air(spark, d))


@query
def range_filter(spark, d):
    severe = src.air(spark, d).where(F.col("pm25") > 200)
    return FL.within_range_of(src.traffic(spark, d), severe)


def bad_air_hours(spark: SparkSession, d: str) -> DataFrame:
    # Staged, so that the planner knows its true size and need not shuffle the readings to join it.
    return stage(A.critical_hours(src.air(spark, d)), "bad-hours")


@query
def readings_in_bad_air_hours(spark, d):
    return C.in_hours(src.traffic(spark, d), bad_air_hours(spark, d))


@query
def readings_in_ok_hours(spark, d):
    return C.in_hours(src.traffic(spark, d), bad_air_hours(spark, d), inside=False)


# --- parsing -----------------------------------------------------------------------------------


def _local(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", local_wall_clock(F.col("timestamp")))


@query
def parse_traffic(spark, d):
    return _local(P.parse_traffic(src.raw_traffic(spark, d), src.AS_OF).accepted)


@query
def parse_traffic_rejected(spark, d):
    classified = P.classify_traffic(src.raw_traffic(spark, d), src.AS_OF)
    return classified.where(F.col("reason").isNotNull()).select("event_id", "reason")


@query
def parse_traffic_query_point(spark, d):
    raw = src.raw_traffic(spark, d)
    parsed = P.parse_traffic(raw, src.AS_OF, query_lat=F.lit(10.7715), query_lon=F.lit(106.6664))
    return parsed.accepted.groupBy("segment_id").agg(F.count(F.lit(1)).alias("readings"))


@query
def parse_air(spark, d):
    return _local(P.air_measurements(src.raw_air(spark, d)))


@query
def parse_air_rejected(spark, d):
    classified = P.classify_air(src.raw_air(spark, d))
    return classified.where(F.col("reason").isNotNull()).select("ingest_seq", "reason")


@query
def parse_timestamps(spark, d):
    clock = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = (
        F.when(F.col("event_type") == "view", F.concat(clock, F.lit("Z")))
        .when(F.col("event_type") == "click", F.concat(clock, F.lit("+07:00")))
        .when(F.col("event_type") == "signup", clock)
        .when(F.col("event_type") == "purchase", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.lit("05:00"))
    )
    stamped = src.events(spark, d).select("event_id", text.alias("timestamp"))
    parsed = parse_timestamp(stamped).withColumn("local_time", local_wall_clock(F.col("timestamp")))
    return floor_to_hour(parsed.drop("timestamp").withColumn("local_hour", F.col("local_time")), "local_hour")


@query
def grid_cells(spark, d):
    located = src.events(spark, d).select(
        (F.lit(10) + F.col("value") / 8).alias("lat"), (F.lit(106) + F.col("user_id") / 16).alias("lon")
    )
    cells = located.select(grid_cell(F.col("lat"), F.col("lon")).alias("cell"))
    return cells.groupBy("cell").agg(F.count(F.lit(1)).alias("readings"))


@query
def air_payload_roundtrip(spark, d):
    clock = "yyyy-MM-dd'T'HH:mm:ss"
    one_hour, seven_hours = F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 7 HOURS")

    def utc(ts):
        return F.concat(F.date_format(ts, clock), F.lit("Z"))

    def local(ts):
        return F.concat(F.date_format(ts + seven_hours, clock), F.lit("+07:00"))

    ts = F.col("ts")
    flat = src.events(spark, d).select(
        utc(ts).alias("utc_from"), local(ts).alias("local_from"),
        utc(ts + one_hour).alias("utc_to"), local(ts + one_hour).alias("local_to"),
        "value", F.lit("pm25").alias("parameter"),
        F.when(F.col("event_type") != "error", F.lit(10.5)).alias("latitude"),
        F.when(F.col("event_type") != "error", F.lit(106.5)).alias("longitude"),
        F.concat(F.lit("loc_"), F.col("user_id")).alias("location"),
    )
    return _local(P.parse_air(P.air_payload(flat)).accepted)


# --- dedupe, upsert, retention -------------------------------------------------------------------


@query
def dedupe_first(spark, d):
    measured = src.hourly_measurements(spark, d).drop("event_type")
    return rounded(Q.dedupe_first(measured, ["timestamp", "location"], ["event_id"]))


@query
def upsert_last(spark, d):
    measured = src.hourly_measurements(spark, d)
    is_new = F.col("event_type") == "error"
    existing, new = measured.where(~is_new), measured.where(is_new)
    merged = Q.upsert(existing, new, ["timestamp", "location"], ["event_id"])
    return rounded(merged.drop("event_type"))


@query
def latest_reading(spark, d):
    return Q.latest_per_key(src.traffic(spark, d), ["segment_id"], ["timestamp"])


@query
def distinct_readings(spark, d):
    readings = src.traffic(spark, d)
    replayed = readings.unionByName(readings)
    return rounded(A.hourly_traffic(Q.distinct_readings(replayed)))


@query
def rolling_retention(spark, d):
    """A collector that adds one kind of response after the other to the window."""
    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    fetched = (
        F.when(F.col("event_type") == "view", F.concat(clock, F.lit("Z")))
        .when(F.col("event_type") == "error", F.lit("bad"))
        .when(F.col("event_type") == "signup", F.lit(None))
        .otherwise(clock)
    )
    responses = src.events(spark, d).select("event_id", "event_type", fetched.alias("_fetched_at"))
    window = windows.Window(fresh_path(spark, "window"), responses.schema)
    for i, kind in enumerate(src.TRAFFIC_TYPES + src.AIR_TYPES):
        windows.collect_window(responses.where(F.col("event_type") == kind), window, i, src.AS_OF)
    return windows.read_window(spark, window, src.AS_OF).select("event_id")


# --- stations ----------------------------------------------------------------------------------


@query
def sampling_grid(spark, d):
    located = src.table(spark, d, "customer").select(
        "c_custkey",
        (F.lit(10.755) + F.col("c_custkey") % 331 / 10000).alias("latitude"),
        (F.lit(106.645) + F.col("c_custkey") % 431 / 10000).alias("longitude"),
    )
    nearest = S.nearest_grid_point(located).groupBy("grid_row", "grid_col").agg(
        F.count(F.lit(1)).alias("customers")
    )
    grid = S.sampling_grid(spark).join(nearest, ["grid_row", "grid_col"], "left")
    return rounded(grid.withColumn("customers", F.coalesce("customers", F.lit(0))))


@query
def stations_within_radius(spark, d):
    near = S.stations_within_radius(src.stations(spark, d, "customer", "c"), radius_km=40)
    return rounded(near.select("station_id", "name", "distance_km"))


@query
def nearest_stations(spark, d):
    near = S.stations_within_radius(src.stations(spark, d, "customer", "c"), radius_km=25, max_locations=10)
    return rounded(near.select("station_id", "distance_km"))


@query
def recent_measurements(spark, d):
    measured = src.events(spark, d).select(
        "event_id", F.col("event_type").alias("parameter"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("datetime_to"),
    )
    as_pollutant = measured.withColumn(
        "parameter", F.when(F.col("parameter") == "view", "PM2.5").when(F.col("parameter") == "click", "pm25").otherwise("pm10")
    )
    return FL.ended_since(FL.pm25_sensors(as_pollutant), src.AS_OF, 72)


@query
def station_enrichment(spark, d):
    measured = src.events(spark, d).select(
        "event_id",
        (F.col("user_id") % 12).alias("station_id"),
        F.when(F.col("event_type") == "view", F.lit(10.5)).alias("latitude"),
        F.when(F.col("event_type") == "view", F.lit(106.5)).alias("longitude"),
    )
    return S.enrich_with_station(measured, src.stations(spark, d))


# --- sources and sinks ---------------------------------------------------------------------------


@query
def partition_columns(spark, d):
    stamped = src.events(spark, d).select("event_id", instant_from_wall_clock(F.col("ts")).alias("timestamp"))
    return add_partition_columns(stamped).select("event_id", "year", "month", "day")


@query
def kafka_records_traffic(spark, d):
    read_back = P.classify_traffic(topics.traffic_records(src.raw_traffic(spark, d)), src.AS_OF)
    good = F.col("reason").isNull()
    return read_back.groupBy("key").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(good).alias("readings"),
        F.round(F.sum(F.when(good, F.col("velocity"))), 3).alias("total_speed"),
    )


@query
def kafka_records_air(spark, d):
    return _of_messages(P.classify_air(topics.air_records(src.raw_air(spark, d))))


def _write_arrays(spark: SparkSession, d: str, body=lambda whole, file: whole) -> str:
    """Raw air measurements as array files of 500 records each; `body` may alter a file."""
    path = fresh_path(spark, "arrays")
    records = src.raw_air(spark, d).withColumn("file", F.floor(F.col("ingest_seq") / 500))
    whole = records.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value"))
    # one folder: folders of one file each would be made, listed and scheduled one by one
    whole.select(body(F.col("value"), F.col("file")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


def _array_files(spark: SparkSession, d: str, body=lambda whole, file: whole) -> DataFrame:
    return files.read_raw(spark, _write_arrays(spark, d, body), "array")


@query
def topic_reload(spark, d):
    """Raw files sent to a topic and read back: what each key holds, and how many payloads are not as they were."""
    source, topic = _write_arrays(spark, d), fresh_path(spark, "topic")
    topics.load_file(spark, source, topics.air_records, topics.AIR_TOPIC, fmt="parquet", path=topic)
    sent = spark.read.schema("key string, value string").parquet(topic)
    of_value = F.xxhash64("value").alias("h")
    there = files.read_raw(spark, source, "array").groupBy(of_value).agg(F.count(F.lit(1)).alias("n"))
    back = sent.groupBy(of_value).agg(F.count(F.lit(1)).alias("m"))
    altered = there.join(back, "h", "full_outer").where(~F.col("n").eqNullSafe(F.col("m"))).agg(F.count(F.lit(1))).scalar()
    return _of_messages(P.classify_air(sent)).withColumn("altered", altered)


def _of_messages(read_back: DataFrame) -> DataFrame:
    good = F.col("reason").isNull()
    return read_back.groupBy("key").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(good).alias("measurements"),
        F.round(F.sum(F.when(good, F.col("pm25"))), 3).alias("total_pm25"),
    )


@query
def topic_drain(spark, d):
    """A stored message table of three partitions, drained in three parts and once more; some bodies are no JSON."""
    place = F.row_number().over(Window.partitionBy("partition").orderBy("ingest_seq"))
    kind = F.col("ingest_seq") % 50
    body = (
        F.when(kind == 7, F.unhex(F.lit("FFFE"))).when(kind == 8, F.encode(F.lit('{"value":'), "utf-8"))
        .when(kind == 9, F.lit(None).cast("binary")).otherwise(F.encode("value", "utf-8"))
    )
    sent = src.raw_air(spark, d).withColumn("partition", (F.col("ingest_seq") % 3).cast("int"))
    messages = stage(sent.select(
        F.lit(topics.AIR_TOPIC).alias("topic"), "partition", (place - 1).cast("long").alias("offset"),
        F.timestamp_seconds("ingest_seq").alias("timestamp"), F.lit(None).cast("binary").alias("key"), body.alias("value"),
    ), "messages")
    layout, part = tables.Layout(fresh_path(spark, "drained")), messages.count() // 3
    for size in (part, part, None, None):
        drain.drain_topic(messages, layout, topics.AIR_TOPIC, "views", size)
    good = P.classify_air(tables.read_table(spark, layout.messages(topics.AIR_TOPIC)))
    bad = tables.read_table(spark, layout.undecodable(topics.AIR_TOPIC))
    both = good.select("drain", "partition", "offset", F.when(F.col("reason").isNull(), F.col("pm25")).alias("pm25"), F.lit(0).alias("bad"))
    both = both.unionByName(bad.select("drain", "partition", "offset", F.lit(None).cast("double").alias("pm25"), F.lit(1).alias("bad")))
    return both.groupBy("drain", "partition").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("bad").alias("undecodable"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"), F.round(F.sum("pm25"), 3).alias("total_pm25"),
    )


@query
def array_file_roundtrip(spark, d):
    parsed = _local(P.parse_air(_array_files(spark, d)).accepted)
    return parsed.groupBy("timestamp", "location").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("ingest_seq").alias("arrivals"),
        F.round(F.sum("pm25"), 3).alias("total_pm25"),
    )


@query
def broken_files_rejected(spark, d):
    """Every third file is cut off, every third has elements that are no objects; none may vanish."""

    def body(whole, file):
        cut = F.substring(whole, F.lit(1), F.length(whole) - 1)
        return F.when(file % 3 == 1, cut).when(file % 3 == 2, F.concat(cut, F.lit(',7,"x",null]'))).otherwise(whole)

    reasons = P.classify_air(_array_files(spark, d, body)).select(F.coalesce("reason", F.lit("accepted")).alias("reason"))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _batch_view_spec(spark: SparkSession, fmt: str, *partition_by: str) -> tables.TableSpec:
    return tables.TableSpec(fresh_path(spark, f"table-{fmt}"), BATCH_VIEW, partition_by, fmt)


def _batch_view_instants(spark: SparkSession, d: str) -> DataFrame:
    return A.hourly_traffic(src.as_instant(src.traffic(spark, d)))


@query
def table_roundtrip(spark, d):
    spec = _batch_view_spec(spark, "parquet", "year", "month")
    tables.write_table(_batch_view_instants(spark, d), spec)
    return rounded(_local(tables.read_table(spark, spec)))


@query
def csv_roundtrip(spark, d):
    spec = _batch_view_spec(spark, "csv")
    tables.write_table(_batch_view_instants(spark, d), spec)
    return rounded(_local(tables.read_table(spark, spec)))


@query
def json_roundtrip(spark, d):
    path = fresh_path(spark, "raw")
    files.write_raw(src.raw_traffic(spark, d), path)
    parsed = P.parse_traffic(files.read_raw(spark, path), src.AS_OF).accepted
    return _local(parsed.select("timestamp", "segment_id", "velocity"))


@query
def pruned_range(spark, d):
    from datetime import datetime

    layout = tables.Layout(fresh_path(spark, "pruned"))
    readings = src.as_instant(src.traffic(spark, d))
    tables.write_table(readings, layout.traffic_raw)
    stored = tables.read_table(spark, layout.traffic_raw)
    window = prune(stored, datetime(2024, 1, 10, 6), datetime(2024, 1, 12, 18))
    return _local(window.select("timestamp", "segment_id", "velocity"))


@query
def source_fallback(spark, d):
    layout = tables.Layout(fresh_path(spark, "fallback"))
    tables.write_table(src.as_instant(src.air(spark, d)), layout.air_raw)
    found = tables.read_first_available(spark, [layout.speed_view, layout.air_raw], SPEED_VIEW)
    return rounded(_local(found.select("timestamp", "location", "pm25")))


@query
def overwrite_while_reading(spark, d):
    """A table replaced from itself: a reader that began before has the old rows, one that begins after the new ones."""
    spec = _batch_view_spec(spark, "parquet", "year", "month")
    tables.write_table(_batch_view_instants(spark, d), spec)
    before = tables.read_table(spark, spec)
    tables.write_table(before.where("avg_speed > 50"), spec)
    sides = [("before", before), ("after", tables.read_table(spark, spec))]
    return _union(rounded(t.groupBy("road_segment_id").agg(
        F.lit(name).alias("side"), F.count(F.lit(1)).alias("n"), F.sum("record_count").alias("readings"), F.max("avg_speed").alias("fastest")
    )) for name, t in sides)


def _union(frames) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


@query
def sorted_files(spark, d):
    """The stored view read back by file and row: rows out of order in a file, and files of a month that overlap."""
    layout = tables.Layout(fresh_path(spark, "sorted"))
    tables.write_table(_batch_view_instants(spark, d), layout.batch_view)
    place = F.struct("timestamp", "road_segment_id")
    stored = tables.read_table(spark, layout.batch_view).select(
        "year", "month", place.alias("place"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    before = F.lag("place").over(Window.partitionBy("file").orderBy("row"))
    of_files = stored.withColumn("inverted", F.coalesce(before > F.col("place"), F.lit(False)).cast("int")).groupBy("year", "month", "file").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("inverted").alias("inverted"), F.min("place").alias("lo"), F.max("place").alias("hi")
    )
    last = F.max("hi").over(Window.partitionBy("year", "month").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1))
    overlaps = of_files.withColumn("overlaps", F.coalesce(last >= F.col("lo"), F.lit(False)).cast("int"))
    return overlaps.groupBy("year", "month").agg(
        F.sum("rows").alias("rows"), F.sum("inverted").alias("rows_out_of_order"), F.sum("overlaps").alias("files_overlapping")
    )


@query
def create_table_once(spark, d):
    """A table is created with its rows; creating it again fails and leaves it as it is."""
    spec = _batch_view_spec(spark, "parquet", "year", "month")
    view = _batch_view_instants(spark, d)
    tables.create_table(view, spec)
    try:
        tables.create_table(view.limit(1), spec)
        again = "replaced"
    except AnalysisException:
        again = "refused"
    return tables.read_table(spark, spec).groupBy("road_segment_id").agg(F.lit(again).alias("again"), F.count(F.lit(1)).alias("n"))


@query
def columns_validated(spark, d):
    """Frames with and without the columns an operator needs: how many rows pass, or which columns are missing."""
    required = ["timestamp", "location", "pm25"]

    def outcome(name: str, frame: DataFrame) -> DataFrame:
        try:
            return Q.validate_columns(frame, required, name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.lit("none").alias("missing"))
        except ValueError as error:
            return frame.agg(F.lit(name).alias("name"), F.lit(0).cast("long").alias("n"), F.lit(str(error).split(": ", 1)[1]).alias("missing"))

    return outcome("air", src.air(spark, d)).unionByName(outcome("traffic", src.traffic(spark, d)))


def _old_files(spark: SparkSession, d: str) -> dict[str, str]:
    """The five datasets as an older installation keeps them: two files of raw JSON, three CSV views."""
    base = fresh_path(spark, "old-files")
    paths = {n: f"{base}/{n}" for n in ("traffic_raw", "air_raw", "batch_view", "speed_view", "combined_view")}
    files.write_raw(src.raw_traffic(spark, d), paths["traffic_raw"])
    files.write_raw(src.raw_air(spark, d), paths["air_raw"])
    air = src.as_instant(src.air(spark, d))
    view = stage(_batch_view_instants(spark, d), "batch-view")
    empty = F.lit(None).cast("double")
    files.write_csv_view(view, paths["batch_view"])
    files.write_csv_view(air.withColumns({"latitude": empty, "longitude": empty}), paths["speed_view"])
    combined = C.flag_critical(I.combine(view, stage(A.hourly_air(air), "hourly-air"), aligned=False))
    files.write_csv_view(combined, paths["combined_view"])
    return paths


@query
def migrate_summary(spark, d):
    """A migration whose first run finds a file missing, and the second, after the file has come, does only the rest."""
    layout, paths = tables.Layout(fresh_path(spark, "migrated")), _old_files(spark, d)
    moved = paths | {"combined_view": paths["combined_view"] + "-not-yet"}
    first = jobs.migrate_all(spark, jobs.file_datasets(spark, moved, layout, src.AS_OF, "lines"), ledger=layout.migrations)
    second = jobs.migrate_all(spark, jobs.file_datasets(spark, paths, layout, src.AS_OF, "lines"), ledger=layout.migrations)
    tried = tables.read_table(spark, layout.migrations).groupBy("name").agg(F.count(F.lit(1)).alias("attempts"))
    outcomes = _union(r.select(F.lit(run).alias("run"), "name", "status", "rows") for run, r in ((1, first), (2, second)))
    return outcomes.join(tried, "name")


@query
def migrate_datasets(spark, d):
    """Everything that the five migrated tables hold."""
    layout, paths = tables.Layout(fresh_path(spark, "migrated")), _old_files(spark, d)
    jobs.migrate_all(spark, jobs.file_datasets(spark, paths, layout, src.AS_OF, "lines"), ledger=layout.migrations)
    shown = {  # table: which columns are its place and its two measures
        "traffic_raw": ("segment_id", "velocity", None), "air_raw": ("location", "pm25", "latitude"),
        "batch_view": ("road_segment_id", "avg_speed", "record_count"), "speed_view": ("location", "pm25", "latitude"),
        "combined_view": ("road_segment_id", "severity_index", "avg_pm25"),
    }
    measure = lambda c: F.round(F.col(c).cast("double") if c else F.lit(None).cast("double"), 10)
    return _union(_local(tables.read_table(spark, getattr(layout, name))).select(
        F.lit(name).alias("name"), "timestamp", F.col(place).alias("place"), measure(a).alias("first_measure"), measure(b).alias("second_measure")
    ) for name, (place, a, b) in shown.items())


# --- jobs --------------------------------------------------------------------------------------


@query
def full_job(spark, d):
    layout = tables.Layout(fresh_path(spark, "full"))
    result = jobs.run_full(spark, layout, src.sensor_feed_traffic(spark, d), src.sensor_feed_air(spark, d), src.AS_OF)
    return rounded(_local(result.combined), 8, severity_index=10)


@query
def ingest_and_refresh(spark, d):
    layout = tables.Layout(fresh_path(spark, "ingest"))
    jobs.ingest_traffic(src.raw_traffic(spark, d), layout, src.AS_OF)
    view = jobs.run_batch(spark, layout)
    return rounded(_local(view.select(*names(BATCH_VIEW))))


@query
def stored_view_reused(spark, d):
    """Without `refresh` the stored view comes back, though the raw table has gained readings since."""
    layout, readings = tables.Layout(fresh_path(spark, "reused")), src.raw_traffic(spark, d)
    early = F.col("event_id") % 2 == 0
    jobs.ingest_traffic(readings.where(early), layout, src.AS_OF)
    jobs.run_batch(spark, layout)
    jobs.ingest_traffic(readings.where(~early), layout, src.AS_OF)
    return rounded(_local(jobs.run_batch(spark, layout, refresh=False).select(*names(BATCH_VIEW))))


@query
def incremental_batch_view(spark, d):
    """Three appends in no order of time, each followed by a refresh of what it touched."""
    layout, readings = tables.Layout(fresh_path(spark, "incremental")), src.raw_traffic(spark, d)
    for part in range(3):
        jobs.ingest_traffic(readings.where(F.col("event_id") % 3 == part), layout, src.AS_OF)
        view = jobs.refresh_batch(spark, layout)
    return rounded(_local(view.select(*names(BATCH_VIEW))))


@query
def first_arrival_from_raw(spark, d):
    """The raw air table filled by three appends: of a repeated measurement the first append counts."""
    layout, raw = tables.Layout(fresh_path(spark, "first-arrival")), src.raw_air(spark, d)
    for part in range(3):
        jobs.ingest_air(raw.where(F.col("ingest_seq") % 3 == part), layout)
    return _local(jobs.run_speed(spark, layout).select(*names(SPEED_VIEW)))


# --- streaming ---------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = src.events(spark, d).schema
    return sinks.file_stream(spark, d, schema, glob="events.parquet")


def _event_batches(spark: SparkSession, d: str) -> DataFrame:
    """The events as several micro-batches, in no order of time."""
    path, events = fresh_path(spark, "event-files"), src.events(spark, d)
    events.repartition(3).write.parquet(path)
    return sinks.file_stream(spark, path, events.schema, maxFilesPerTrigger=1)


def _in_three_files(spark: SparkSession, rows: DataFrame, part: Column) -> DataFrame:
    """All rows as a stream of three micro-batches: those whose `part` is 0, 1 and 2."""
    path = fresh_path(spark, "three-files")
    for i in range(3):
        rows.where(part == i).coalesce(1).write.mode("append").parquet(path)
    return sinks.file_stream(spark, path, rows.schema, maxFilesPerTrigger=1)


def _partials(spark: SparkSession, stream: DataFrame, aggregate, merge, label: str) -> DataFrame:
    """The partial aggregates of all micro-batches, merged into one folder in between."""
    path, checkpoint = fresh_path(spark, label), fresh_path(spark, f"{label}-checkpoint")
    sinks.run_until_done(lambda: sinks.partials_stream(stream, aggregate, path, checkpoint))
    schema = aggregate(spark.createDataFrame([], stream.schema)).schema
    sinks.compact_partials(spark, path, schema, merge)
    return sinks.read_partials(spark, path, schema)


@query
def stream_hourly_air(spark, d):
    air = src.as_instant(src.as_air(_event_batches(spark, d)))
    hourly = A.merge_air(_partials(spark, air, A.air_by_location, A.merge_air_sums, "stream-air"))
    return rounded(hourly.withColumn("timestamp", utc_wall_clock(F.col("timestamp"))), 8)


@query
def stream_dedupe(spark, d):
    """The first arrival of every hour and place, over micro-batches that arrive in the order of events."""
    events = src.events(spark, d)
    end = events.agg(F.max("event_id") + 1).scalar()
    arriving = _in_three_files(spark, events, F.floor(F.col("event_id") * 3 / end))
    stamped = src.as_instant(src.as_air(arriving, "event_id")).withColumn("timestamp", time_bucket("timestamp"))
    schema = T.StructType([*stamped.schema.fields, T.StructField("batch_id", T.LongType())])
    spec = tables.TableSpec(fresh_path(spark, "stream-first"), schema, ("year", "month", "day", "batch_id"))
    checkpoint = fresh_path(spark, "stream-first-checkpoint")
    sinks.run_until_done(lambda: sinks.first_arrivals_stream(stamped, spec, checkpoint))
    kept = tables.read_table(spark, spec).select("timestamp", "location", "pm25", "event_id")
    return rounded(kept.withColumn("timestamp", utc_wall_clock(F.col("timestamp"))))


@query
def stream_combined(spark, d):
    events = _event_batches(spark, d)
    readings, air = src.as_instant(src.as_traffic(events)), src.as_instant(src.later(src.as_air(events)))
    batch = A.merge_traffic(_partials(spark, readings, A.traffic_by_segment, A.merge_traffic_sums, "stream-roads"))
    hourly = A.merge_air(_partials(spark, air, A.air_by_location, A.merge_air_sums, "stream-sensors"))
    joined = I.combine(stage(batch, "batch-view"), stage(hourly, "hourly-air"), aligned=False)
    return rounded(joined.withColumn("timestamp", utc_wall_clock(F.col("timestamp"))), 8)


@query
def stream_upsert(spark, d):
    measured = src.as_instant(src.as_air(_event_stream(spark, d), "event_id"))
    stamped = measured.withColumn("timestamp", time_bucket("timestamp"))
    schema = T.StructType(stamped.schema.fields)
    spec = tables.TableSpec(fresh_path(spark, "stream-view"), schema, ("year", "month", "day"))
    checkpoint = fresh_path(spark, "stream-view-checkpoint")
    sinks.run_until_done(lambda: sinks.upsert_stream(stamped, spec, checkpoint, order_by=["event_id"]))
    view = tables.read_table(spark, spec).drop("year", "month", "day")
    return rounded(view.withColumn("timestamp", utc_wall_clock(F.col("timestamp"))))


@query
def stream_polling(spark, d):
    """A polling query stopped after its third micro-batch, by when it has appended every reading."""
    readings = src.as_instant(src.as_traffic(_event_batches(spark, d)))
    spec = tables.TableSpec(fresh_path(spark, "polled"), READINGS)
    often = {"processingTime": "200 milliseconds"}
    query = sinks.append_stream(readings, spec, fresh_path(spark, "polled-checkpoint"), often)
    sinks.run_batches(query, 3, 0.2)
    return tables.read_table(spark, spec).withColumn("timestamp", utc_wall_clock(F.col("timestamp")))


def _live(spark: SparkSession, d: str) -> tables.Layout:
    """The continuous air job over three files of raw records, late ones and corrections among them."""
    layout, raw = tables.Layout(fresh_path(spark, "live")), src.raw_air(spark, d)
    arriving = _in_three_files(spark, raw, F.col("ingest_seq") % 3)
    checkpoint = fresh_path(spark, "live-checkpoint")
    live.keep_running(lambda: live.run_speed_stream(arriving, layout, checkpoint, sinks.DRAIN), restarts=0)
    return layout


@query
def stream_speed_view(spark, d):
    return _local(tables.read_table(spark, _live(spark, d).live_view).select(*names(LIVE_VIEW)))


@query
def stream_rejected(spark, d):
    rejected = tables.read_table(spark, _live(spark, d).air_rejected)
    return rejected.groupBy("batch_id", "reason").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("raw").alias("payloads"))


@query
def stream_retention(spark, d):
    responses = _event_batches(spark, d).select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("_fetched_at"))
    window = windows.Window(fresh_path(spark, "stream-window"), responses.schema)
    checkpoint = fresh_path(spark, "stream-window-checkpoint")
    sinks.run_until_done(lambda: sinks.retained_stream(responses, window, checkpoint, lambda: src.AS_OF))
    return windows.read_window(spark, window, src.AS_OF).select("event_id")

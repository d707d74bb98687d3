import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogway.operators.aggregates import air_by_location, hourly_air, hourly_traffic, merge_air, merge_air_sums
from smogway.operators.integrate import combine
from smogway.operators.parsing import parse_air, parse_traffic
from smogway.schemas import RAW_TEXT, SPEED_VIEW
from smogway.sources.tables import Layout, TableSpec, read_table
from smogway.sources.windows import Window, read_window
from smogway.streaming import queries as SQ
from smogway.streaming import sinks

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
AS_OF = "2024-01-03 00:00:00"


def air_record(minutes, place, value):
    local = (START + timedelta(minutes=minutes)).isoformat()
    return json.dumps({"period": {"datetimeFrom": {"local": local}}, "value": value, "parameter": {"name": "pm25"}, "location": place})


def traffic_record(minutes, speed):
    point = {"coordinate": [{"latitude": 10.77, "longitude": 106.66}]}
    return json.dumps({"flowSegmentData": {"currentSpeed": speed, "coordinates": point}, "_fetched_at": (START + timedelta(minutes=minutes)).isoformat()})


def drop(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(records) + "\n")


def text_stream(spark, folder):
    return sinks.file_stream(spark, str(folder), RAW_TEXT, "text", maxFilesPerTrigger=1)


def run(stream, tmp_path, name):
    spec = TableSpec(str(tmp_path / name), stream.schema)
    sinks.run_until_done(lambda: sinks.append_stream(stream, spec, str(tmp_path / f"{name}-ckpt")))
    return read_table(stream.sparkSession, spec)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_speed_view_over_several_runs_equals_one_batch(spark, tmp_path):
    source, layout = tmp_path / "in", Layout(str(tmp_path / "lake"))
    checkpoint = str(tmp_path / "ckpt")

    def start():
        stream = SQ.air_stream(text_stream(spark, source))
        return sinks.upsert_stream(stream, layout.speed_view, checkpoint, order_by=["pm25"])

    drop(source, "1.json", [air_record(m, "A", float(m)) for m in range(0, 300, 10)] + ["broken"])
    sinks.run_until_done(start)
    drop(source, "2.json", [air_record(m, "B", float(m)) for m in range(200, 600, 10)])
    drop(source, "3.json", [air_record(m, "B", float(m)) for m in range(500, 600, 10)])
    sinks.run_until_done(start)
    sinks.run_until_done(start)
    view = read_table(spark, layout.speed_view).select(*SPEED_VIEW.fieldNames())
    everything = parse_air(spark.read.text(str(source))).accepted.distinct()
    assert rows(view) == rows(everything) and view.count() == 70


def test_hourly_stream_equals_batch_for_closed_hours(spark, tmp_path):
    source = tmp_path / "in"
    for day in range(3):
        drop(source, f"{day}.json", [air_record(day * 480 + m, f"L{m % 3}", float(m % 50) - 5) for m in range(0, 480, 7)])
    stream = SQ.with_hour(SQ.hourly_air_stream(SQ.dedupe_stream(SQ.air_stream(text_stream(spark, source)))))
    closed = run(stream, tmp_path, "hourly").select("timestamp", F.round("avg_pm25", 6), "pm25_count", "location_count")
    batch = hourly_air(parse_air(spark.read.text(str(source))).accepted)
    expected = batch.where(F.col("timestamp") < F.lit("2024-01-01T21:00:00Z").cast("timestamp")).select("timestamp", F.round("avg_pm25", 6), "pm25_count", "location_count")
    assert rows(closed) == rows(expected) and closed.count() == 21


def test_partials_lose_no_late_row_and_no_open_hour(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "partials")

    def start():
        stream = SQ.air_stream(text_stream(spark, source))
        return sinks.partials_stream(stream, air_by_location, path, str(tmp_path / "c"))

    drop(source, "1.json", [air_record(m, f"L{m % 3}", float(m % 50)) for m in range(600, 900, 7)])
    sinks.run_until_done(start)
    drop(source, "2.json", [air_record(m, f"L{m % 3}", float(m % 50)) for m in range(0, 700, 7)])
    sinks.run_until_done(start)
    columns = ["timestamp", F.round("avg_pm25", 6), "pm25_count", "location_count"]
    schema = air_by_location(parse_air(spark.read.text(str(source))).accepted).schema
    streamed = merge_air(sinks.read_partials(spark, path, schema)).select(*columns)
    batch = hourly_air(parse_air(spark.read.text(str(source))).accepted).select(*columns)
    assert rows(streamed) == rows(batch) and batch.count() == 15


def test_stream_dedupe(spark, tmp_path):
    source = tmp_path / "in"
    drop(source, "1.json", [air_record(0, "A", 1.0), air_record(0, "B", 1.0)])
    drop(source, "2.json", [air_record(0, "A", 2.0), air_record(10, "A", 3.0)])
    out = run(SQ.dedupe_stream(SQ.air_stream(text_stream(spark, source))), tmp_path, "dedupe")
    assert sorted((r.location, r.pm25) for r in out.collect()) == [("A", 1.0), ("A", 3.0), ("B", 1.0)]


def test_combined_stream_equals_batch_for_closed_hours(spark, tmp_path):
    roads, sensors = tmp_path / "roads", tmp_path / "sensors"
    drop(roads, "1.json", [traffic_record(m, 5 + m % 7) for m in range(0, 900, 9) if not 120 <= m < 180])
    drop(sensors, "1.json", [air_record(m, f"L{m % 4}", float(m % 90)) for m in range(0, 900, 9) if not 240 <= m < 300])
    readings = SQ.traffic_stream(text_stream(spark, roads), AS_OF)
    air = SQ.dedupe_stream(SQ.air_stream(text_stream(spark, sensors)))
    joined = run(SQ.with_hour(SQ.combined_stream(readings, air)), tmp_path, "combined")
    batch = combine(
        hourly_traffic(parse_traffic(spark.read.text(str(roads)), AS_OF).accepted),
        hourly_air(parse_air(spark.read.text(str(sensors))).accepted),
        aligned=False,
    )
    columns = ["timestamp", "road_segment_id", F.round("avg_speed", 6), "record_count", F.round("avg_pm25", 6), "location_count"]
    expected = batch.where(F.col("timestamp") < F.lit("2024-01-01T12:00:00Z").cast("timestamp"))
    assert rows(joined.select(*columns)) == rows(expected.select(*columns))
    assert {r.road_segment_id is None for r in joined.collect()} == {True, False}


def test_restart_resumes_from_the_checkpoint(spark, tmp_path):
    source, seen, failures = tmp_path / "in", [], [1]
    for i in range(3):
        drop(source, f"{i}.json", [air_record(i, "A", float(i))])

    def start():
        def handle(batch, batch_id):
            if batch_id == 1 and failures:
                failures.pop()
                raise RuntimeError("lost sink")
            seen.append(batch_id)

        return text_stream(spark, source).writeStream.foreachBatch(handle).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()

    sinks.run_until_done(start, restarts=1)
    assert seen == [0, 1, 2]
    failures.append(1)
    drop(source, "9.json", [air_record(9, "A", 9.0)])
    sinks.run_until_done(start)
    assert seen == [0, 1, 2, 3]


def test_failure_without_restarts_is_raised(spark, tmp_path):
    drop(tmp_path / "in", "1.json", [air_record(0, "A", 1.0)])

    def start():
        def handle(batch, batch_id):
            raise RuntimeError("lost sink")

        return text_stream(spark, tmp_path / "in").writeStream.foreachBatch(handle).option("checkpointLocation", str(tmp_path / "c")).start()

    with pytest.raises(StreamingQueryException):
        sinks.run_until_done(start)


def test_polling_query_stops_after_the_wanted_batches(spark, tmp_path):
    source = tmp_path / "in"
    for i in range(3):
        drop(source, f"{i}.json", [air_record(i, "A", float(i))])
    spec = Layout(str(tmp_path / "lake")).speed_view
    stream = SQ.air_stream(text_stream(spark, source))
    query = sinks.upsert_stream(stream, spec, str(tmp_path / "c"), trigger={"processingTime": "100 milliseconds"})
    sinks.run_batches(query, 3, 0.2)
    assert not query.isActive
    assert read_table(spark, spec).count() == 3
    assert isinstance(read_table(spark, spec).schema["year"].dataType, T.IntegerType)


def test_partials_of_unfinished_batches_are_not_read(spark, tmp_path):
    path, schema = str(tmp_path / "p"), "timestamp timestamp, location string, pm25_sum double, pm25_count bigint"
    schema = spark.createDataFrame([], schema).schema
    assert sinks.read_partials(spark, path, schema).count() == 0

    def batch(n, *values):
        spark.createDataFrame([(START, "A", v, 1) for v in values], schema).write.parquet(f"{path}/batch={n}")

    def total():
        r = sinks.read_partials(spark, path, schema).agg(F.sum("pm25_sum"), F.count("*")).first()
        return tuple(r)

    batch(0, 1.0), batch(1, 2.0), batch(2, 4.0)
    (tmp_path / "p" / "batch=2" / "_SUCCESS").unlink()
    assert total() == (3.0, 2)
    assert sinks.compact_partials(spark, path, schema, merge_air_sums) == 2
    assert total() == (3.0, 1)
    (tmp_path / "p" / "batch=2" / "_SUCCESS").touch()
    batch(3, 8.0)
    assert total() == (15.0, 3)
    assert sinks.compact_partials(spark, path, schema, merge_air_sums) == 3
    assert total() == (15.0, 1)
    assert sinks.compact_partials(spark, path, schema, merge_air_sums) == 0
    assert sorted(f.name for f in (tmp_path / "p").iterdir()) == ["upto=3"]


def test_first_arrivals_survive_a_replay(spark, tmp_path):
    source = tmp_path / "in"
    schema = T.StructType([*SPEED_VIEW.fields, T.StructField("batch_id", T.LongType())])
    spec = TableSpec(str(tmp_path / "first"), schema, ("year", "month", "day", "batch_id"))

    def keep(checkpoint):
        stream = SQ.air_stream(text_stream(spark, source))
        sinks.run_until_done(lambda: sinks.first_arrivals_stream(stream, spec, str(tmp_path / checkpoint), order_by=["pm25"]))
        return sorted((r.location, r.pm25) for r in read_table(spark, spec).collect())

    drop(source, "1.json", [air_record(0, "A", 3.0), air_record(0, "A", 1.0), air_record(0, "B", 1.0)])
    drop(source, "2.json", [air_record(0, "A", 0.5), air_record(60 * 24 * 40, "A", 4.0)])
    expected = [("A", 1.0), ("A", 4.0), ("B", 1.0)]
    assert keep("c1") == expected
    assert keep("c2") == expected  # both batches once more, as after a crash before their commit
    drop(source, "3.json", [air_record(0, "C", 9.0), air_record(0, "B", 0.0)])
    assert keep("c2") == sorted([*expected, ("C", 9.0)])


def test_collected_window_survives_a_replay(spark, tmp_path):
    source = tmp_path / "in"
    schema = T.StructType([*RAW_TEXT.fields, T.StructField("_fetched_at", T.StringType())])
    window = Window(str(tmp_path / "window"), schema)

    def collect(checkpoint, hours):
        raw = text_stream(spark, source)
        stamped = raw.select("value", F.get_json_object("value", "$._fetched_at").alias("_fetched_at"))
        now = (START + timedelta(hours=hours)).isoformat()
        sinks.run_until_done(lambda: sinks.retained_stream(stamped, window, str(tmp_path / checkpoint), lambda: now))
        return read_window(spark, window, now).count()

    def stored():
        return {str(f.relative_to(tmp_path)) for f in (tmp_path / "window").rglob("*.parquet")}

    drop(source, "1.json", [traffic_record(m, 5) for m in (0, 60, 120)] + ["{}"])
    assert collect("c1", 24) == 4
    assert collect("c2", 24) == 4  # the same batch once more, as after a crash before its commit
    first = stored()
    drop(source, "2.json", [traffic_record(60 * 25, 5)])
    assert collect("c2", 25.5) == 3
    assert first < stored()  # nothing was rewritten
    drop(source, "3.json", [traffic_record(60 * 49, 5)])
    assert collect("c2", 49.5) == 2
    assert not any("fetch_day=2024-01-01" in name for name in stored())
    assert any("fetch_day=undated" in name for name in stored())

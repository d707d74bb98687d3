import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from smogway.schemas import BATCH_VIEW, SPEED_VIEW
from smogway.sources import files, topics
from smogway.sources.staging import fresh_path, shared_folder, stage
from smogway.sources.tables import (
    Layout,
    TableSpec,
    append_table,
    create_table,
    find_table,
    normalise_path,
    read_first_available,
    read_table,
    upsert_table,
    write_table,
)
from suite import queries

JAN = datetime(2024, 1, 10, tzinfo=timezone.utc)


def air(spark, *rows):
    data = [(JAN + timedelta(days=d), loc, v, None, None) for d, loc, v in rows]
    return spark.createDataFrame(data, SPEED_VIEW)


def contents(df):
    return sorted(((r.timestamp.strftime("%m-%d"), r.location, r.pm25) for r in df.collect()), key=str)


# --- raw files -----------------------------------------------------------------------------------


def test_array_files_of_the_suite_lie_in_one_folder(spark, sf_dir):
    path = queries._write_arrays(spark, sf_dir)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    sizes = sorted(r.n for r in events.groupBy(F.floor(F.col("event_id") / 500)).agg(F.count(F.lit(1)).alias("n")).collect())
    assert not [name for name in os.listdir(path) if os.path.isdir(os.path.join(path, name))]
    found = [open(os.path.join(path, name), encoding="utf-8").read() for name in os.listdir(path) if name.endswith(".txt")]
    assert sorted(len(json.loads(text.replace("NaN", "null"))) for text in found if text) == sizes


RECORDS = [{"a": {"b": [1, 2]}, "s": "x\n  },\n  {"}, {"a": None}, {"ü": "é"}, {}]


@pytest.mark.parametrize("layout, text", [
    ("lines", "\n".join(json.dumps(r, ensure_ascii=False) for r in RECORDS) + "\n\n"),
    ("array", json.dumps(RECORDS)),
    ("array", json.dumps(RECORDS, indent=4)),
    ("indented_array", json.dumps(RECORDS, indent=2, ensure_ascii=False)),
])
def test_raw_layouts(spark, tmp_path, layout, text):
    (tmp_path / "raw.json").write_text(text, encoding="utf-8")
    rows = files.read_raw(spark, str(tmp_path / "raw.json"), layout).orderBy("ingest_seq").collect()
    assert [json.loads(r.value) for r in rows] == RECORDS


@pytest.mark.parametrize("indent", [2, 4])
def test_indented_arrays_keep_every_element(spark, tmp_path, indent):
    records = [{"a": 1}, 7, "x", "a \"b\"\n", None, {}, {"a": 3}]
    (tmp_path / "raw.json").write_text(json.dumps(records, indent=indent))
    rows = files.read_raw(spark, str(tmp_path), "indented_array").orderBy("ingest_seq").collect()
    assert [json.loads(r.value) for r in rows] == records


@pytest.mark.parametrize("layout, kept", [("array", 0), ("indented_array", 2)])
def test_a_cut_off_file_leaves_a_record_to_reject(spark, tmp_path, layout, kept):
    text = json.dumps([{"a": 1}, {"a": 2}, {"a": 3}], indent=2)
    (tmp_path / "raw.json").write_text(text[: text.rindex("3")])
    values = [r.value for r in files.read_raw(spark, str(tmp_path), layout).orderBy("ingest_seq").collect()]
    assert [json.loads(v)["a"] for v in values[:-1]] == list(range(1, kept + 1))
    with pytest.raises(json.JSONDecodeError):
        json.loads(values[-1])


@pytest.mark.parametrize("layout", ["array", "lines"])
def test_arrival_order_over_many_files(spark, tmp_path, layout):
    for i in range(40):
        records = [{"i": 10 * i + k, "pad": "x" * (i * 37 % 50)} for k in range(3)]
        file = tmp_path / f"{40 - i}.json"
        file.write_text(json.dumps(records) if layout == "array" else "\n".join(map(json.dumps, records)))
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    rows = files.read_raw(spark, str(tmp_path), layout).orderBy("ingest_seq").collect()
    assert [json.loads(r.value)["i"] for r in rows] == [10 * i + k for i in range(40) for k in range(3)]
    assert len({r.ingest_seq for r in rows}) == 120


def test_indented_arrays_are_read_by_many_tasks(spark, tmp_path):
    records = [{"i": i, "pad": "x" * 50, "nested": {"list": [1, {"y": 2}]}} for i in range(5000)]
    (tmp_path / "raw.json").write_text(json.dumps(records, indent=2))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        raw = files.read_raw(spark, str(tmp_path / "raw.json"), "indented_array")
        assert raw.rdd.getNumPartitions() > 4
        rows = raw.orderBy("ingest_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [json.loads(r.value)["i"] for r in rows] == list(range(5000))


def test_one_odd_element_does_not_reject_the_file(spark, tmp_path):
    (tmp_path / "raw.json").write_text('[{"value": NaN}, 5, "text", {"value": 1}]')
    assert files.read_raw(spark, str(tmp_path / "raw.json"), "array").count() == 4


def test_missing_and_empty_sources(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_raw(spark, str(tmp_path / "none"))
    empty = files.read_raw(spark, str(tmp_path / "none"), required=False)
    assert empty.columns == ["value", "ingest_seq"] and empty.isEmpty()
    with pytest.raises(ValueError, match="traffic is empty"):
        files.require_rows(empty, "traffic")
    with pytest.raises(FileNotFoundError):
        files.read_csv_view(spark, str(tmp_path / "none"), BATCH_VIEW)


def test_csv_times(spark, tmp_path, any_session_zone):
    header = "timestamp,road_segment_id,avg_speed,min_speed,max_speed,record_count"
    body = ["2025-11-18 12:00:00+07:00,a,1.5,1,2,3", "2025-11-18 05:00:00,b,,,,0", "bad,c,1,1,1,1"]
    (tmp_path / "v.csv").write_text("\n".join([header, *body]))
    rows = files.read_csv_view(spark, str(tmp_path / "v.csv"), BATCH_VIEW).select("*", F.unix_micros("timestamp").alias("us")).collect()
    assert [(r.road_segment_id, r.us, r.avg_speed) for r in rows] == [("a", 1763442000000000, 1.5), ("b", 1763442000000000, None)]


def test_write_json_keeps_nulls(spark, tmp_path):
    files.write_json(spark.createDataFrame([("é", None)], "a string, b string").coalesce(1), str(tmp_path / "j"))
    assert json.loads(spark.read.text(str(tmp_path / "j")).first().value) == {"a": "é", "b": None}


# --- tables --------------------------------------------------------------------------------------


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_modes_and_round_trip(spark, tmp_path, fmt, any_session_zone):
    spec = Layout(str(tmp_path), fmt).speed_view
    assert find_table(spark, spec) is None
    assert create_table(air(spark, (0, "x", 1.0), (40, "x", 2.0)), spec) == 2
    with pytest.raises(Exception, match="(?i)exist"):
        create_table(air(spark, (0, "x", 1.0)), spec)
    assert append_table(air(spark, (1, "y", 3.0)), spec) == 1
    assert len(contents(read_table(spark, spec))) == 3
    assert set(read_table(spark, spec).columns) == {*SPEED_VIEW.fieldNames(), "year", "month", "day"}
    assert write_table(air(spark, (2, "z", 4.0)), spec) == 1
    assert contents(read_table(spark, spec)) == [("01-12", "z", 4.0)]
    assert write_table(air(spark), spec) == 0
    assert contents(read_table(spark, spec)) == [("01-12", "z", 4.0)]


def test_overwrite_may_read_its_target(spark, tmp_path):
    spec = Layout(str(tmp_path)).speed_view
    write_table(air(spark, (0, "x", 1.0), (1, "y", 2.0)), spec)
    stored = read_table(spark, spec)
    write_table(stored.where("location = 'x'"), spec)
    assert contents(read_table(spark, spec)) == [("01-10", "x", 1.0)]


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    spec = Layout(str(tmp_path)).speed_view
    upsert_table(air(spark, (0, "x", 1.0), (1, "y", 2.0), (40, "x", 3.0), (80, "x", 9.0)), spec)
    untouched = sorted(p.name for month in ("2", "3") for p in (tmp_path / f"air_quality/speed_view/year=2024/month={month}").iterdir())
    update = stage(air(spark, (0, "x", 7.0), (2, "z", 8.0)), "new")
    for _ in range(2):
        upsert_table(update, spec)
        assert contents(read_table(spark, spec)) == [
            ("01-10", "x", 7.0), ("01-11", "y", 2.0), ("01-12", "z", 8.0), ("02-19", "x", 3.0), ("03-30", "x", 9.0)]
    after = sorted(p.name for month in ("2", "3") for p in (tmp_path / f"air_quality/speed_view/year=2024/month={month}").iterdir())
    assert untouched == after
    upsert_table(stage(air(spark), "none"), spec)
    assert len(contents(read_table(spark, spec))) == 5


def test_upsert_order(spark, tmp_path):
    base = Layout(str(tmp_path)).speed_view
    spec = TableSpec(base.path, air(spark).withColumn("seq", F.lit(1)).schema, base.partition_by)
    rows = air(spark, (0, "x", 1.0), (0, "x", 2.0)).withColumn("seq", F.col("pm25").cast("int"))
    upsert_table(rows, spec, order_by=["seq"])
    assert contents(read_table(spark, spec)) == [("01-10", "x", 2.0)]


def test_fallback(spark, tmp_path):
    layout = Layout(str(tmp_path))
    assert read_first_available(spark, [layout.speed_view], SPEED_VIEW).isEmpty()
    with pytest.raises(FileNotFoundError):
        read_first_available(spark, [layout.speed_view, layout.air_raw], SPEED_VIEW, required=True)
    write_table(air(spark, (0, "x", 1.0)), layout.air_raw)
    assert read_first_available(spark, [layout.speed_view, layout.air_raw], SPEED_VIEW).count() == 1


def test_paths(spark):
    assert normalise_path("s3://bucket/base/") == "s3a://bucket/base"
    assert Layout("/base/").traffic_raw.partition_by == ("year", "month", "day")
    assert fresh_path(spark, "a").startswith(shared_folder(spark)) and fresh_path(spark, "a") != fresh_path(spark, "a")


def test_topic_reader_without_connector(spark):
    messages = spark.createDataFrame([(b"{}", 0, 5, JAN)], "value binary, partition int, offset bigint, timestamp timestamp")
    raw = topics._as_raw(messages)
    assert raw.columns == ["value", "ingest_seq"] and raw.first().value == "{}"


def test_publishing(spark):
    raw = spark.createDataFrame([("{}",)], "value string")
    topics.publish_traffic(raw, fmt="noop")
    topics.publish_air(raw, fmt="noop")

"""The continuous air job: every arrival counts, whenever it is stopped."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import types as T

from smogway.operators.parsing import classify_air
from smogway.plans import live
from smogway.sources.tables import Layout, read_table
from smogway.streaming import sinks

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
RAW = T.StructType([T.StructField("ingest_seq", T.LongType()), T.StructField("value", T.StringType())])


def record(hour, place, value):
    return json.dumps({"date": (START + timedelta(hours=hour)).isoformat(), "value": value, "location": place})


def drop(spark, folder, first, records):
    spark.createDataFrame(list(enumerate(records, first)), RAW).coalesce(1).write.mode("append").parquet(str(folder))


def view(spark, layout):
    return sorted((r.location, r.pm25, r.arrival) for r in read_table(spark, layout.live_view).collect())


def rejected(spark, layout):
    return sorted((r.batch_id, r.reason, r.raw) for r in read_table(spark, layout.air_rejected).collect())


@pytest.fixture
def job(spark, tmp_path):
    layout, source = Layout(str(tmp_path / "lake")), tmp_path / "in"
    source.mkdir()

    def start(checkpoint="c"):
        stream = sinks.file_stream(spark, str(source), RAW, maxFilesPerTrigger=1)
        return live.run_speed_stream(stream, layout, str(tmp_path / checkpoint), sinks.DRAIN)

    return layout, source, start


def test_newest_arrival_wins_and_bad_records_are_kept(spark, job):
    layout, source, start = job
    drop(spark, source, 0, [record(0, "A", 1.0), record(0, "A", 2.0), "broken", record(40 * 24, "A", 9.0)])
    drop(spark, source, 10, [record(0, "A", 0.5), record(1, "B", None), record(-5000, "B", 3.0)])
    live.keep_running(start, 0)
    assert view(spark, layout) == [("A", 0.5, 1), ("A", 9.0, 0), ("B", 3.0, 1)]
    assert [r[:2] for r in rejected(spark, layout)] == [(0, "invalid_json"), (1, "missing_value")]
    live.keep_running(start, 0)
    assert len(view(spark, layout)) == 3


@pytest.mark.parametrize("broken", ["merge_measurements", "quarantine"])
def test_a_job_stopped_between_its_writes_goes_on(spark, job, monkeypatch, broken):
    layout, source, start = job
    real, failures = getattr(live, broken), [0, 1]

    def lost(*args, **kwargs):
        if failures and args[2] == failures[0]:
            failures.pop(0)
            raise RuntimeError("stopped")
        return real(*args, **kwargs)

    monkeypatch.setattr(live, broken, lost)
    drop(spark, source, 0, [record(0, "A", 1.0), "bad one"])
    drop(spark, source, 10, [record(0, "A", 2.0), record(1, "A", 3.0), "bad two", "bad two"])
    with pytest.raises(Exception, match="stopped"):
        live.keep_running(start, 0)
    live.keep_running(start, 1)
    assert failures == []
    assert view(spark, layout) == [("A", 2.0, 1), ("A", 3.0, 1)]
    assert [r[2] for r in rejected(spark, layout)] == ["bad one", "bad two", "bad two"]


def test_an_old_batch_replayed_does_not_win(spark, job):
    layout, _, _ = job

    def classified(value):
        raw = spark.createDataFrame([(0, record(0, "A", value), 0)], "ingest_seq long, value string, _order int")
        return classify_air(raw.drop("ingest_seq"))

    live.merge_measurements(classified(1.0), layout, 0)
    live.merge_measurements(classified(2.0), layout, 1)
    live.merge_measurements(classified(1.0), layout, 0)
    assert view(spark, layout) == [("A", 2.0, 1)]


def test_only_days_of_the_batch_are_rewritten(spark, job, tmp_path):
    layout, source, start = job
    drop(spark, source, 0, [record(24 * d, "A", float(d)) for d in range(5)])
    live.keep_running(start, 0)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "lake").rglob("*.parquet")}
    drop(spark, source, 10, [record(48, "A", 7.0)])
    live.keep_running(start, 0)
    kept = [f for f in before if f.exists() and f.stat().st_mtime_ns == before[f]]
    assert len(before) == 5 and len(kept) == 4


def test_arrivals_need_an_order(spark, tmp_path):
    with pytest.raises(ValueError, match="ingest_seq"):
        live.run_speed_stream(spark.createDataFrame([("x",)], "value string"), Layout(str(tmp_path)), str(tmp_path / "c"))

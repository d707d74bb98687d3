import json

import pytest
from pyspark.sql import functions as F

from smogway.operators.parsing import parse_traffic
from smogway.plans import jobs
from smogway.schemas import BATCH_VIEW, COMBINED
from smogway.sources.files import read_csv_view
from smogway.sources.tables import Layout, find_table, read_table

AS_OF = "2024-01-10 12:00:00"


def raw(spark, records):
    return spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "ingest_seq int, value string")


@pytest.fixture
def traffic(spark):
    point = {"coordinate": [{"latitude": 10.77, "longitude": 106.66}]}
    return raw(spark, [
        {"flowSegmentData": {"currentSpeed": s, "coordinates": point}, "_fetched_at": f"2024-01-10T{h:02}:30:00"}
        for h, s in [(0, 3.0), (0, 5.0), (1, 20.0), (5, 2.0), (5, 2.0), (11, 9.0)]
    ])


@pytest.fixture
def air(spark):
    return raw(spark, [
        {"period": {"datetimeFrom": {"local": f"2024-01-10T{h:02}:00:00+07:00"}}, "value": v, "parameter": {"name": "pm25"}, "location": p}
        for h, p, v in [(0, "A", 60.0), (0, "B", 80.0), (5, "A", 10.0), (11, "A", 70.0), (0, "A", 500.0)]
    ])


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_full_job(spark, tmp_path, traffic, air, fmt, any_session_zone):
    layout = Layout(str(tmp_path), fmt)
    result = jobs.run_full(spark, layout, traffic, air, AS_OF)
    assert result.combined.columns == COMBINED.fieldNames()
    assert result.combined.count() == 4
    critical = result.critical.collect()
    assert [(r.avg_speed, r.avg_pm25, r.record_count) for r in critical] == [(14.4, 70.0, 2)]
    assert result.stats.first().critical_percentage == 25.0
    assert result.coverage.first().rows_with_both == 3
    assert read_table(spark, layout.critical_view).count() == 1


def test_speed_failure_is_tolerated(spark, tmp_path, traffic):
    result = jobs.run_full(spark, Layout(str(tmp_path)), traffic, traffic.withColumnRenamed("value", "odd"), AS_OF)
    assert result.combined.count() == 4 and "ValueError: raw air quality is missing" in result.speed_error
    assert {r.pm25_count for r in result.combined.collect()} == {0}


def test_refresh_and_dedupe(spark, tmp_path, traffic):
    layout = Layout(str(tmp_path))
    first = jobs.run_batch(spark, layout, traffic, AS_OF)
    assert first.agg(F.sum("record_count")).first()[0] == 6
    kept = jobs.run_batch(spark, layout, traffic.limit(1), AS_OF, refresh=False)
    assert kept.agg(F.sum("record_count")).first()[0] == 6
    deduped = jobs.run_batch(spark, layout, traffic, AS_OF, dedupe=True)
    assert deduped.agg(F.sum("record_count")).first()[0] == 5


def test_batch_reads_the_raw_table(spark, tmp_path, traffic, air):
    layout = Layout(str(tmp_path))
    with pytest.raises(FileNotFoundError):
        jobs.run_batch(spark, layout)
    assert jobs.ingest_traffic(traffic, layout, AS_OF) == 6
    assert jobs.ingest_air(air, layout) == 4
    assert jobs.run_batch(spark, layout).count() == 4
    assert jobs.run_speed(spark, layout).count() == 4


def test_speed_merge_keeps_old_rows(spark, tmp_path, air):
    layout = Layout(str(tmp_path))
    jobs.run_speed(spark, layout, air)
    update = raw(spark, [{"date": "2024-01-10T00:00:00+07:00", "value": 1.0, "location": "A"}, {"date": "2024-01-11", "value": 2.0}])
    view = jobs.run_speed(spark, layout, update, overwrite=False)
    assert sorted(r.pm25 for r in view.collect()) == [1.0, 2.0, 10.0, 70.0, 80.0]
    assert jobs.run_speed(spark, layout, update.limit(0)).count() == 5
    assert jobs.run_speed(spark, layout, update, refresh=False).count() == 5


def test_serving_needs_traffic(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        jobs.run_serving(spark, Layout(str(tmp_path)))


def test_empty_or_useless_input(spark, tmp_path, traffic, air):
    layout = Layout(str(tmp_path))
    with pytest.raises(ValueError, match="empty"):
        jobs.run_full(spark, layout, traffic.limit(0), air, AS_OF)
    with pytest.raises(ValueError, match="no usable"):
        jobs.run_batch(spark, layout, raw(spark, [{}]), AS_OF)
    with pytest.raises(ValueError, match="as_of"):
        jobs.run_batch(spark, layout, traffic)
    assert find_table(spark, layout.batch_view) is None


def test_migration_goes_on_where_it_stopped(spark, tmp_path, traffic):
    layout, calls = Layout(str(tmp_path)), []

    def broken():
        calls.append("broken")
        return traffic.select("nope") if calls.count("broken") == 1 else traffic.select(F.lit(AS_OF).cast("timestamp").alias("timestamp"), F.lit("A").alias("location"), *[F.lit(1.0).alias(c) for c in ("pm25", "latitude", "longitude")], F.lit(0).cast("long").alias("arrival")).limit(1)

    def readings():
        calls.append("traffic")
        return parse_traffic(traffic, AS_OF).accepted.drop("ingest_seq")

    datasets = [
        jobs.Dataset("traffic", readings, layout.traffic_raw),
        jobs.Dataset("none", lambda: parse_traffic(traffic.limit(0), AS_OF).accepted.drop("ingest_seq"), layout.traffic_raw),
        jobs.Dataset("view", lambda: read_csv_view(spark, str(tmp_path / "x.csv"), COMBINED), layout.combined_view),
        jobs.Dataset("broken", broken, layout.air_raw),
    ]
    report = jobs.migrate_all(spark, datasets, ledger=layout.migrations).collect()
    assert [tuple(r)[:3] for r in report] == [("traffic", "migrated", 6), ("none", "empty", 0), ("view", "missing", 0), ("broken", "failed", 0)]
    assert report[0].error is None and "x.csv" in report[2].error and "nope" in report[3].error
    report = jobs.migrate_all(spark, datasets, ledger=layout.migrations).collect()
    assert [tuple(r)[1:3] for r in report] == [("migrated", 6), ("empty", 0), ("missing", 0), ("migrated", 1)]
    assert calls.count("traffic") == 1
    assert read_table(spark, layout.migrations).count() == 4 + 3


def test_speed_view_keeps_the_first_arrival_of_the_raw_table(spark, tmp_path):
    layout = Layout(str(tmp_path))
    for value in (99.0, 1.0, 5.0):
        jobs.ingest_air(raw(spark, [{"date": "2024-01-10", "value": value, "location": "A"}]), layout)
    assert [r.pm25 for r in jobs.run_speed(spark, layout).collect()] == [99.0]
    with pytest.raises(ValueError, match="ingest_seq"):
        jobs.ingest_air(raw(spark, [{}]).drop("ingest_seq"), layout)


def test_batch_view_by_parts(spark, tmp_path, traffic):
    layout, whole = Layout(str(tmp_path / "parts")), Layout(str(tmp_path / "whole"))
    late = raw(spark, [{"flowSegmentData": {"currentSpeed": 7.0}, "_fetched_at": t} for t in ("2024-01-10T00:45:00", "2024-01-31T23:59:00", "2024-02-01T00:00:00")])
    with pytest.raises(FileNotFoundError):
        jobs.refresh_batch(spark, layout)

    def view(df):
        return sorted(map(tuple, df.select(*BATCH_VIEW.fieldNames()).collect()))

    jobs.ingest_traffic(traffic, layout, AS_OF)
    first = jobs.refresh_batch(spark, layout)
    assert view(first) == view(jobs.run_batch(spark, whole, traffic, AS_OF))
    stored = {f: f.stat().st_mtime_ns for f in (tmp_path / "parts").rglob("*.parquet")}
    jobs.refresh_batch(spark, layout)
    assert stored == {f: f.stat().st_mtime_ns for f in (tmp_path / "parts").rglob("*.parquet")}
    jobs.ingest_traffic(late, layout, AS_OF)
    both = traffic.unionByName(late)
    assert view(jobs.refresh_batch(spark, layout)) == view(jobs.run_batch(spark, whole, both, AS_OF))
    days = [f for f in stored if "sums" in str(f)]
    jobs.ingest_traffic(late.where("ingest_seq = 2"), layout, AS_OF)
    jobs.refresh_batch(spark, layout)
    assert days and all(f.exists() for f in (tmp_path / "parts/traffic/sums/year=2024/month=1").rglob("*.parquet"))
    assert read_table(spark, layout.batch_view).agg(F.sum("record_count")).first()[0] == 10


def test_batch_view_by_parts_forgets_deleted_days(spark, tmp_path, traffic):
    import shutil

    layout = Layout(str(tmp_path))
    far = raw(spark, [{"flowSegmentData": {"currentSpeed": 7.0}, "_fetched_at": "2024-03-05T00:45:00"}])
    jobs.ingest_traffic(traffic.unionByName(far), layout, AS_OF)
    assert jobs.refresh_batch(spark, layout).count() == 5
    shutil.rmtree(tmp_path / "traffic/raw/year=2024/month=3")
    assert jobs.refresh_batch(spark, layout).count() == 4

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smogway.operators import aggregates as A
from smogway.operators import critical as C
from smogway.operators import filters as FL
from smogway.operators import integrate as I
from smogway.operators import quality as Q
from smogway.operators import stations as S

T0 = datetime(2024, 1, 10)
BATCH = "timestamp timestamp_ntz, road_segment_id string, avg_speed double, min_speed double, max_speed double, record_count bigint"
AIR = "timestamp timestamp_ntz, avg_pm25 double, pm25_count bigint, location_count bigint"
NAN = float("nan")


def at(hours):
    return T0 + timedelta(hours=hours)


def batch(spark, *rows):
    return spark.createDataFrame([(at(h), seg, v, v, v, 1) for h, seg, v in rows], BATCH)


def air(spark, *rows):
    return spark.createDataFrame([(at(h), v, 2, 1) for h, v in rows], AIR)


def by_hour(df):
    return {(int((r.timestamp - T0).total_seconds() / 3600), r.road_segment_id): r for r in df.collect()}


# --- join and alignment --------------------------------------------------------------------------


def test_full_outer_join(spark):
    rows = by_hour(I.combine(batch(spark, (0, "a", 10.0), (0, "b", 20.0), (1, "a", 30.0)), air(spark, (0, 60.0), (2, 70.0)), aligned=False))
    assert set(rows) == {(0, "a"), (0, "b"), (1, "a"), (2, None)}
    assert (rows[1, "a"].pm25_count, rows[2, None].record_count) == (None, None)
    assert rows[0, "b"].avg_pm25 == 60.0


def test_no_air_gives_zero_counts_and_skips_the_recency_filter(spark):
    rows = by_hour(I.combine(batch(spark, (0, "a", 10.0), (100, "a", 10.0)), air(spark), as_of=at(101)))
    assert set(rows) == {(0, "a"), (100, "a")}
    assert {(r.avg_pm25, r.pm25_count, r.location_count) for r in rows.values()} == {(None, 0, 0)}


def test_no_traffic_gives_air_only_rows(spark):
    rows = by_hour(I.combine(batch(spark), air(spark, (0, 60.0)), as_of=at(1)))
    assert set(rows) == {(0, None)} and rows[0, None].avg_pm25 == 60.0


@pytest.mark.parametrize("gap, merged", [(0, True), (2, True), (3, False)])
def test_alignment_tolerance_is_inclusive(spark, gap, merged):
    rows = by_hour(I.combine(batch(spark, (0, "a", 10.0)), air(spark, (gap, 60.0))))
    assert (set(rows) == {(gap, "a")}) == merged
    if not merged:
        assert set(rows) == {(0, "a"), (gap, None)}


def test_rows_at_the_edge_of_the_tolerance_snap(spark):
    left = batch(spark, *[(h, s, float(h)) for h in (7, 8, 9, 10) for s in ("a", "b")])
    rows = by_hour(I.combine(left, air(spark, (7, 1.0), (8, 2.0), (10, 6.0))))
    assert set(rows) == {(7, "a"), (7, "b"), (10, "a"), (10, "b")}
    newest = rows[10, "a"]
    assert (newest.avg_speed, newest.min_speed, newest.max_speed, newest.record_count) == (9.0, 8.0, 10.0, 3)
    assert (newest.avg_pm25, newest.pm25_count, newest.location_count) == (4.0, 4, 2)


def test_alignment_without_segments_and_weighted(spark):
    left = batch(spark, (9, "a", 10.0), (10, "a", 40.0)).drop("road_segment_id")
    left = left.withColumn("record_count", F.when(F.col("avg_speed") == 40.0, 3).otherwise(1).cast("bigint"))
    plain = I.combine(left, air(spark, (10, 1.0))).first()
    weighted = I.combine(left, air(spark, (10, 1.0)), weighted=True).first()
    assert (plain.avg_speed, weighted.avg_speed) == (25.0, 32.5)


def test_recency_is_decided_per_side(spark):
    rows = by_hour(I.combine(batch(spark, (0, "a", 1.0), (90, "a", 1.0)), air(spark, (0, 1.0), (5, 1.0)), as_of=at(100), aligned=False))
    assert set(rows) == {(90, "a"), (0, None), (5, None)}


def test_recency_bound_reaches_the_scan(spark, tmp_path):
    batch(spark, (0, "a", 1.0), (90, "a", 1.0)).write.parquet(str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    recent = FL.recent_or_all(stored, at(100))
    assert recent.count() == 1
    scan = [line for line in recent._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line][-1]
    assert "timestamp" in scan.split("DataFilters:")[1]


def test_coverage(spark):
    row = I.coverage(I.combine(batch(spark, (0, "a", 1.0)), air(spark, (5, 1.0)), aligned=False)).first()
    assert (row.total_rows, row.rows_with_traffic, row.rows_with_air, row.rows_with_both, row.ranges_do_not_overlap) == (2, 1, 1, 0, True)


# --- critical ------------------------------------------------------------------------------------


def flagged(spark, *pairs):
    df = spark.createDataFrame([(T0, "a", s, p) for s, p in pairs], "timestamp timestamp_ntz, road_segment_id string, avg_speed double, avg_pm25 double")
    return C.flag_critical(df)


def test_thresholds_are_strict_and_unknown_is_not_critical(spark):
    pairs = [(19.9, 50.1), (20.0, 60.0), (10.0, 50.0), (None, 60.0), (10.0, None), (None, None), (10.0, NAN), (NAN, 90.0)]
    assert [r.is_critical for r in flagged(spark, *pairs).collect()] == [True] + [False] * 7


def test_severity(spark):
    pairs = [(0.0, 200.0), (150.0, 400.0), (100.0, -5.0), (50.0, 100.0), (None, 100.0), (50.0, None), (50.0, NAN)]
    assert [r.severity_index for r in flagged(spark, *pairs).collect()] == [1.0, 0.5, 0.0, 0.5, None, None, None]


def test_quadrants(spark):
    rows = C.quadrant(flagged(spark, (10.0, 60.0), (30.0, 60.0), (10.0, 20.0), (30.0, 20.0), (None, 60.0))).collect()
    assert [r.quadrant for r in rows] == ["critical", "high_pm25_normal_speed", "low_speed_good_air", "normal", None]


def test_critical_filter_turns_the_join_inner(spark):
    combined = I.combine(batch(spark, (0, "a", 10.0)), air(spark, (0, 60.0)), aligned=False)
    critical = C.critical_only(C.flag_critical(combined))
    plan = critical._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "LeftOuter" not in plan and "Join Inner" in plan
    assert critical.count() == 1


def test_summary_of_an_empty_view(spark):
    row = C.summary_stats(flagged(spark, (1.0, 1.0)).limit(0)).first()
    assert (row.total_records, row.critical_count, row.critical_percentage, row.avg_speed_mean) == (0, 0, 0.0, None)


def test_timeline(spark):
    rows = C.critical_timeline(flagged(spark, (10.0, 60.0), (0.0, 300.0), (90.0, 10.0))).orderBy("severity_index").collect()
    assert len(rows) == 2
    assert rows[0].info == "PM2.5: 60.0 µg/m³\nSpeed: 10.0 km/h"
    assert (rows[0].time_label, rows[0].end_time) == ("00:00", at(1))
    assert rows[0].shade == pytest.approx(0.4 + 0.6 * 0.6) and rows[1].shade == pytest.approx(1.0)


def test_shade_is_flat_without_severity(spark):
    df = flagged(spark, (100.0, 0.0)).withColumn("severity_index", F.lit(0.0))
    assert C.severity_shade(df).first().shade == 1.0


def test_consecutive_periods(spark):
    hours = spark.createDataFrame([(at(h), k) for h, k in [(0, "a"), (1, "a"), (1, "a"), (3, "a"), (4, "b"), (5, "b"), (6, "b")]], "timestamp timestamp_ntz, k string")
    assert sorted((r.period_start, r.period_end, r.n_hours) for r in C.consecutive_periods(hours).collect()) == [(at(0), at(2), 2), (at(3), at(7), 4)]
    assert sorted((r.k, r.n_hours) for r in C.consecutive_periods(hours, ["k"]).collect()) == [("a", 1), ("a", 2), ("b", 3)]


@hypothesis_settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 60), min_size=1))
def test_periods_cover_exactly_the_hours(spark, chosen):
    hours = spark.createDataFrame([(at(h),) for h in chosen], "timestamp timestamp_ntz")
    covered = set()
    for run in C.consecutive_periods(hours).collect():
        start = int((run.period_start - T0).total_seconds() / 3600)
        members = set(range(start, start + run.n_hours))
        assert run.period_end == at(start + run.n_hours)
        assert start - 1 not in chosen and start + run.n_hours not in chosen
        covered |= members
    assert covered == chosen


# --- aggregation ---------------------------------------------------------------------------------


def test_hourly_air_drops_invalid_values_and_counts_locations(spark):
    rows = [(at(0.1), "x", 10.0), (at(0.2), "x", 20.0), (at(0.3), "y", 30.0), (at(0.4), None, 40.0), (at(0.5), "z", -999.0), (at(0.6), "z", NAN), (at(1.5), "x", 0.0)]
    out = A.hourly_air(spark.createDataFrame(rows, "timestamp timestamp_ntz, location string, pm25 double")).collect()
    assert [tuple(r) for r in out] == [(at(0), 25.0, 4, 2)]


def test_hourly_traffic_ignores_null_keys_and_nan(spark):
    rows = [(at(0.1), "a", 10.0), (at(0.2), "a", NAN), (at(0.3), None, 5.0), (None, "a", 5.0), (at(1.0), "b", None)]
    readings = spark.createDataFrame(rows, "timestamp timestamp_ntz, segment_id string, velocity double")
    out = sorted(tuple(r) for r in A.hourly_traffic(readings).collect())
    assert out == [(at(0), "a", 10.0, 10.0, 10.0, 1), (at(1), "b", None, None, None, 0)]
    with pytest.raises(ValueError, match="velocity"):
        A.hourly_traffic(readings.drop("velocity"))


def test_hourly_traffic_bounds_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(at(0), "a", 1.0), (at(9), "a", 1.0)], "timestamp timestamp_ntz, segment_id string, velocity double").write.parquet(str(tmp_path / "r"))
    view = A.hourly_traffic(spark.read.parquet(str(tmp_path / "r")), since=at(5))
    assert "GreaterThanOrEqual(timestamp" in view._jdf.queryExecution().executedPlan().toString()
    assert view.count() == 1


# --- dedupe, retention, stations -------------------------------------------------------------------


def test_dedupe_and_upsert(spark):
    schema = "k string, v double, seq bigint"
    old = spark.createDataFrame([("a", 1.0, 5), ("b", 2.0, 6), (None, 3.0, 7)], schema)
    new = spark.createDataFrame([("a", 9.0, 1), ("a", None, 2), ("c", 4.0, 3), (None, 5.0, 4)], schema)
    assert {(r.k, r.v) for r in Q.dedupe_first(new, ["k"], ["seq"]).collect()} == {("a", 9.0), ("c", 4.0), (None, 5.0)}
    assert {(r.k, r.v) for r in Q.upsert(old, new, ["k"], ["seq"]).collect()} == {("a", None), ("b", 2.0), ("c", 4.0), (None, 5.0)}
    assert {(r.k, r.v) for r in Q.upsert(old, new.limit(0), ["k"]).collect()} == {("a", 1.0), ("b", 2.0), (None, 3.0)}


def test_numeric_dedupe_is_a_hash_aggregate(spark):
    df = spark.createDataFrame([("a", 1.0, 5)], "k string, v double, seq bigint")
    plan = Q.dedupe_first(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_retention_keeps_undated_rows_and_the_cutoff(spark, any_session_zone):
    stamps = ["2024-01-30T00:00:00", "2024-01-29T17:00:00Z", "2024-01-29T23:59:59", "bad", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i int, _fetched_at string")
    kept = FL.retained(df.where("i < 2"), df.where("i >= 2"), "2024-01-31 00:00:00")
    assert sorted(r.i for r in kept.collect()) == [0, 1, 3, 4]


def test_stations(spark):
    schema = "station_id bigint, name string, latitude double, longitude double"
    places = spark.createDataFrame([(1, "near", 10.772, 106.667), (2, "edge", 10.95, 106.6664), (3, "far", 11.5, 106.6)], schema)
    assert {r.name for r in S.stations_within_radius(places).collect()} == {"near"}
    assert {r.name for r in S.stations_within_radius(places, radius_km=500).collect()} == {"near", "edge", "far"}
    assert [r.name for r in S.stations_within_radius(places, radius_km=25, max_locations=1).collect()] == ["near"]
    measured = spark.createDataFrame([(1, None, None), (1, 1.0, 2.0), (9, None, None)], "station_id bigint, latitude double, longitude double")
    rows = S.enrich_with_station(measured, places).collect()
    assert sorted(((r.location, r.latitude) for r in rows), key=str) == [("near", 1.0), ("near", 10.772), (None, None)]


def test_grid(spark):
    points = S.sampling_grid(spark).collect()
    assert len(points) == 25
    assert (points[0].latitude, points[0].longitude) == (10.76, 106.65)
    assert (points[-1].latitude, points[-1].longitude) == (pytest.approx(10.783), pytest.approx(106.683))
    back = S.nearest_grid_point(S.sampling_grid(spark).drop("grid_row", "grid_col"))
    assert {(r.grid_row, r.grid_col) for r in back.collect()} == {(i, j) for i in range(5) for j in range(5)}


def test_critical_hours_use_plain_means_and_the_window(spark):
    rows = [(at(0), "x", 90.0), (at(1), "x", 90.0), (at(1.5), "x", -999.0), (at(3), "x", 51.0), (at(4), "x", 99.0)]
    measured = spark.createDataFrame(rows, "timestamp timestamp_ntz, location string, pm25 double")
    assert sorted(r.hour_offset for r in A.critical_hours(measured, at(0), 4).collect()) == [0, 3]
    assert sorted(r.hour_offset for r in A.critical_hours(measured).collect()) == [0, 3, 4]
    assert tuple(FL.hour_range(measured).first()) == (at(0), at(4), 5)
    inside = C.in_hours(measured, A.critical_hours(measured)).count()
    outside = C.in_hours(measured, A.critical_hours(measured), inside=False).count()
    assert (inside, outside) == (3, 2)


def test_merged_hours_count_distinct_locations_from_sketches(spark):
    """3,000 locations, of which each hour sees an overlapping part: sums would count 5,400."""
    rows = [(at(h), f"loc {i}", 10.0) for h in range(3) for i in range(600 * h, 600 * h + 1800)]
    air = spark.createDataFrame(rows, "timestamp timestamp_ntz, location string, pm25 double")
    batch = spark.createDataFrame([(at(2), 1.0, 1.0, 1.0, 1)], "timestamp timestamp_ntz, avg_speed double, min_speed double, max_speed double, record_count long")
    merged = I.align(batch, A.hourly_air(air, sketch=True))[1].collect()
    assert len(merged) == 1 and merged[0].pm25_count == 5400
    assert abs(merged[0].location_count - 3000) < 3000 * 0.05
    assert I.align(batch, A.hourly_air(air))[1].first().location_count == 5400


def test_critical_hours_read_the_measurements_once(spark, tmp_path):
    spark.createDataFrame([(at(0), "x", 90.0)], "timestamp timestamp_ntz, location string, pm25 double").write.parquet(str(tmp_path / "air"))
    hours = A.critical_hours(spark.read.parquet(str(tmp_path / "air")))
    plan = hours._jdf.queryExecution().executedPlan().toString()
    assert "pm25#" not in plan.replace("avg_pm25#", "") and hours.count() == 1

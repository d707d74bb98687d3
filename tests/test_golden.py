"""One day of one road segment and two stations: batch, speed, alignment, critical hours, statistics."""

import json

import pytest
from pyspark.sql import functions as F

from smogway.functions.timestamps import local_wall_clock
from smogway.operators.aggregates import critical_hours, hourly_air, hourly_traffic
from smogway.operators.critical import consecutive_periods, critical_only, flag_critical, summary_stats
from smogway.operators.integrate import combine
from smogway.operators.parsing import air_measurements, parse_traffic
from smogway.sources.staging import stage

# Local hour, mean speed in km/h, mean PM2.5, severity.
HOURS = [
    ("11-18 12", 53.86, 46.099667, 0.345949), ("11-18 13", 56.52, 37.430333, 0.310976),
    ("11-18 14", 17.57, 54.950910, 0.549527), ("11-18 15", 55.01, 43.476250, 0.333641),
    ("11-18 16", 19.66, 57.500000, 0.545450), ("11-18 17", 38.09, 23.583750, 0.368509),
    ("11-18 18", 54.04, 30.415167, 0.305838), ("11-18 19", 49.79, 31.111333, 0.328828),
    ("11-18 20", 43.34, 26.657333, 0.349943), ("11-18 21", 68.83, 21.809750, 0.210374),
    ("11-18 22", 80.86, 29.387667, 0.169169), ("11-18 23", 70.81, 41.747000, 0.250318),
    ("11-19 00", 62.10, 38.577208, 0.285943), ("11-19 01", 65.45, 43.221479, 0.280804),
    ("11-19 02", 74.30, 39.897889, 0.228245), ("11-19 03", 83.77, 27.474542, 0.149836),
    ("11-19 04", 91.44, 24.072750, 0.102982), ("11-19 05", 76.75, 37.204375, 0.209261),
    ("11-19 06", 77.04, 46.555417, 0.231188), ("11-19 07", 11.84, 80.000000, 0.640800),
    ("11-19 08", 43.27, 37.411042, 0.377178), ("11-19 09", 60.19, 24.099882, 0.259300),
    ("11-19 10", 47.70, 27.889917, 0.331225),
]


@pytest.fixture
def feeds(spark):
    traffic, air = [], []
    for label, speed, pm25, _ in HOURS:
        local = f"2025-{label}:00:00+07:00"
        traffic.append(json.dumps({
            "flowSegmentData": {
                "currentSpeed": round(speed / 3.6, 2), "freeFlowSpeed": 33.0,
                "coordinates": {"coordinate": [{"latitude": 10.7715, "longitude": 106.6664}]},
            },
            "_fetched_at": local.replace(" ", "T"),
        }))
        for place, spread in (("CMT8", 1.5), ("Care Centre", -1.5)):
            air.append(json.dumps({
                "period": {"datetimeFrom": {"local": local.replace(" ", "T")}}, "value": pm25 + spread,
                "parameter": {"name": "pm25"}, "location": place,
            }))
    frame = lambda texts: spark.createDataFrame(list(enumerate(texts)), "ingest_seq int, value string")
    return frame(traffic), frame(air)


def views(feeds):
    raw_traffic, raw_air = feeds
    readings = parse_traffic(raw_traffic, "2025-11-19 12:00:00").accepted
    return stage(hourly_traffic(readings), "golden"), stage(hourly_air(air_measurements(raw_air)), "golden")


def local_label(df):
    return df.withColumn("label", F.date_format(local_wall_clock(F.col("timestamp")), "MM-dd HH"))


def test_before_alignment(feeds, any_session_zone):
    combined = local_label(flag_critical(combine(*views(feeds), aligned=False)))
    rows = {r.label: r for r in combined.collect()}
    assert len(rows) == 23
    for label, speed, pm25, severity in HOURS:
        row = rows[label]
        assert row.road_segment_id == "segment_1077_10667"
        assert (round(row.avg_speed, 2), round(row.avg_pm25, 6)) == (speed, pm25)
        assert row.severity_index == pytest.approx(severity, abs=1e-6)
        assert (row.record_count, row.pm25_count, row.location_count) == (1, 2, 2)
    assert {k for k, r in rows.items() if r.is_critical} == {"11-18 14", "11-18 16", "11-19 07"}


def test_after_alignment(feeds, any_session_zone):
    flagged = flag_critical(combine(*views(feeds)))
    rows = {r.label: r for r in local_label(flagged).collect()}
    assert len(rows) == 21 and "11-19 08" not in rows
    merged = rows["11-19 10"]
    assert (merged.record_count, merged.pm25_count, merged.location_count) == (3, 6, 6)
    assert merged.avg_speed == pytest.approx(50.386667, abs=1e-6)
    assert (merged.min_speed, merged.max_speed) == (43.27, 60.19)
    assert merged.avg_pm25 == pytest.approx(29.800280, abs=1e-6)

    stats = summary_stats(flagged).first().asDict()
    assert (stats["total_records"], stats["critical_count"]) == (21, 3)
    expected = {
        "avg_speed_mean": 57.212222, "avg_speed_min": 11.84, "avg_speed_max": 91.44,
        "avg_pm25_mean": 38.617767, "avg_pm25_min": 21.80975, "avg_pm25_max": 80.0,
        "critical_percentage": 14.285714, "critical_speed_mean": 16.356667,
        "critical_pm25_mean": 64.150303, "critical_severity_mean": 0.578592,
    }
    for name, value in expected.items():
        assert stats[name] == pytest.approx(value, abs=1e-6), name


def test_critical_hours_and_periods(feeds):
    air = air_measurements(feeds[1])
    hours = critical_hours(air, "2025-11-18 12:00:00", 23)
    assert sorted(r.hour_offset for r in hours.collect()) == [2, 4, 19]
    periods = consecutive_periods(critical_only(flag_critical(combine(*views(feeds)))))
    assert [r.n_hours for r in periods.collect()] == [1, 1, 1]


def test_alignment_keeps_the_record_total(feeds):
    batch, air = views(feeds)
    total = batch.agg(F.sum("record_count")).first()[0]
    assert combine(batch, air).agg(F.sum("record_count")).first()[0] == total

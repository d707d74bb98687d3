import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from smogway.operators.parsing import air_measurements, air_payload, classify_air, classify_traffic, parse_air, parse_traffic
from smogway.sources.topics import air_records, traffic_records

AS_OF = "2025-11-19 00:00:00"
POINT = {"coordinate": [{"latitude": 10.7715, "longitude": 106.6664}, {"latitude": 1.0, "longitude": 2.0}]}


def raw(spark, records):
    rows = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "ingest_seq int, value string")


def flow(_fetched_at="2025-11-18T05:00:00+00:00", coordinates=POINT, **speeds):
    record = {"flowSegmentData": {**speeds}}
    if coordinates is not None:
        record["flowSegmentData"]["coordinates"] = coordinates
    if _fetched_at is not None:
        record["_fetched_at"] = _fetched_at
    return record


def traffic_rows(spark, records, **options):
    out = classify_traffic(raw(spark, records), AS_OF, **options).orderBy("ingest_seq")
    return out.withColumn("us", F.unix_micros("timestamp")).collect()


def test_speed_choice(spark):
    rows = traffic_rows(spark, [
        flow(currentSpeed=14.96, freeFlowSpeed=33),
        flow(currentSpeed=0, freeFlowSpeed=10),
        flow(currentSpeed=-3, freeFlowSpeed=10),
        flow(freeFlowSpeed=10),
        flow(currentSpeed=5, freeFlowSpeed=None),
        flow(currentSpeed=0, freeFlowSpeed=0),
        flow(),
        flow(currentSpeed=None, freeFlowSpeed=10),
        flow(currentSpeed="12", freeFlowSpeed=10),
        flow(currentSpeed=0, freeFlowSpeed="12"),
    ])
    assert [(r.reason, r.velocity) for r in rows[:5]] == [(None, 53.86), (None, 36.0), (None, 36.0), (None, 36.0), (None, 18.0)]
    assert [r.reason for r in rows[5:]] == ["non_positive_speed"] * 2 + ["bad_speed"] * 3


def test_missing_or_odd_flow_segments(spark):
    rows = traffic_rows(spark, [{}, {"flowSegmentData": None}, {"flowSegmentData": {}}, {"flowSegmentData": "x"}, [1], "not json",
                                '{"flowSegmentData":{"currentSpeed":5}} trailing', '{"flowSegmentData":{"currentSpeed":5}}{}'])
    assert [r.reason for r in rows] == ["no_flow_segment"] * 3 + ["bad_flow_segment", "not_an_object"] + ["invalid_json"] * 3


def test_grid_cells(spark):
    def at(lat, lon):
        return {"coordinate": [{"latitude": lat, "longitude": lon}]}

    rows = traffic_rows(spark, [
        flow(currentSpeed=5),
        flow(currentSpeed=5, coordinates=None),
        flow(currentSpeed=5, coordinates={"coordinate": []}),
        flow(currentSpeed=5, coordinates=at(None, 106.0)),
        flow(currentSpeed=5, coordinates="here"),
        flow(currentSpeed=5, coordinates=at(0.125, -0.375)),
        flow(currentSpeed=5, coordinates=at("10.5", 106.0)),
    ])
    assert [r.segment_id for r in rows[:6]] == ["segment_1077_10667"] + ["segment_unknown"] * 4 + ["segment_12_-38"]
    assert rows[6].reason == "bad_coordinates"


def test_query_point_replaces_missing_coordinates(spark):
    rows = traffic_rows(spark, [flow(currentSpeed=5, coordinates=None)], query_lat=F.lit(10.7715), query_lon=F.lit(106.6664))
    assert rows[0].segment_id == "segment_1077_10667"


def test_fetch_times(spark, any_session_zone):
    stamps = ["2025-11-18T05:00:00Z", "2025-11-18T12:00:00+07:00", "2025-11-18T12:00:00", None, "bad", ""]
    rows = traffic_rows(spark, [flow(currentSpeed=5, _fetched_at=s) for s in stamps] + [
        {**flow(currentSpeed=5), "_fetched_at": 7}, {**flow(currentSpeed=5), "_fetched_at": None}])
    assert {r.us for r in rows[:3]} == {1763442000000000}
    assert {r.us for r in rows[3:]} == {1763485200000000}


def test_bare_nan_speed(spark):
    rows = traffic_rows(spark, ['{"flowSegmentData":{"currentSpeed":NaN,"freeFlowSpeed":10}}'])
    assert (rows[0].reason, rows[0].velocity) == (None, 36.0)


def test_accepted_and_rejected_partition_the_input(spark):
    parsed = parse_traffic(raw(spark, [flow(currentSpeed=5), {}, "x"]), AS_OF)
    assert parsed.accepted.columns == ["timestamp", "segment_id", "velocity", "ingest_seq"]
    assert parsed.accepted.count() == 1
    assert {r.reason for r in parsed.rejected.collect()} == {"no_flow_segment", "invalid_json"}


# --- air ---------------------------------------------------------------------------------------

LOCAL = {"utc": "2025-11-18T05:00:00Z", "local": "2025-11-18T12:00:00+07:00"}
NOON = 1763442000000000


def measurement(**changes):
    record = {
        "period": {"datetimeFrom": LOCAL, "datetimeTo": {"utc": "2025-11-18T06:00:00Z"}},
        "value": 47.5, "parameter": {"name": "pm25"},
        "coordinates": {"latitude": 10.7, "longitude": 106.6}, "location": "CMT8",
    }
    record.update(changes)
    return {k: v for k, v in record.items() if v is not ...}


def air_rows(spark, records):
    out = classify_air(raw(spark, records)).orderBy("ingest_seq")
    return out.withColumn("us", F.unix_micros("timestamp")).collect()


def test_only_records_with_a_local_time_are_read_with_types(spark):
    record = {"period": {"datetimeFrom": {"local": "2024-01-10T07:00:00+07:00"}}, "value": 9.5, "parameter": {"name": "pm25"},
              "location": "a", "coordinates": {"latitude": 10.5, "longitude": 106.5}}
    plain = json.dumps(record)
    out = classify_air(raw(spark, [plain, plain.replace("local", "l\\u006fcal")]))
    assert 'contains(value' in out._jdf.queryExecution().optimizedPlan().toString().lower()
    canonical, escaped = out.orderBy("ingest_seq").collect()
    assert canonical.reason is None and canonical.pm25 == 9.5 and canonical.latitude == 10.5
    same = ["timestamp", "location", "pm25", "latitude", "longitude", "reason"]
    assert [canonical[c] for c in same] == [escaped[c] for c in same]


def test_canonical_measurement(spark, any_session_zone):
    row = air_rows(spark, [measurement()])[0]
    assert (row.us, row.location, row.pm25, row.latitude, row.longitude, row.reason) == (NOON, "CMT8", 47.5, 10.7, 106.6, None)


def test_time_cascade(spark, any_session_zone):
    naive = "2025-11-18T05:00:00"
    rows = air_rows(spark, [
        measurement(date="2025-11-18T05:00:00Z", period=...),
        measurement(date={"LOCAL": LOCAL["local"], "utc": "2000-01-01T00:00:00Z"}, period=...),
        measurement(date={"local": "", "UTC": LOCAL["utc"]}, period=...),
        measurement(datetime=naive, period=...),
        measurement(datetime={"utc": LOCAL["utc"]}, period=...),
        measurement(date={}, datetime="2000-01-01T00:00:00Z"),
        measurement(date=None, datetime="2000-01-01T00:00:00Z"),
        measurement(period={"datetime_from": naive}),
        measurement(period={"datetimeFrom": {}, "datetime_from": {"utc": LOCAL["utc"]}}),
        measurement(period={"datetimeFrom": {"local": ""}, "datetimeTo": LOCAL}),
        measurement(period={"datetime_to": LOCAL["utc"]}),
    ])
    assert [(r.us, r.reason) for r in rows] == [(NOON, None)] * len(rows)


def test_bad_times(spark):
    rows = air_rows(spark, [
        measurement(period=...), measurement(period={}), measurement(period="x"), measurement(date="soon"),
        measurement(period={"datetimeFrom": {"local": "soon"}}),
    ])
    assert [r.reason for r in rows] == ["missing_timestamp"] * 3 + ["bad_timestamp"] * 2


def test_parameter_rule(spark):
    kept = [measurement(parameter=p) for p in (..., {"name": "PM25"}, {"name": "pm2.5 µg"}, "pm25", "PM2.5", ["pm25"])]
    kept += [measurement(parameter=..., parameter_id=2), measurement(parameter=..., parameter_id=3)]
    dropped = [measurement(parameter=p) for p in ({}, None, "o3", {"name": "o3"})]
    broken = [measurement(parameter={"name": None}), measurement(parameter={"name": 25})]
    reasons = [r.reason for r in air_rows(spark, kept + dropped + broken)]
    assert reasons == [None] * len(kept) + ["not_pm25"] * len(dropped) + ["bad_parameter"] * 2


def test_values(spark):
    records = [measurement(value=v) for v in (0, -999, "12.5", True)]
    records += [json.dumps(measurement(value=1)).replace('"value": 1,', '"value": NaN,')]
    records += [measurement(value=None), measurement(value=...), measurement(value="x"), measurement(value={})]
    rows = air_rows(spark, records)
    assert [(r.pm25, r.reason) for r in rows[:5]] == [(0.0, None), (-999.0, None), (12.5, None), (1.0, None), (None, None)]
    assert [r.reason for r in rows[5:]] == ["missing_value"] * 2 + ["bad_value"] * 2


def test_locations_and_coordinates(spark):
    rows = air_rows(spark, [
        measurement(location="", locationName="B"), measurement(location=..., locationName="B"),
        measurement(location=..., ), measurement(location=None),
        measurement(location={"name": "N", "id": 5, "coordinates": {"latitude": 1.5, "longitude": 2.5}}, coordinates=...),
        measurement(location={"id": 5}), measurement(location=7), measurement(coordinates=...),
    ])
    assert [r.location for r in rows] == ["B", "B", "Unknown", "Unknown", "N", "5", "7", "CMT8"]
    assert (rows[4].latitude, rows[4].longitude) == (1.5, 2.5)
    assert (rows[7].latitude, rows[7].longitude) == (None, None)


def test_first_arrival_wins(spark):
    records = [measurement(value=1.0), measurement(value=2.0), measurement(value=3.0, location="B")]
    rows = air_measurements(raw(spark, records).repartition(4)).collect()
    assert sorted((r.location, r.pm25) for r in rows) == [("B", 3.0), ("CMT8", 1.0)]


def test_payload_is_the_inverse_of_the_parser(spark):
    flat = spark.createDataFrame(
        [(LOCAL["utc"], LOCAL["local"], "2025-11-18T06:00:00Z", "2025-11-18T13:00:00+07:00", 47.5, "pm25", 10.7, 106.6, "CMT8")],
        "utc_from string, local_from string, utc_to string, local_to string, value double, parameter string,"
        " latitude double, longitude double, location string",
    )
    payload = air_payload(flat)
    body = json.loads(payload.first().value)
    assert body["period"]["datetimeTo"]["local"] == "2025-11-18T13:00:00+07:00"
    assert body["period"]["interval"] == "01:00:00"
    row = parse_air(payload).accepted.first()
    assert (row.location, row.pm25, row.latitude) == ("CMT8", 47.5, 10.7)


def test_topic_keys(spark):
    traffic = traffic_records(raw(spark, [flow(), flow(_fetched_at=None), flow(_fetched_at="")]))
    assert [r.key for r in traffic.collect()] == ["2025-11-18T05:00:00+00:00", "unknown", None]
    air = air_records(raw(spark, [
        measurement(), measurement(location={"id": 9}), measurement(location={"name": "x"}), measurement(location=...),
        measurement(location="unknown"), measurement(location=..., period=...), measurement(location=..., period=..., value=...),
    ]))
    local = LOCAL["local"]
    assert [r.key for r in air.collect()] == ["CMT8", "9", local, local, local, "47.5", "unknown"]


@pytest.mark.parametrize("order", [1, 7])
def test_result_is_independent_of_partitioning(spark, order):
    records = [measurement(value=float(i), location=f"L{i % 3}") for i in range(30)]
    rows = air_measurements(raw(spark, records).repartition(order)).collect()
    assert sorted((r.location, r.pm25) for r in rows) == [("L0", 0.0), ("L1", 1.0), ("L2", 2.0)]


def test_undated_records_take_the_time_of_their_message(spark):
    body = json.dumps({"flowSegmentData": {"currentSpeed": 5.0}})
    sent = [datetime(2024, 1, d, tzinfo=timezone.utc) for d in (1, 2)]
    raw = spark.createDataFrame([(body, t) for t in sent], "value string, sent timestamp")
    micros = parse_traffic(raw, F.col("sent")).accepted.select(F.unix_seconds("timestamp").alias("s")).collect()
    assert sorted(r.s for r in micros) == [int(t.timestamp()) for t in sent]


@pytest.mark.parametrize("current, free, reason, kmh", [
    (0, 10.0, None, 36.0), (-1, 10, None, 36.0), (0, 0, "non_positive_speed", None), (0, -5.0, "non_positive_speed", None),
    (0, None, "bad_speed", None), (0, "10", "bad_speed", None), (5, None, None, 18.0), (5, "x", None, 18.0), (None, 5, "bad_speed", None),
])
def test_standing_traffic_takes_the_free_flow_speed(spark, current, free, reason, kmh):
    place = {"coordinate": [{"latitude": 10.77, "longitude": 106.66}]}
    body = json.dumps({"flowSegmentData": {"currentSpeed": current, "freeFlowSpeed": free, "coordinates": place}})
    parsed = parse_traffic(spark.createDataFrame([(body,)], "value string"), "2024-01-01")
    if reason:
        assert [r.reason for r in parsed.rejected.collect()] == [reason]
    else:
        assert [(r.velocity, r.segment_id) for r in parsed.accepted.collect()] == [(kmh, "segment_1077_10666")]

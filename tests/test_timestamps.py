from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from smogway.functions.timestamps import (
    add_partition_columns,
    instant_from_wall_clock,
    local_wall_clock,
    parse_instant,
    parse_timestamp,
    prune,
    time_literal,
    utc_wall_clock,
)

HCMC = "Asia/Ho_Chi_Minh"


def instants(spark, texts, naive_tz):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    parsed = df.select("i", F.unix_micros(parse_instant(F.col("t"), naive_tz)).alias("us"))
    return [r.us for r in parsed.orderBy("i").collect()]


def micros(*args):
    return int(datetime(*args, tzinfo=timezone.utc).timestamp() * 1_000_000)


def test_iso_spellings(spark, any_session_zone):
    five = micros(2025, 11, 18, 5)
    same = [
        "2025-11-18T05:00:00Z", "2025-11-18 05:00:00Z", "2025-11-18T05:00:00+00:00", "2025-11-18T12:00:00+07:00",
        "2025-11-18T12:00:00+0700", "2025-11-18T12:00:00+07", "2025-11-18T12:00+07:00", "2025-11-18T12:00:00",
        "2025-11-18 12:00", "2025-11-18T12", "20251118T120000", "2025-11-18T12:00:00,000", "2025-11-18T12:00:00.000000000",
    ]
    assert instants(spark, same, HCMC) == [five] * len(same)


def test_naive_text_follows_the_rule_of_its_feed(spark, any_session_zone):
    assert instants(spark, ["2025-11-18T12:00:00"], HCMC) == [micros(2025, 11, 18, 5)]
    assert instants(spark, ["2025-11-18T12:00:00"], "UTC") == [micros(2025, 11, 18, 12)]
    assert instants(spark, ["2025-11-18", "20251118"], "UTC") == [micros(2025, 11, 18)] * 2


def test_unparsable_text_is_null(spark):
    bad = ["", "bad", "05:00", "05:00:00", "2025", "2025-13-01", "2025-02-30T00:00:00", "2025-11-18T25:00:00", "now", None]
    assert instants(spark, bad, "UTC") == [None] * len(bad)


def test_fraction_is_kept(spark):
    assert instants(spark, ["2025-11-18T05:00:00.123456Z"], "UTC") == [micros(2025, 11, 18, 5) + 123456]


def test_wall_clock_conversions_survive_clock_changes(spark, any_session_zone):
    # 05:30Z and 06:30Z show the same New York wall clock on that day.
    df = spark.createDataFrame([(micros(2024, 11, 3, 5, 30),), (micros(2024, 11, 3, 6, 30),)], "us bigint")
    ts = F.timestamp_micros("us")
    out = df.select(
        utc_wall_clock(ts).cast("string").alias("utc"),
        local_wall_clock(ts, HCMC).cast("string").alias("local"),
        (F.unix_micros(instant_from_wall_clock(utc_wall_clock(ts))) - F.col("us")).alias("drift"),
        (F.unix_micros(instant_from_wall_clock(local_wall_clock(ts, HCMC), HCMC)) - F.col("us")).alias("drift2"),
    ).collect()
    assert sorted(r.utc for r in out) == ["2024-11-03 05:30:00", "2024-11-03 06:30:00"]
    assert sorted(r.local for r in out) == ["2024-11-03 12:30:00", "2024-11-03 13:30:00"]
    assert {r.drift for r in out} == {0} and {r.drift2 for r in out} == {0}


def test_partition_columns_are_local(spark, any_session_zone):
    df = spark.createDataFrame([("2025-12-31T18:00:00Z",)], "timestamp string")
    expected = (2026, 1, 1)
    assert tuple(add_partition_columns(df).select("year", "month", "day").first()) == expected
    parsed = parse_timestamp(df)
    assert tuple(add_partition_columns(parsed).select("year", "month", "day").first()) == expected
    assert add_partition_columns(df.withColumnRenamed("timestamp", "t")).columns == ["t"]


def test_parse_timestamp_drops_unparsable_rows_and_needs_the_column(spark):
    df = spark.createDataFrame([("2025-01-01T00:00:00Z",), ("x",), (None,)], "timestamp string")
    assert parse_timestamp(df).count() == 1
    with pytest.raises(ValueError):
        parse_timestamp(df, "missing")


def test_time_literal(spark, any_session_zone):
    naive = time_literal("2024-01-31 00:00:00", False)
    aware = time_literal("2024-01-30T17:00:00+00:00", False)
    wall = time_literal(datetime(2024, 1, 30, 17, tzinfo=timezone.utc), True)
    row = spark.range(1).select(F.unix_micros(naive).alias("n"), F.unix_micros(aware).alias("a"), wall.cast("string").alias("w")).first()
    assert row.n == row.a == micros(2024, 1, 30, 17)
    assert row.w == "2024-01-31 00:00:00"


def test_prune_uses_partitions_and_pushdown(spark, tmp_path):
    days = spark.range(60).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400).alias("timestamp"))
    add_partition_columns(days).write.partitionBy("year", "month").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    cut = prune(stored, datetime(2024, 1, 10), datetime(2024, 1, 12))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "year" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "GreaterThanOrEqual(timestamp" in plan
    assert cut.count() == 2

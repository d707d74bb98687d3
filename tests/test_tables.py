"""Versions of stored tables, sorted files, and plans that skip what a bound leaves out."""

import random
from datetime import datetime, timedelta, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from smogway.operators import critical as C
from smogway.operators import integrate as I
from smogway.operators.filters import recent_or_all
from smogway.operators.quality import only_row
from smogway.schemas import BATCH_VIEW, HOURLY_AIR, SPEED_VIEW
from smogway.sources.folders import names_in
from smogway.sources.tables import Layout, append_table, next_arrival, read_table, upsert_table, write_table

JAN = datetime(2024, 1, 10, tzinfo=timezone.utc)


def air(spark, *rows):
    return spark.createDataFrame([(JAN + timedelta(hours=h), loc, v, None, None) for h, loc, v in rows], SPEED_VIEW)


def values(df):
    return sorted(r.pm25 for r in df.collect())


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_readers_keep_their_version(spark, tmp_path, fmt):
    spec = Layout(str(tmp_path), fmt).speed_view
    write_table(air(spark, (0, "x", 1.0), (1, "y", 2.0)), spec)
    before = read_table(spark, spec)
    write_table(before.withColumn("pm25", F.col("pm25") + 10), spec)
    assert values(before) == [1.0, 2.0] and values(read_table(spark, spec)) == [11.0, 12.0]
    append_table(air(spark, (2, "z", 3.0)), spec)
    assert values(read_table(spark, spec)) == [3.0, 11.0, 12.0]
    for v in (5.0, 6.0):
        write_table(air(spark, (0, "x", v)), spec)
    assert values(read_table(spark, spec)) == [6.0]
    assert len(names_in(spark, f"{spec.path}/_data")) == len(names_in(spark, f"{spec.path}/_versions")) == 2


def test_a_failing_overwrite_leaves_the_table(spark, tmp_path):
    spec = Layout(str(tmp_path)).speed_view
    write_table(air(spark, (0, "x", 1.0)), spec)
    failing = air(spark, *((h, "x", float(h)) for h in range(50))).withColumn(
        "pm25", F.when(F.col("pm25") > 40, F.raise_error(F.lit("lost"))).otherwise(F.col("pm25")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        write_table(failing, spec)
    assert values(read_table(spark, spec)) == [1.0]
    write_table(air(spark, (0, "x", 2.0)), spec)
    assert values(read_table(spark, spec)) == [2.0] and len(names_in(spark, f"{spec.path}/_data")) == 2


def test_upserts_go_into_the_current_version(spark, tmp_path):
    spec = Layout(str(tmp_path)).speed_view
    write_table(air(spark, (0, "x", 1.0), (30, "x", 2.0)), spec)
    upsert_table(air(spark, (0, "x", 5.0)), spec)
    assert values(read_table(spark, spec)) == [2.0, 5.0]


def test_new_rows_of_one_key_need_an_order(spark, tmp_path):
    twice = air(spark, (0, "x", 1.0), (0, "x", 2.0))
    with pytest.raises(Exception, match="several rows for a key"):
        upsert_table(twice, Layout(str(tmp_path)).speed_view)
    assert only_row(air(spark, (0, "x", 1.0), (0, None, 2.0)), ["timestamp", "location"]).count() == 2


def test_arrival_numbers_rise(spark, tmp_path):
    spec = Layout(str(tmp_path)).air_raw
    assert [next_arrival(spark, spec) for _ in range(3)] == [0, 1, 2]


def hourly(spark, n, segments=("a", "b")):
    rows = [(JAN + timedelta(hours=h), s, 1.0 * h, 1.0, 2.0, 1) for h in range(n) for s in segments]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, BATCH_VIEW).repartition(4)


def test_one_day_is_a_few_row_groups(spark, tmp_path):
    spec = Layout(str(tmp_path)).batch_view
    before = spark.conf.get("parquet.block.size", None)
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "16384")
    try:
        write_table(hourly(spark, 20 * 24, [f"segment {i}" for i in range(40)]), spec)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    assert before is None
    day = JAN + timedelta(days=5)
    touched = total = 0
    for file in tmp_path.rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for i in range(meta.num_row_groups):
            group = meta.row_group(i)
            stats = next(group.column(c).statistics for c in range(group.num_columns) if group.column(c).path_in_schema == "timestamp")
            low, high = (t if t.tzinfo else t.replace(tzinfo=timezone.utc) for t in (stats.min, stats.max))
            total += 1
            touched += low < day + timedelta(days=1) and high >= day
    assert total >= 20 and touched <= total / 5


def scans(df):
    """The file scans of a plan, without those of subqueries that are reused."""
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]


def test_alignment_reads_a_view_twice_and_prunes(spark, tmp_path):
    layout = Layout(str(tmp_path))
    write_table(hourly(spark, 90 * 24), layout.batch_view)
    batch = read_table(spark, layout.batch_view)
    hours = spark.createDataFrame([(JAN + timedelta(hours=h + 1), 60.0, 3, 2) for h in range(90 * 24)], HOURLY_AIR)
    combined = I.combine(batch, hours)
    of_view = [line for line in scans(combined) if "min_speed" in line]
    assert len(of_view) == 2
    pruned = [line for line in of_view if "PartitionFilters: []" not in line]
    assert len(pruned) == 1 and "GreaterThanOrEqual(timestamp" in pruned[0]
    assert combined.where("record_count = 4").count() == 0  # two hours of either view move onto the newest
    newest = combined.orderBy(F.col("timestamp").desc()).first()
    assert newest.timestamp.replace(tzinfo=timezone.utc) == JAN + timedelta(hours=90 * 24) and newest.record_count == 2
    recent = I.combine(batch, hours, as_of=JAN + timedelta(days=90))
    assert all("PartitionFilters: []" not in line for line in scans(recent) if "min_speed" in line)
    assert recent.count() < 60


def test_recency_looks_at_recent_partitions_only(spark, tmp_path):
    layout = Layout(str(tmp_path))
    write_table(hourly(spark, 90 * 24), layout.batch_view)
    stored = read_table(spark, layout.batch_view)
    recent = recent_or_all(stored, JAN + timedelta(days=90))
    assert recent.count() == 2 * 24 and "PartitionFilters: []" not in scans(recent)[0]
    assert recent_or_all(stored, JAN + timedelta(days=900)).count() == 90 * 48


@pytest.mark.parametrize("seed", range(3))
def test_periods_over_days_and_years(spark, seed, any_session_zone):
    rng = random.Random(seed)
    start = datetime(2022, 12, 28, 5)
    hours = sorted({h for h in range(0, 24 * 400) if rng.random() < (0.995 if h < 24 * 8 or h > 24 * 365 else 0.4)})
    rows = [(start + timedelta(hours=h, minutes=rng.randrange(60)),) for h in hours for _ in range(rng.randint(1, 2))]
    found = C.consecutive_periods(spark.createDataFrame(rows, "timestamp timestamp_ntz"))
    expected, first = [], hours[0]
    for a, b in zip(hours, [*hours[1:], None]):
        if b != a + 1:
            expected.append((start + timedelta(hours=first), start + timedelta(hours=a + 1), a + 1 - first))
            first = b
    assert sorted(map(tuple, found.collect())) == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "yearly-runs" in plan  # all that is left to do reads the yearly runs


def test_periods_of_no_hours(spark):
    empty = spark.createDataFrame([], "timestamp timestamp")
    assert C.consecutive_periods(empty).collect() == []

"""Critical hours, severity and the tables behind reports and charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogway.functions.numbers import clamp01, nan_to_null, without_nan
from smogway.functions.timestamps import hours, is_wall_clock, local_wall_clock, time_bucket
from smogway.operators.quality import count_where, validate_columns
from smogway.settings import DEFAULTS
from smogway.sources.staging import stage


def is_critical(pm25_threshold: float, speed_threshold: float) -> Column:
    """Strictly more PM2.5 and strictly less speed than the thresholds; false when either is unknown.

    A conjunction that is never NULL: as a filter it splits, so each half reaches its side of the join
    and the outer join turns into an inner one.
    """
    pm, speed = nan_to_null(F.col("avg_pm25")), nan_to_null(F.col("avg_speed"))
    return pm.isNotNull() & speed.isNotNull() & (pm > pm25_threshold) & (speed < speed_threshold)


def severity_index(pm25_full_scale: float, speed_full_scale: float) -> Column:
    """Mean of normalised PM2.5 and inverted normalised speed; NULL when either is unknown."""
    pm = clamp01(nan_to_null(F.col("avg_pm25")) / pm25_full_scale)
    speed = clamp01(nan_to_null(F.col("avg_speed")) / speed_full_scale)
    return (pm + (F.lit(1.0) - speed)) / 2


def flag_critical(
    combined: DataFrame,
    pm25_threshold: float = DEFAULTS.pm25_threshold,
    speed_threshold: float = DEFAULTS.speed_threshold,
    pm25_full_scale: float = DEFAULTS.pm25_full_scale,
    speed_full_scale: float = DEFAULTS.speed_full_scale,
) -> DataFrame:
    validate_columns(combined, ["avg_pm25", "avg_speed"], "combined view")
    return combined.withColumns(
        {
            "is_critical": is_critical(pm25_threshold, speed_threshold),
            "severity_index": severity_index(pm25_full_scale, speed_full_scale),
        }
    )


def critical_only(flagged: DataFrame) -> DataFrame:
    return flagged.where("is_critical")


def quadrant(
    combined: DataFrame,
    pm25_threshold: float = DEFAULTS.pm25_threshold,
    speed_threshold: float = DEFAULTS.speed_threshold,
) -> DataFrame:
    """Add `quadrant`, NULL when either metric is unknown."""
    high, slow = F.col("avg_pm25") > pm25_threshold, F.col("avg_speed") < speed_threshold
    known = F.col("avg_pm25").isNotNull() & F.col("avg_speed").isNotNull()
    label = (
        F.when(high & slow, F.lit("critical"))
        .when(high, F.lit("high_pm25_normal_speed"))
        .when(slow, F.lit("low_speed_good_air"))
        .otherwise(F.lit("normal"))
    )
    return without_nan(combined, "avg_pm25", "avg_speed").withColumn("quadrant", F.when(known, label))


def top_severe(flagged: DataFrame, k: int, tie_break: Sequence[str] = ("timestamp", "road_segment_id")) -> DataFrame:
    """The k most severe critical rows; a sort with a limit, so each task keeps only k rows."""
    return critical_only(flagged).orderBy(F.desc("severity_index"), *tie_break).limit(k)


def scatter_pairs(flagged: DataFrame) -> DataFrame:
    """Rows with both metrics, for a PM2.5 against speed chart."""
    return flagged.dropna(subset=["avg_speed", "avg_pm25"])


def _local(df: DataFrame, tz: str) -> Column:
    ts = F.col("timestamp")
    return ts if is_wall_clock(df, "timestamp") else local_wall_clock(ts, tz)


def time_series(
    flagged: DataFrame,
    pm25_threshold: float = DEFAULTS.pm25_threshold,
    speed_threshold: float = DEFAULTS.speed_threshold,
    tz: str = DEFAULTS.timezone,
) -> DataFrame:
    """Local times, both metrics, the thresholds and the critical marker; sort at the sink."""
    segment = ["road_segment_id"] if "road_segment_id" in flagged.columns else []
    return flagged.select(
        _local(flagged, tz).alias("local_time"),
        *segment,
        "avg_speed",
        "avg_pm25",
        F.lit(speed_threshold).alias("speed_threshold"),
        F.lit(pm25_threshold).alias("pm25_threshold"),
        F.coalesce(F.col("is_critical"), F.lit(False)).alias("is_critical"),
    )


def severity_shade(flagged: DataFrame, flat: float = 1.0) -> DataFrame:
    """Add `shade`: 0.4 to 1.0 relative to the worst severity, `flat` when that is not positive."""
    worst = flagged.agg(F.max("severity_index")).scalar()
    relative = F.lit(0.4) + F.lit(0.6) * (F.col("severity_index") / worst)
    return flagged.withColumn("shade", F.when(worst > 0, relative).otherwise(F.lit(flat)))


def critical_timeline(flagged: DataFrame, tz: str = DEFAULTS.timezone) -> DataFrame:
    """One bar per critical row: local interval, labels and shade; sort at the sink."""
    critical = severity_shade(critical_only(flagged)).withColumn("start_time", _local(flagged, tz))
    segment = ["road_segment_id"] if "road_segment_id" in flagged.columns else []

    def part(column: str, template: str) -> Column:
        return F.when(F.col(column).isNotNull(), F.format_string(template, F.col(column)))

    return critical.select(
        "start_time",
        (F.col("start_time") + hours(1)).alias("end_time"),
        *segment,
        F.date_format("start_time", "HH:mm").alias("time_label"),
        F.concat_ws(
            "\n", part("avg_pm25", "PM2.5: %.1f µg/m³"), part("avg_speed", "Speed: %.1f km/h")
        ).alias("info"),
        "severity_index",
        "shade",
    )


def timeline_summary(flagged: DataFrame) -> DataFrame:
    """One row about the critical rows: count, mean and worst PM2.5, mean and lowest speed."""
    return critical_only(flagged).agg(
        F.count(F.lit(1)).alias("critical_count"),
        F.avg("avg_pm25").alias("mean_pm25"),
        F.max("avg_pm25").alias("max_pm25"),
        F.avg("avg_speed").alias("mean_speed"),
        F.min("avg_speed").alias("min_speed"),
    )


def summary_stats(flagged: DataFrame) -> DataFrame:
    """One row of statistics over the combined view, in a single pass."""
    critical = F.col("is_critical")

    def of_critical(column: str) -> Column:
        return F.avg(F.when(critical, F.col(column)))

    total = F.count(F.lit(1))
    n_critical = count_where(critical)
    return flagged.agg(
        total.alias("total_records"),
        F.count("avg_speed").alias("records_with_speed"),
        F.avg("avg_speed").alias("avg_speed_mean"),
        F.min("avg_speed").alias("avg_speed_min"),
        F.max("avg_speed").alias("avg_speed_max"),
        F.count("avg_pm25").alias("records_with_pm25"),
        F.avg("avg_pm25").alias("avg_pm25_mean"),
        F.min("avg_pm25").alias("avg_pm25_min"),
        F.max("avg_pm25").alias("avg_pm25_max"),
        n_critical.alias("critical_count"),
        F.when(total > 0, n_critical / total * 100).otherwise(F.lit(0.0)).alias("critical_percentage"),
        of_critical("avg_speed").alias("critical_speed_mean"),
        of_critical("avg_pm25").alias("critical_pm25_mean"),
        of_critical("severity_index").alias("critical_severity_mean"),
    )


def _islands(spans: DataFrame, by: Sequence[str]) -> DataFrame:
    """Spans (`start`, `past`, `n_hours`) joined where one begins as another of the same `by` ends."""
    order = Window.partitionBy(*by).orderBy("start")
    begins = (F.col("start") != F.lag("past").over(order)).cast("int")
    numbered = spans.withColumn("_run", F.sum(F.coalesce(begins, F.lit(1))).over(order))
    return numbered.groupBy(*by, "_run").agg(
        F.min("start").alias("start"), F.max("past").alias("past"), F.sum("n_hours").alias("n_hours")
    ).drop("_run")


def consecutive_periods(hours_df: DataFrame, keys: Sequence[str] = (), column: str = "timestamp") -> DataFrame:
    """Runs of consecutive hours as (start, end, n_hours), per `keys`. Times inside an hour stand for that hour.

    Hours are joined within days, days within years, in as many tasks as there are days and years (and keys). Only the
    runs that touch the first or last hour of a year, two a year at most, are joined over all years.
    """
    hour = time_bucket(column)
    spans = hours_df.select(*keys, hour.alias("start")).distinct().where(F.col("start").isNotNull())
    spans = spans.withColumns({"past": F.col("start") + hours(1), "n_hours": F.lit(1).cast("bigint"), "_day": F.to_date("start")})
    days = _islands(spans, [*keys, "_day"]).withColumn("_year", F.year("_day"))
    runs = _islands(days, [*keys, "_year"])
    first = F.make_date("_year", F.lit(1), F.lit(1))
    next_first = F.make_date(F.col("_year") + 1, F.lit(1), F.lit(1))
    at_edge = (F.col("start") < first + F.expr("INTERVAL 1 HOUR")) | (F.col("past") >= next_first)
    runs = stage(runs.withColumn("_edge", at_edge), "yearly-runs")
    across = _islands(runs.where("_edge").drop("_edge", "_year"), list(keys))
    whole = runs.where("not _edge").drop("_edge", "_year").unionByName(across)
    return whole.select(*keys, F.col("start").alias("period_start"), F.col("past").alias("period_end"), "n_hours")


def in_hours(readings: DataFrame, hours_df: DataFrame, inside: bool = True) -> DataFrame:
    """Readings whose hour is (or is not) among the hours of `hours_df`.

    Pass stored hours: from their size the planner sees that the readings need no shuffle.
    """
    wanted = hours_df.select(F.col("timestamp").alias("_hour")).distinct()
    keyed = readings.withColumn("_hour", time_bucket("timestamp"))
    return keyed.join(wanted, "_hour", "left_semi" if inside else "left_anti").drop("_hour")

"""Joining the traffic view and the air view into the combined view.

Recency and alignment depend on facts about whole views: their first and last hours. Those are read once, from the time
column alone, into a staged table of hours; the bounds that follow are literals, which the readers of stored views use
to skip partitions and row groups. Only the newest hours are read a second time, to be merged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogway.functions.timestamps import TimeLike, instant_from_wall_clock, is_wall_clock, like_column, prune, time_value
from smogway.operators.aggregates import reaggregate_air, reaggregate_traffic
from smogway.operators.quality import count_where, validate_columns
from smogway.schemas import BATCH_VIEW, HOURLY_AIR, names
from smogway.settings import DEFAULTS
from smogway.sources.staging import stage

_AIR_MEASURES = ["avg_pm25", "pm25_count", "location_count"]


def canonical_batch(batch: DataFrame) -> DataFrame:
    """Only the batch-view columns; the segment column is optional."""
    columns = [c for c in names(BATCH_VIEW) if c in batch.columns or c != "road_segment_id"]
    return validate_columns(batch, columns, "batch view").select(*columns)


def canonical_air(air: DataFrame) -> DataFrame:
    return validate_columns(air, names(HOURLY_AIR), "hourly air view").select(*names(HOURLY_AIR))


_HOUR = timedelta(hours=1)
_EPOCH = datetime(1970, 1, 1)


@dataclass(frozen=True)
class Extent:
    """The first and last time of a view, as wall clocks in UTC; both None for an empty one."""

    first: datetime | None
    last: datetime | None


def _micros(time: Column, wall_clock: bool) -> Column:
    return F.unix_micros(instant_from_wall_clock(time) if wall_clock else time)


def _moment(micros: int | None) -> datetime | None:
    return None if micros is None else _EPOCH + timedelta(microseconds=micros)


def _for(view: DataFrame, moment: datetime) -> datetime:
    """`moment` as `prune` and `like_column` want it for the time column of `view`."""
    return moment if is_wall_clock(view, "timestamp") else moment.replace(tzinfo=timezone.utc)


def extents(*times: DataFrame) -> list[Extent]:
    """The extents of some views in one job."""
    ends = None
    for i, view in enumerate(times):
        micros = _micros(F.col("timestamp"), is_wall_clock(view, "timestamp"))
        one = view.agg(F.min(micros).alias("first"), F.max(micros).alias("last")).withColumn("view", F.lit(i))
        ends = one if ends is None else ends.unionByName(one)
    return [Extent(_moment(r["first"]), _moment(r["last"])) for r in sorted(ends.collect(), key=lambda r: r["view"])]


def recent_views(
    batch: DataFrame,
    air: DataFrame,
    as_of: TimeLike,
    recency_hours: float = DEFAULTS.recency_hours,
    known: tuple[Extent, Extent] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Each view cut to its recent hours where it has any; nothing is cut when there is no air data."""
    batch_extent, air_extent = known or extents(batch, air)
    if air_extent.last is None:
        return batch, air

    def cut(view: DataFrame, extent: Extent) -> DataFrame:
        cutoff = time_value(as_of, view, "timestamp") - timedelta(hours=recency_hours)
        if extent.last is None or _for(view, extent.last) < cutoff:
            return view
        return prune(view, cutoff)

    return cut(batch, batch_extent), cut(air, air_extent)


def alignment_hour(
    batch: Extent, air: Extent, tolerance_hours: float = DEFAULTS.tolerance_hours
) -> datetime | None:
    """The hour both views snap to, or None when their newest hours are further apart than the tolerance."""
    if batch.last is None or air.last is None or abs(batch.last - air.last) > timedelta(hours=tolerance_hours):
        return None
    later = max(batch.last, air.last)
    return later - (later - _EPOCH) % _HOUR


def _near(view: DataFrame, target: datetime, tolerance_hours: float) -> Column:
    gap = timedelta(hours=tolerance_hours)
    ends = [like_column(_for(view, t), view, "timestamp") for t in (target - gap, target + gap)]
    return F.coalesce(F.col("timestamp").between(*ends), F.lit(False))


def merge_newest(
    view: DataFrame,
    target: datetime | None,
    reaggregate: Callable[[DataFrame], DataFrame],
    tolerance_hours: float = DEFAULTS.tolerance_hours,
    columns: list[str] | None = None,
) -> DataFrame:
    """Move the rows within the tolerance of `target`, both ends included, onto it and merge them.

    Only those rows are read and aggregated again. The rest of the view, unique by hour and segment already,
    passes through without a shuffle.
    """
    columns = columns or view.columns
    if target is None:
        return view.select(*columns)
    gap = timedelta(hours=tolerance_hours)
    newest = prune(view, _for(view, target - gap), _for(view, target + gap)).select(*columns)
    moved = newest.withColumn("timestamp", like_column(_for(view, target), view, "timestamp"))
    rest = view.where(~_near(view, target, tolerance_hours)).select(*columns)
    return rest.unionByName(reaggregate(moved))


def align(
    batch: DataFrame,
    air: DataFrame,
    tolerance_hours: float = DEFAULTS.tolerance_hours,
    weighted: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Both views with their newest hours merged into one, when those are close enough.

    Reads the global maxima of both views at once, so it is a batch operator; give it stored views.
    """
    target = alignment_hour(*extents(batch, air), tolerance_hours)
    return (
        merge_newest(batch, target, lambda v: reaggregate_traffic(v, weighted), tolerance_hours),
        merge_newest(air, target, lambda v: reaggregate_air(v, weighted), tolerance_hours),
    )


def is_empty(view: DataFrame) -> Column:
    return view.agg(F.max("timestamp")).scalar().isNull()


def join_views(
    batch: DataFrame, air: DataFrame, no_air: Column | None = None, batch_hours: DataFrame | None = None
) -> DataFrame:
    """Full outer join on the hour: many segments to at most one air row.

    Written as left join plus the air-only hours. Unlike a full outer join this lets Spark broadcast
    the air side when its measured size allows, split a hot hour, and drop the second branch when a
    later filter needs traffic. With no air data at all (`no_air`, if known) the counts are 0 instead
    of NULL. `batch_hours`, the hours of `batch` if known, spares reading it again.
    """
    if no_air is None:
        no_air = is_empty(air)
    if batch_hours is None:
        batch_hours = batch.select("timestamp").distinct()
    matched = batch.join(air, "timestamp", "left")
    air_only = air.join(batch_hours, "timestamp", "left_anti")
    combined = matched.unionByName(air_only, allowMissingColumns=True)
    counts = {c: F.when(no_air, F.lit(0).cast("bigint")).otherwise(F.col(c)) for c in _AIR_MEASURES[1:]}
    return combined.withColumns(counts)


def combine(
    batch: DataFrame,
    air: DataFrame,
    as_of: TimeLike | None = None,
    recency_hours: float = DEFAULTS.recency_hours,
    aligned: bool = True,
    tolerance_hours: float = DEFAULTS.tolerance_hours,
    weighted: bool = False,
) -> DataFrame:
    """Combined view of a traffic view and an hourly air view.

    `as_of` turns on the recency filter, `aligned` the merge of the newest hours. Either reads the times of both
    views at once, so pass stored views rather than unfinished aggregations of raw data; date columns of a stored
    view let it skip partitions. What comes back reads the traffic view once, and its newest hours once more.
    """
    if as_of is None and not aligned:
        batch, air = canonical_batch(batch), canonical_air(air)
        return join_views(batch, air, is_empty(air))
    batch_columns, air_columns = canonical_batch(batch).columns, canonical_air(air).columns
    # A row per calendar hour; everything else that must be known of the views follows from it.
    batch_hours = stage(batch.select("timestamp").distinct(), "traffic-hours")
    known = extents(batch_hours, air)
    no_air = F.lit(known[1].last is None)
    if as_of is not None:
        batch, air = recent_views(batch, air, as_of, recency_hours, known)
        batch_hours = recent_views(batch_hours, air, as_of, recency_hours, known)[0]
    target = alignment_hour(*known, tolerance_hours) if aligned else None
    batch = merge_newest(batch, target, lambda v: reaggregate_traffic(v, weighted), tolerance_hours, batch_columns)
    air = merge_newest(air, target, lambda v: reaggregate_air(v, weighted), tolerance_hours, air_columns)
    batch_hours = merge_newest(batch_hours, target, lambda v: v.distinct(), tolerance_hours)
    return join_views(batch, stage(air, "aligned-air"), no_air, batch_hours)


def coverage(combined: DataFrame) -> DataFrame:
    """One row: how many combined rows have traffic, air or both, and whether the ranges fail to meet."""
    has_traffic, has_air = F.col("avg_speed").isNotNull(), F.col("avg_pm25").isNotNull()
    ts = F.col("timestamp")
    counted = combined.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_where(has_traffic).alias("rows_with_traffic"),
        count_where(has_air).alias("rows_with_air"),
        count_where(has_traffic & has_air).alias("rows_with_both"),
        F.min(F.when(has_traffic, ts)).alias("traffic_start"),
        F.max(F.when(has_traffic, ts)).alias("traffic_end"),
        F.min(F.when(has_air, ts)).alias("air_start"),
        F.max(F.when(has_air, ts)).alias("air_end"),
    )
    return counted.withColumn(
        "ranges_do_not_overlap", (F.col("rows_with_both") == 0) & (F.col("rows_with_air") > 0)
    )

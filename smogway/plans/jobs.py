"""Jobs that connect stored tables. Each layer ends in a stored view, which the next one reads."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogway.functions.timestamps import TimeLike, add_partition_columns, parse_timestamp
from smogway.operators.aggregates import hourly_air, hourly_traffic, merge_traffic, traffic_by_segment
from smogway.operators.critical import critical_only, flag_critical, summary_stats
from smogway.operators.integrate import combine, coverage
from smogway.operators.parsing import air_measurements, parse_traffic
from smogway.operators.quality import dedupe_first, distinct_readings, validate_columns
from smogway.schemas import AIR_RAW, BATCH_VIEW, COMBINED, MIGRATIONS, RAW_FILES, READINGS, SPEED_VIEW, names
from smogway.settings import DEFAULTS, Settings
from smogway.sources.files import read_csv_view, read_raw, require_rows
from smogway.sources.staging import stage
from smogway.sources.tables import (
    Layout,
    TableSpec,
    append_table,
    current_folder,
    drop_partitions,
    find_table,
    list_files,
    next_arrival,
    read_first_available,
    read_table,
    replace_partitions,
    upsert_table,
    write_table,
)

log = logging.getLogger(__name__)


def ingest_traffic(raw: DataFrame, layout: Layout, as_of: TimeLike, settings: Settings = DEFAULTS) -> int:
    """Parse raw traffic records and append them to the raw table."""
    readings = parse_traffic(raw, as_of, settings=settings).accepted.select(*names(READINGS))
    return append_table(readings, layout.traffic_raw, settings)


def ingest_air(raw: DataFrame, layout: Layout, settings: Settings = DEFAULTS) -> int:
    """Parse raw air measurements and append them to the raw table, numbered by the order of these calls."""
    arrival = F.lit(next_arrival(raw.sparkSession, layout.air_raw)).cast("long")
    return append_table(air_measurements(raw, settings=settings).withColumn("arrival", arrival), layout.air_raw, settings)


def run_batch(
    spark: SparkSession,
    layout: Layout,
    raw: DataFrame | None = None,
    as_of: TimeLike | None = None,
    refresh: bool = True,
    dedupe: bool = False,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Recompute the hourly traffic view and return it from storage.

    Reads `raw` records, or the raw table without them. With `refresh=False` an existing view is
    returned unchanged. `dedupe` drops readings that were delivered twice.
    """
    if not refresh:
        stored = find_table(spark, layout.batch_view)
        if stored is not None:
            return stored
    if raw is None:
        readings = read_first_available(spark, [layout.traffic_raw], READINGS, required=True)
    elif as_of is None:
        raise ValueError("as_of is needed to stamp raw records without a fetch time")
    else:
        readings = parse_traffic(raw, as_of, settings=settings).accepted
    validate_columns(readings, ["timestamp", "velocity"], "traffic data")
    readings = parse_timestamp(readings, "timestamp", tz=settings.timezone)
    view = hourly_traffic(distinct_readings(readings) if dedupe else readings)
    if write_table(view, layout.batch_view, settings=settings) == 0:
        raise ValueError("no usable traffic readings")
    return read_table(spark, layout.batch_view)


def run_speed(
    spark: SparkSession,
    layout: Layout,
    raw: DataFrame | None = None,
    refresh: bool = True,
    overwrite: bool = True,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Bring the air view up to date and return it from storage.

    From the raw table, the first arrival of a measurement counts. `overwrite` replaces the view, otherwise the new measurements are merged in. No new measurement means
    no change.
    """
    if not refresh:
        stored = find_table(spark, layout.speed_view)
        if stored is not None:
            return stored
    if raw is None:
        stored = read_first_available(spark, [layout.air_raw], AIR_RAW).select(*names(AIR_RAW))
        numbered = stored.withColumn("arrival", F.coalesce("arrival", F.lit(-1)))
        new = dedupe_first(numbered, ["timestamp", "location"], ["arrival"]).select(*names(SPEED_VIEW))
    else:
        new = air_measurements(raw, settings=settings)
    if overwrite:
        write_table(new, layout.speed_view, settings=settings)
    else:
        upsert_table(stage(new, "speed"), layout.speed_view, settings=settings)
    return read_first_available(spark, [layout.speed_view], layout.speed_view.stored_schema)


@dataclass(frozen=True)
class ServingResult:
    """Outputs of the serving job; frames are lazy and read the stored combined view.

    `speed_error` says why the air view could not be brought up to date, if it could not.
    """

    combined: DataFrame
    critical: DataFrame
    stats: DataFrame
    coverage: DataFrame
    speed_error: str | None = None


def run_serving(
    spark: SparkSession,
    layout: Layout,
    as_of: TimeLike | None = None,
    aligned: bool = True,
    batch_candidates: list[TableSpec] | None = None,
    speed_candidates: list[TableSpec] | None = None,
    settings: Settings = DEFAULTS,
) -> ServingResult:
    """Combine both views, flag critical hours and store the results.

    The first candidate with rows is used for each view. A missing traffic view is an error, a missing
    air view is not.
    """
    batch = read_first_available(spark, batch_candidates or [layout.batch_view], BATCH_VIEW, required=True)
    speed = read_first_available(spark, speed_candidates or [layout.speed_view], SPEED_VIEW)
    # One row per hour from here on; staged because alignment and join read it repeatedly.
    air = stage(hourly_air(parse_timestamp(speed)), "hourly-air")
    combined = combine(
        parse_timestamp(batch), air, as_of, settings.recency_hours, aligned, settings.tolerance_hours
    )
    flagged = flag_critical(
        combined,
        settings.pm25_threshold,
        settings.speed_threshold,
        settings.pm25_full_scale,
        settings.speed_full_scale,
    )
    write_table(flagged.select(*names(COMBINED)), layout.combined_view, settings=settings)
    stored = read_table(spark, layout.combined_view).select(*names(COMBINED))
    critical = critical_only(stored)
    write_table(critical, layout.critical_view, settings=settings, allow_empty=True)
    return ServingResult(stored, critical, summary_stats(stored), coverage(stored))


def run_full(
    spark: SparkSession,
    layout: Layout,
    raw_traffic: DataFrame,
    raw_air: DataFrame,
    as_of: TimeLike,
    recent_only: bool = False,
    aligned: bool = True,
    settings: Settings = DEFAULTS,
) -> ServingResult:
    """Batch, speed and serving in turn. A failing speed layer is tolerated; the result carries its error."""
    run_batch(spark, layout, require_rows(raw_traffic, "raw traffic"), as_of, settings=settings)
    speed_error = None
    try:
        run_speed(spark, layout, raw_air, settings=settings)
    except Exception as error:
        log.warning("speed layer failed, serving traffic only", exc_info=True)
        speed_error = _message(error)
    served = run_serving(spark, layout, as_of if recent_only else None, aligned, settings=settings)
    return replace(served, speed_error=speed_error)


def _message(error: Exception) -> str:
    return f"{type(error).__name__}: {str(error).strip()}"[:2000]


# --- incremental batch view --------------------------------------------------------------------


def _day_of_path(name: str):
    return F.regexp_extract("path", rf"{name}=(\d+)", 1).cast("int").alias(name)


def refresh_batch(spark: SparkSession, layout: Layout, settings: Settings = DEFAULTS) -> DataFrame:
    """Bring the hourly traffic view up to date with the files of the raw table, and return it from storage.

    A ledger holds the raw files that the view accounts for. Only days whose files differ from it are read: their hourly
    sums are written anew, and the months of the view that hold those hours are merged from the stored sums. The ledger
    comes last, so a run that breaks off is repeated by the next one, which changes nothing that was right. To the
    driver come the names of days and months, not of files. Delta tables keep files that are no longer theirs and are
    refused; use `run_batch`.
    """
    raw, days = layout.traffic_raw, list(layout.traffic_raw.partition_by)
    if raw.format == "delta":
        raise ValueError("the files of a Delta table do not tell its rows")
    stored = read_table(spark, raw)  # a missing raw table is an error
    files = stage(list_files(spark, current_folder(spark, raw), f".{raw.format}"), "raw-files")
    try:
        ledger = read_table(spark, layout.raw_files)
    except FileNotFoundError:
        ledger = spark.createDataFrame([], RAW_FILES)
    ledger = ledger.select(*names(RAW_FILES))
    changed = files.exceptAll(ledger).unionByName(ledger.exceptAll(files))
    touched = [r.asDict() for r in changed.select(*map(_day_of_path, days)).distinct().collect()]
    if not touched:
        return read_table(spark, layout.batch_view)
    of_days = (F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")).isin(
        [d["year"] * 10_000 + d["month"] * 100 + d["day"] for d in touched]
    )
    readings = parse_timestamp(stored.where(of_days), "timestamp", tz=settings.timezone)
    before = _months(read_partials(spark, layout).where(of_days), settings)
    sums = stage(traffic_by_segment(readings, also=days), "traffic-sums")
    replace_partitions(sums, layout.traffic_sums)
    left = {tuple(r) for r in sums.select(*days).distinct().collect()}
    drop_partitions(spark, layout.traffic_sums, [d for d in touched if tuple(d[p] for p in days) not in left])
    _merge_months(spark, layout, sorted(before | _months(sums, settings)), settings)
    write_table(files, layout.raw_files, settings=settings, allow_empty=True)
    return read_table(spark, layout.batch_view)


def read_partials(spark: SparkSession, layout: Layout) -> DataFrame:
    """The stored hourly sums per raw day; an empty frame before the first."""
    try:
        return read_table(spark, layout.traffic_sums)
    except FileNotFoundError:
        return spark.createDataFrame([], layout.traffic_sums.stored_schema)


def _months(hourly: DataFrame, settings: Settings) -> set[tuple[int, int]]:
    """The months of the view in which some hours lie, which can differ from those of the raw days by an hour's rest."""
    view = add_partition_columns(hourly.select("timestamp"), "timestamp", settings.timezone)
    return {(r.year, r.month) for r in view.select("year", "month").distinct().collect()}


def _merge_months(spark: SparkSession, layout: Layout, months: list[tuple[int, int]], settings: Settings) -> None:
    near = {(y + (m + step - 1) // 12, (m + step - 1) % 12 + 1) for y, m in months for step in (-1, 0, 1)}

    def among(wanted) -> Column:
        return (F.col("year") * 100 + F.col("month")).isin([y * 100 + m for y, m in wanted])

    merged = merge_traffic(read_partials(spark, layout).where(among(near)))
    view = stage(add_partition_columns(merged, "timestamp", settings.timezone).where(among(months)), "months")
    replace_partitions(view, layout.batch_view)
    left = {(r.year, r.month) for r in view.select("year", "month").distinct().collect()}
    drop_partitions(spark, layout.batch_view, [{"year": y, "month": m} for y, m in months if (y, m) not in left])


# --- migration ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Dataset:
    """A migration: `load` returns the rows for `target` and may raise FileNotFoundError."""

    name: str
    load: Callable[[], DataFrame]
    target: TableSpec


def file_datasets(
    spark: SparkSession, paths: dict[str, str], layout: Layout, as_of: TimeLike, raw_files: str = "array", settings: Settings = DEFAULTS
) -> list[Dataset]:
    """The five datasets that older installations keep in files: two of raw JSON, three of CSV views.

    `paths` names the file or folder of traffic_raw, air_raw, batch_view, speed_view and combined_view; `raw_files` is the
    layout of the JSON.
    """

    def raw(name: str) -> DataFrame:
        return read_raw(spark, paths[name], raw_files)

    def view(name: str, target: TableSpec) -> Dataset:
        return Dataset(name, lambda: read_csv_view(spark, paths[name], target.schema), target)

    def traffic() -> DataFrame:
        return parse_traffic(raw("traffic_raw"), as_of, settings=settings).accepted.select(*names(READINGS))

    def air() -> DataFrame:
        return air_measurements(raw("air_raw"), settings=settings).withColumn("arrival", F.lit(-1).cast("long"))

    return [
        Dataset("traffic_raw", traffic, layout.traffic_raw),
        Dataset("air_raw", air, layout.air_raw),
        view("batch_view", layout.batch_view),
        view("speed_view", layout.speed_view),
        view("combined_view", layout.combined_view),
    ]


def migrate_all(
    spark: SparkSession, datasets: list[Dataset], settings: Settings = DEFAULTS, ledger: TableSpec | None = None
) -> DataFrame:
    """Move datasets into tables and report (name, status, rows, error); one failure does not stop the rest.

    Every outcome is appended to `ledger` as soon as it is known. A dataset that it has as migrated is not moved again,
    so a run that broke off, or whose failures were mended, is completed by running it once more.
    """
    done: dict[str, int] = {}
    if ledger is not None:
        stored = find_table(spark, ledger)
        if stored is not None:
            done = {r.name: r.rows for r in stored.where("status = 'migrated'").select("name", "rows").collect()}
    report = []
    for dataset in datasets:
        if dataset.name in done:
            report.append((dataset.name, "migrated", done[dataset.name], None))
            continue
        try:
            rows = write_table(dataset.load(), dataset.target, settings=settings)
            outcome = (dataset.name, "migrated" if rows else "empty", rows, None)
        except FileNotFoundError as error:
            outcome = (dataset.name, "missing", 0, _message(error))
        except Exception as error:
            log.exception("migration of %s failed", dataset.name)
            outcome = (dataset.name, "failed", 0, _message(error))
        report.append(outcome)
        if ledger is not None:
            append_table(spark.createDataFrame([outcome], MIGRATIONS), ledger, settings)
    return spark.createDataFrame(report, MIGRATIONS)

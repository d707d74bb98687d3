"""Stored tables: layout registry, writes, upserts and fallbacks.

An overwrite writes a new version of the table into a folder of its own and commits it with a marker, an empty file that
names the folder. Readers take the folder of the last marker: they see the old rows or the new ones, never a part, and
nothing is written twice. The version before the current one is kept for readers that already started.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogway.functions.timestamps import add_partition_columns
from smogway.operators.quality import dedupe_last, only_row, upsert
from smogway.schemas import (
    AIR_RAW,
    BATCH_VIEW,
    COMBINED,
    DRAINED,
    LIVE_VIEW,
    MIGRATIONS,
    OFFSETS,
    RAW_FILES,
    READINGS,
    REJECTED,
    SPEED_VIEW,
    TRAFFIC_SUMS,
    UNDECODABLE,
)
from smogway.settings import DEFAULTS, Settings
from smogway.sources.files import CSV_OPTIONS, read_csv_view
from smogway.sources.folders import exists, mark, names_in, remove
from smogway.sources.staging import comparable_times, stage

_DATE_PARTS = ("year", "month", "day")
_MISSING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_PATH_DOES_NOT_EXIST", "DELTA_TABLE_NOT_FOUND"}
_VERSIONS, _DATA = "_versions", "_data"
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class TableSpec:
    """Where a table lives and how it is laid out. `format` may be parquet, csv, or delta with its jar.

    A table with `sort_by` is written in ranges of its partitions and these columns, each file sorted, so that readers
    skip the files and row groups outside a range of them.
    """

    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    format: str = "parquet"
    options: dict = field(default_factory=dict, hash=False)
    sort_by: tuple[str, ...] = ()

    @property
    def by_date(self) -> bool:
        return bool(set(self.partition_by) & set(_DATE_PARTS))

    @property
    def stored_schema(self) -> T.StructType:
        """The schema plus year, month and day, which tables partitioned by date carry."""
        if not self.by_date:
            return self.schema
        extra = [T.StructField(p, T.IntegerType()) for p in _DATE_PARTS if p not in self.schema.fieldNames()]
        return T.StructType(self.schema.fields + extra)


@dataclass(frozen=True)
class Layout:
    """The tables below one base path: raw ones and the air view by day, the other views by month."""

    base: str
    format: str = "parquet"

    def _spec(self, name: str, schema: T.StructType, *partition_by: str, sort_by: tuple[str, ...] = ()) -> TableSpec:
        return TableSpec(f"{normalise_path(self.base)}/{name}", schema, partition_by, self.format, sort_by=sort_by)

    @property
    def traffic_raw(self) -> TableSpec:
        return self._spec("traffic/raw", READINGS, *_DATE_PARTS)

    @property
    def air_raw(self) -> TableSpec:
        return self._spec("air_quality/raw", AIR_RAW, *_DATE_PARTS)

    @property
    def batch_view(self) -> TableSpec:
        return self._spec("traffic/batch_view", BATCH_VIEW, "year", "month", sort_by=("timestamp", "road_segment_id"))

    @property
    def speed_view(self) -> TableSpec:
        return self._spec("air_quality/speed_view", SPEED_VIEW, *_DATE_PARTS, sort_by=("timestamp", "location"))

    @property
    def live_view(self) -> TableSpec:
        """The air view as the continuous job keeps it: with the micro-batch in which each row arrived."""
        return self._spec("air_quality/speed_view", LIVE_VIEW, *_DATE_PARTS, sort_by=("timestamp", "location"))

    @property
    def air_rejected(self) -> TableSpec:
        """Records the continuous job could not read, by micro-batch."""
        return self._spec("air_quality/rejected", REJECTED, "batch_id")

    @property
    def traffic_sums(self) -> TableSpec:
        """Hourly sums by raw day, from which the batch view is merged."""
        return self._spec("traffic/sums", TRAFFIC_SUMS, *_DATE_PARTS)

    @property
    def raw_files(self) -> TableSpec:
        """The raw traffic files that the batch view accounts for."""
        return self._spec("traffic/files", RAW_FILES)

    @property
    def migrations(self) -> TableSpec:
        return self._spec("migrations", MIGRATIONS)

    def messages(self, topic: str) -> TableSpec:
        """Messages taken from a topic, by the drain that took them."""
        return self._spec(f"topics/{topic}/messages", DRAINED, "drain")

    def undecodable(self, topic: str) -> TableSpec:
        return self._spec(f"topics/{topic}/undecodable", UNDECODABLE, "drain")

    @property
    def offsets(self) -> TableSpec:
        """How far each consumer group has come in each partition of a topic."""
        return self._spec("topics/offsets", OFFSETS)

    @property
    def combined_view(self) -> TableSpec:
        return self._spec("serving/combined_view", COMBINED, "year", "month", sort_by=("timestamp", "road_segment_id"))

    @property
    def critical_view(self) -> TableSpec:
        return self._spec("serving/critical_periods", COMBINED, sort_by=("timestamp", "road_segment_id"))


def normalise_path(path: str) -> str:
    """s3:// is spelled s3a:// in Hadoop; no trailing slash."""
    return path.replace("s3://", "s3a://", 1).rstrip("/") if path.startswith("s3://") else path.rstrip("/")


def current_folder(spark: SparkSession, spec: TableSpec) -> str:
    """Where the table's committed rows are: the folder of its last version, or its own path if it was never replaced."""
    versions = [] if spec.format == "delta" else names_in(spark, f"{spec.path}/{_VERSIONS}")
    return f"{spec.path}/{_DATA}/{versions[-1]}" if versions else spec.path


def read_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """The stored table, lazily, as it is now. A missing one raises FileNotFoundError."""
    folder = current_folder(spark, spec)
    if spec.format != "delta" and not exists(spark, folder):
        raise FileNotFoundError(spec.path)
    try:
        if spec.format == "csv":
            return read_csv_view(spark, folder, spec.stored_schema, **spec.options)
        reader = spark.read.format(spec.format).options(**spec.options)
        if spec.format != "delta":
            reader = reader.schema(spec.stored_schema)
        return reader.load(folder)
    except AnalysisException as error:
        if error.getCondition() in _MISSING:
            raise FileNotFoundError(spec.path) from error
        raise


def find_table(spark: SparkSession, spec: TableSpec) -> DataFrame | None:
    """The stored table, or None when it does not exist or holds no row."""
    try:
        table = read_table(spark, spec)
    except FileNotFoundError:
        return None
    return None if table.isEmpty() else table


def read_first_available(
    spark: SparkSession, candidates: Sequence[TableSpec], schema: T.StructType, required: bool = False
) -> DataFrame:
    """The first candidate with rows; otherwise an error if `required`, else an empty frame of `schema`."""
    for spec in candidates:
        table = find_table(spark, spec)
        if table is not None:
            return table
    if required:
        raise FileNotFoundError(", ".join(spec.path for spec in candidates))
    return spark.createDataFrame([], schema)


def partitioned(df: DataFrame, spec: TableSpec, settings: Settings = DEFAULTS) -> DataFrame:
    """Add the date columns that a table partitioned by date carries."""
    if not spec.by_date or set(_DATE_PARTS) <= set(df.columns):
        return df
    return add_partition_columns(df, "timestamp", settings.timezone)


def _arranged(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows dealt out and ordered as the table's files hold them."""
    if spec.sort_by:
        order = [*spec.partition_by, *spec.sort_by]
        return df.repartitionByRange(*order).sortWithinPartitions(*order)
    # Rebalancing groups a partition's rows into few files, and splits a partition that is too large
    # for one task instead of funnelling it through one.
    return df.hint("rebalance", *spec.partition_by) if spec.partition_by else df


def _save(df: DataFrame, spec: TableSpec, mode: str, folder: str, **options) -> int:
    """Write the rows and return their number, counted as they are written."""
    counted = Observation()
    rows = _arranged(df, spec).observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.format(spec.format).mode(mode).options(**{**spec.options, **options})
    if spec.format == "csv":
        writer = writer.options(**CSV_OPTIONS)
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    with comparable_times(df.sparkSession):
        writer.save(folder)
    return counted.get["rows"]


def _commit(spark: SparkSession, spec: TableSpec, version: str) -> None:
    """Make `version` the current one, then delete what no reader that starts now or started last time can need."""
    mark(spark, f"{spec.path}/{_VERSIONS}/{version}")
    versions = names_in(spark, f"{spec.path}/{_VERSIONS}")
    for old in versions[:-KEPT_VERSIONS]:
        remove(spark, f"{spec.path}/{_VERSIONS}/{old}")
    for folder in names_in(spark, f"{spec.path}/{_DATA}"):
        if folder not in versions[-KEPT_VERSIONS:]:
            remove(spark, f"{spec.path}/{_DATA}/{folder}")


def write_table(
    df: DataFrame, spec: TableSpec, mode: str = "overwrite", settings: Settings = DEFAULTS, allow_empty: bool = False
) -> int:
    """Write `df` and return its row count; with no rows an existing table stays as it is, unless `allow_empty`.

    An overwrite may read the table it replaces. One writer at a time: of two overwrites the last to commit stays.
    Delta tables, which have versions of their own, are overwritten in place from a staged copy.
    """
    spark = df.sparkSession
    laid_out = partitioned(df, spec, settings)
    if mode != "overwrite":
        target = current_folder(spark, spec) if mode == "append" else spec.path
        return _save(laid_out, spec, "errorifexists" if mode == "error" else mode, target)
    if spec.format == "delta":
        staged = stage(laid_out, "write")
        rows = staged.count()
        if rows or allow_empty:
            _save(staged, spec, mode, spec.path)
        return rows
    last = names_in(spark, f"{spec.path}/{_VERSIONS}")[-1:]
    version = f"{int(last[0].split('-')[0]) + 1 if last else 0:010d}-{uuid.uuid4().hex}"
    folder = f"{spec.path}/{_DATA}/{version}"
    rows = _save(laid_out, spec, "errorifexists", folder)
    if rows or allow_empty:
        _commit(spark, spec, version)
    else:
        remove(spark, folder)
    return rows


def append_table(df: DataFrame, spec: TableSpec, settings: Settings = DEFAULTS) -> int:
    return write_table(df, spec, "append", settings)


def create_table(df: DataFrame, spec: TableSpec, settings: Settings = DEFAULTS) -> int:
    """Write a new table; an existing one is an error."""
    return write_table(df, spec, "errorifexists", settings)


def replace_partitions(df: DataFrame, spec: TableSpec) -> None:
    """Write `df` over the partitions that it has rows in; others stay. Writing the same rows again changes nothing."""
    folder = current_folder(df.sparkSession, spec)
    _save(df.select(*spec.stored_schema.fieldNames()), spec, "overwrite", folder, partitionOverwriteMode="dynamic")


def in_partitions_of(df: DataFrame, other: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The rows of `df` in the date partitions `parts` in which `other` has rows, by a partition filter: no join, no shuffle."""
    weight = dict(zip(_DATE_PARTS, (10_000, 100, 1)))
    ordinal = sum((F.col(p) * weight[p] for p in parts), F.lit(0))
    return df.where(F.array_contains(other.agg(F.collect_set(ordinal)).scalar(), ordinal))


def upsert_table(
    new: DataFrame,
    spec: TableSpec,
    keys: Sequence[str] = ("timestamp", "location"),
    order_by: Sequence[str] = (),
    settings: Settings = DEFAULTS,
    newest_by: str | None = None,
) -> None:
    """Merge `new` into a table partitioned by date parts of its key.

    New rows win, among them the last in `order_by`; without it two new rows of a key are an error. With `newest_by`, a
    stored column, the row with its largest value wins on whichever side it is; NULL counts as smaller than any.
    Only the touched partitions are read and rewritten, and re-running with the same rows changes
    nothing. `new` is read more than once: pass a stored or persisted frame.
    """
    parts = list(spec.partition_by)
    if not parts or not set(parts) <= set(_DATE_PARTS):
        raise ValueError(f"an upsert needs a table partitioned by some of {_DATE_PARTS}, not by {parts}")
    fresh = partitioned(new, spec, settings)
    deduped = dedupe_last(fresh, keys, order_by) if order_by else only_row(fresh, keys)
    columns = spec.stored_schema.fieldNames()
    deduped = deduped.select(*columns)
    try:
        existing = read_table(new.sparkSession, spec).select(*columns)
    except FileNotFoundError:
        replace_partitions(deduped, spec)
        return
    affected = in_partitions_of(existing, fresh, parts)
    if newest_by is None:
        merged = upsert(affected, deduped, keys)
    else:
        both = affected.unionByName(deduped).withColumn("_rank", F.coalesce(newest_by, F.lit(-1)))
        merged = dedupe_last(both, keys, ["_rank"])
    # The rows come from the partitions that are replaced, so they are computed and stored before any is.
    replace_partitions(stage(merged.select(*columns), "upsert"), spec)


def next_arrival(spark: SparkSession, spec: TableSpec) -> int:
    """A number above all that were given out for this table before; one that is never used leaves a gap."""
    folder = f"{spec.path}/_arrivals"
    given = names_in(spark, folder)
    number = int(given[-1]) + 1 if given else 0
    mark(spark, f"{folder}/{number:012d}")
    for old in given:
        remove(spark, f"{folder}/{old}")
    return number


def drop_partitions(spark: SparkSession, spec: TableSpec, partitions: Sequence[dict[str, int]]) -> None:
    """Delete whole partitions, given by the values of all partition columns."""
    folder = current_folder(spark, spec)
    for values in partitions:
        remove(spark, "/".join([folder, *(f"{name}={values[name]}" for name in spec.partition_by)]))


def list_files(spark: SparkSession, folder: str, suffix: str = ".parquet") -> DataFrame:
    """`path, length, modified` of the files below `folder`; nothing of their content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    return reader.load(folder).select("path", "length", F.col("modificationTime").alias("modified"))

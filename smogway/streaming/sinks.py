"""Starting and running the streaming jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from smogway.functions.timestamps import TimeLike
from smogway.operators.quality import dedupe_first
from smogway.settings import DEFAULTS, Settings
from smogway.sources.folders import exists, names_in, remove
from smogway.sources.staging import comparable_times, stage
from smogway.sources.tables import (
    TableSpec,
    in_partitions_of,
    partitioned,
    read_table,
    replace_partitions,
    upsert_table,
)
from smogway.sources.windows import Window, collect_window

POLL = {"processingTime": f"{DEFAULTS.polling_minutes} minutes"}
DRAIN = {"availableNow": True}


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", glob: str | None = None, **options
) -> DataFrame:
    """New files under `path` as a stream."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def append_stream(
    df: DataFrame, spec: TableSpec, checkpoint: str, trigger: dict = DRAIN, settings: Settings = DEFAULTS
) -> StreamingQuery:
    """Append finished rows to a table through the exactly-once file sink."""
    writer = (
        partitioned(df, spec, settings)
        .writeStream.format(spec.format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", spec.path)
        .options(**spec.options)
        .trigger(**trigger)
    )
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    with comparable_times(df.sparkSession):  # the query keeps the settings that it is started with
        return writer.start()


def upsert_stream(
    df: DataFrame,
    spec: TableSpec,
    checkpoint: str,
    keys: Sequence[str] = ("timestamp", "location"),
    order_by: Sequence[str] = (),
    trigger: dict = DRAIN,
    settings: Settings = DEFAULTS,
) -> StreamingQuery:
    """Upsert every micro-batch into a partitioned view. Replaying a batch changes nothing."""

    def merge(batch: DataFrame, _batch_id: int) -> None:
        upsert_table(stage(batch, "micro-batch"), spec, keys, order_by, settings)

    return (
        df.writeStream.foreachBatch(merge)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def partials_stream(
    df: DataFrame, aggregate: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, trigger: dict = DRAIN
) -> StreamingQuery:
    """Store the partial aggregates of every micro-batch in a folder of its own; replaying writes it again.

    Nothing is kept between micro-batches, so no row is too late and open hours are there as well:
    `merge_air` or `merge_traffic` over `read_partials` is the view of all rows so far.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        with comparable_times(batch.sparkSession):
            aggregate(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        df.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _finished(spark: SparkSession, path: str) -> list[str]:
    """Folders of finished micro-batches: those merged up to a batch, and the ones after it.

    Spark leaves the mark of success in a folder last, so one that is being written, or was left unfinished, is not taken.
    """
    done = [name for name in names_in(spark, path) if "=" in name and exists(spark, f"{path}/{name}/_SUCCESS")]
    number = {name: int(name.split("=")[1]) for name in done}
    merged = max((name for name in done if name.startswith("upto=")), key=number.get, default=None)
    after = -1 if merged is None else number[merged]
    return ([merged] if merged else []) + [n for n in done if n.startswith("batch=") and number[n] > after]


def read_partials(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The partial aggregates of all finished micro-batches; none before the first."""
    folders = _finished(spark, path)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{name}" for name in folders])


def compact_partials(
    spark: SparkSession, path: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame]
) -> int:
    """Merge all finished micro-batches into one folder and return how many folders that replaces.

    `merge` adds up partial aggregates to partial aggregates. Run it between batches, e.g. once a day. Readers take either
    the old folders or the new one; the old ones are deleted by the next compaction, when no reader can still be at them.
    """
    merged_before = [n for n in names_in(spark, path) if n.startswith("upto=") and exists(spark, f"{path}/{n}/_SUCCESS")]
    folders = _finished(spark, path)
    numbers = [int(name.split("=")[1]) for name in folders]
    if merged_before:
        covered = max(int(n.split("=")[1]) for n in merged_before)
        for name in names_in(spark, path):
            if "=" in name and name not in folders and int(name.split("=")[1]) <= covered:
                remove(spark, f"{path}/{name}")
    if len(folders) < 2:
        return 0
    with comparable_times(spark):
        merge(read_partials(spark, path, schema)).write.mode("overwrite").parquet(f"{path}/upto={max(numbers)}")
    return len(folders)


def retained_stream(
    df: DataFrame, window: Window, checkpoint: str, as_of: Callable[[], TimeLike], trigger: dict = DRAIN
) -> StreamingQuery:
    """Collect a stream into a table of the last hours before `as_of()`; read it with `read_window`.

    A micro-batch adds files and deletes days that have passed; it rewrites nothing, and replayed it replaces itself.
    """

    def collect(batch: DataFrame, batch_id: int) -> None:
        collect_window(batch, window, batch_id, as_of())

    return (
        df.writeStream.foreachBatch(collect)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def first_arrivals_stream(
    df: DataFrame,
    spec: TableSpec,
    checkpoint: str,
    keys: Sequence[str] = ("timestamp", "location"),
    order_by: Sequence[str] = ("event_id",),
    trigger: dict = DRAIN,
    settings: Settings = DEFAULTS,
) -> StreamingQuery:
    """Append the first arrival of every key: in a micro-batch the first in `order_by`, among batches the earliest.

    No row is too late and no state is kept: what is known is the table itself, partitioned by date parts and `batch_id`,
    of which a micro-batch reads the keys of the dates that it has rows in. Replayed it replaces its own rows.
    """
    parts = [p for p in spec.partition_by if p != "batch_id"]

    def keep_first(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = partitioned(batch, spec, settings).withColumn("batch_id", F.lit(batch_id).cast("long"))
        fresh = stage(dedupe_first(dated, keys, order_by), "first-arrivals")
        try:
            known = read_table(spark, spec).where(F.col("batch_id") < batch_id)
        except FileNotFoundError:
            replace_partitions(fresh, spec)
            return
        known = in_partitions_of(known, fresh, parts)
        same = [F.col(f"new.{k}").eqNullSafe(F.col(f"known.{k}")) for k in keys]
        replace_partitions(fresh.alias("new").join(known.select(*keys).alias("known"), same, "left_anti"), spec)

    return (
        df.writeStream.foreachBatch(keep_first)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_until_done(start: Callable[[], StreamingQuery], restarts: int = 0) -> StreamingQuery:
    """Wait for a bounded query; after a failure start it again from its checkpoint, at most `restarts` times."""
    for attempt in range(restarts + 1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            if attempt == restarts:
                raise
    raise AssertionError("unreachable")


def run_batches(query: StreamingQuery, max_batches: int, poll_seconds: float = 1.0) -> StreamingQuery:
    """Stop a polling query once it has finished `max_batches` micro-batches since it was started."""
    first = None
    while query.isActive:
        seen = [p["batchId"] for p in query.recentProgress]
        if seen and first is None:
            first = seen[0]
        if seen and seen[-1] + 1 - first >= max_batches:
            query.stop()
            break
        query.awaitTermination(poll_seconds)
    return query

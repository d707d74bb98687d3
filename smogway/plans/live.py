"""The continuous air job: every micro-batch of raw records goes into the air view, what cannot be read beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from smogway.operators.parsing import classify_air
from smogway.operators.quality import dedupe_last, validate_columns
from smogway.schemas import LIVE_VIEW, REJECTED, names
from smogway.settings import DEFAULTS, Settings
from smogway.sources.staging import stage
from smogway.sources.tables import Layout, replace_partitions, upsert_table
from smogway.streaming.sinks import POLL, run_until_done

_KEYS = ("timestamp", "location")


def merge_measurements(classified: DataFrame, layout: Layout, batch_id: int, settings: Settings = DEFAULTS) -> None:
    """The newest arrival of each measurement into the view, unless the view has one of a later micro-batch."""
    good = classified.where(F.col("reason").isNull())
    newest = dedupe_last(good.select(*LIVE_VIEW.fieldNames()[:-1], "_order"), _KEYS, ["_order"]).drop("_order")
    arrived = newest.withColumn("arrival", F.lit(batch_id).cast("long"))
    upsert_table(stage(arrived, "arrivals"), layout.live_view, _KEYS, settings=settings, newest_by="arrival")


def quarantine(classified: DataFrame, layout: Layout, batch_id: int) -> None:
    """The records that were rejected, with the reason, in a partition of the micro-batch."""
    bad = classified.where(F.col("reason").isNotNull())
    rejected = bad.select("reason", F.col("_raw").alias("raw"), F.lit(batch_id).cast("long").alias("batch_id"))
    replace_partitions(rejected.select(*names(REJECTED)), layout.air_rejected)


def run_speed_stream(
    raw: DataFrame,
    layout: Layout,
    checkpoint: str,
    trigger: dict = POLL,
    settings: Settings = DEFAULTS,
) -> StreamingQuery:
    """Keep the air view up to date with a stream of raw records (`value`, `ingest_seq`), by default every five minutes.

    The last arrival of a measurement counts, late ones and corrections included; within a micro-batch arrivals are
    ordered by `ingest_seq` and then by their place in the file or partition. A record is parsed once; the view and the
    quarantine are written one after the other, and either write repeated for the same micro-batch changes nothing. So a
    job that is stopped anywhere goes on from its checkpoint without losing or doubling a row. A micro-batch reads and
    writes only the days of the view that it has measurements of.
    """
    validate_columns(raw, ["value", "ingest_seq"], "raw air quality stream")

    def process(batch: DataFrame, batch_id: int) -> None:
        placed = batch.select("value", F.struct("ingest_seq", F.monotonically_increasing_id().alias("row")).alias("_order"))
        classified = stage(classify_air(placed, settings=settings), "classified-air")
        merge_measurements(classified, layout, batch_id, settings)
        quarantine(classified, layout, batch_id)

    return (
        raw.writeStream.foreachBatch(process)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def keep_running(start: Callable[[], StreamingQuery], restarts: int = 1000) -> StreamingQuery:
    """Run a continuous job until it is stopped; a failed round is repeated from the checkpoint, as often as `restarts`."""
    return run_until_done(start, restarts)

"""Message topics. The connector is a parameter, so files can stand in for a broker."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from smogway.functions import json_fields as J
from smogway.sources.files import read_raw

log = logging.getLogger(__name__)

TRAFFIC_TOPIC = "traffic-raw"
AIR_TOPIC = "air-quality-raw"


def _traffic_key(top: Column, _text: Column) -> Column:
    fetched = J.member(top, "_fetched_at")
    return F.when(fetched.isNull(), F.lit("unknown")).otherwise(J.non_empty(J.as_text(fetched)))


def _known(text: Column) -> Column:
    return F.nullif(text, F.lit("unknown"))


def _air_key(top: Column, text: Column) -> Column:
    location = J.member(top, "location")
    named = F.when(J.is_text(location), J.as_text(location)).otherwise(
        J.as_text(J.member(J.members(location), "id"))
    )
    starts = J.members(J.member(J.members(J.member(top, "period")), "datetimeFrom"))
    key = F.coalesce(
        _known(named),
        _known(J.as_text(J.member(starts, "local"))),
        F.get_json_object(text, "$.value"),  # as written: VARIANT would turn 18.0 into 18
        F.lit("unknown"),
    )
    return J.non_empty(key)


def _keyed(raw: DataFrame, text: str, fields: str, quick: Column, key) -> DataFrame:
    """Keys by a typed read of the few members they need; records where that leaves a doubt go through VARIANT.

    A typed read does not tell a missing member from a null, nor text from a number or an object.
    """
    typed = raw.select(text, J.parse_typed(F.col(text), fields).alias("_typed"))
    sure = typed.select(text, F.when(F.col("_typed.damaged").isNull(), quick).alias("_quick"))
    parsed = sure.withColumn("_top", F.when(F.col("_quick").isNull(), J.members(J.parse_lenient(F.col(text)))))
    return parsed.select(F.coalesce("_quick", key(F.col("_top"), F.col(text))).alias("key"), F.col(text).alias("value"))


def _plain_text(name: str) -> Column:
    """A member that can only be a JSON string with something in it."""
    value = F.col(f"_typed.r.{name}")
    return F.when(value.rlike(r"^[A-Za-z0-9]") & ~value.rlike(r"^(-?\d[\d.eE+-]*|true|false|NaN|Infinity)$"), value)


def traffic_records(raw: DataFrame, text: str = "value") -> DataFrame:
    """(key, value) records of raw traffic JSON, keyed by fetch time."""
    return _keyed(raw, text, "_fetched_at: string", _plain_text("_fetched_at"), _traffic_key)


def air_records(raw: DataFrame, text: str = "value") -> DataFrame:
    """(key, value) records of raw air JSON, keyed by location, then time, then value."""
    return _keyed(raw, text, "location: string", _known(_plain_text("location")), _air_key)


def publish(records: DataFrame, topic: str, fmt: str = "kafka", **options) -> None:
    """Send (key, value) records. Needs the connector of `fmt` on the class path."""
    messages = records.select(F.col("key").cast("string"), F.col("value").cast("string"))
    messages.write.format(fmt).options(**options).option("topic", topic).mode("append").save()


def publish_traffic(raw: DataFrame, topic: str = TRAFFIC_TOPIC, fmt: str = "kafka", **options) -> None:
    """Load raw traffic records, e.g. a file, into a topic."""
    publish(traffic_records(raw), topic, fmt, **options)


def publish_air(raw: DataFrame, topic: str = AIR_TOPIC, fmt: str = "kafka", **options) -> None:
    """Load raw air measurements, e.g. a file, into a topic."""
    publish(air_records(raw), topic, fmt, **options)


def _as_raw(messages: DataFrame) -> DataFrame:
    # At-least-once delivery repeats messages; (timestamp, partition, offset) keeps the first one first.
    order = [c for c in ("timestamp", "partition", "offset") if c in messages.columns]
    seq = [F.struct(*order).alias("ingest_seq")] if order else []
    return messages.select(F.col("value").cast("string").alias("value"), *seq)


def load_file(
    spark: SparkSession,
    source: str,
    records: Callable[[DataFrame], DataFrame],
    topic: str,
    layout: str = "array",
    fmt: str = "kafka",
    **options,
) -> int:
    """Send the raw records of a file to a topic, keyed by `records` (`traffic_records` or `air_records`).

    Returns their number. A missing file is an error, an empty one is reported and sends nothing.
    """
    counted = Observation()
    raw = read_raw(spark, source, layout).observe(counted, F.count(F.lit(1)).alias("records"))
    publish(records(raw), topic, fmt, **options)
    sent = counted.get["records"]
    if not sent:
        log.warning("no records in %s", source)
    return sent


def read_topic(
    spark: SparkSession, topic: str, fmt: str = "kafka", max_messages: int | None = None, **options
) -> DataFrame:
    """The whole topic from its first to its last offset, as a batch; the first `max_messages` by offset, if given.

    A batch view must be recomputed from the full log; for new messages only use `drain_topic` or `stream_topic`.
    """
    messages = (
        spark.read.format(fmt)
        .options(subscribe=topic, startingOffsets="earliest", endingOffsets="latest", **options)
        .load()
    )
    if max_messages is not None:
        messages = messages.orderBy("offset", "partition").limit(max_messages)
    return _as_raw(messages)


def stream_topic(
    spark: SparkSession, topic: str, fmt: str = "kafka", max_messages: int | None = None, **options
) -> DataFrame:
    """New messages of the topic; the query's checkpoint plays the part of a consumer group."""
    reader = spark.readStream.format(fmt).options(subscribe=topic, startingOffsets="earliest", **options)
    if max_messages is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_messages)
    return _as_raw(reader.load())

"""Taking new messages of a topic in bounded batches, each message once per consumer group.

How far a group has come in each partition is a table, to which a drain appends after its messages are written. The
messages of a drain lie in a partition with its number, so a drain that broke off is simply written again.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogway.functions import json_fields as J
from smogway.operators.quality import validate_columns
from smogway.schemas import DRAINED, OFFSETS, UNDECODABLE, names
from smogway.sources.staging import stage
from smogway.sources.tables import Layout, append_table, read_table, replace_partitions

_MESSAGE = ("topic", "partition", "offset", "timestamp", "key", "value")


@dataclass(frozen=True)
class Drained:
    """What a drain did: its number (None if there was nothing new), messages written, messages set aside."""

    number: int | None
    messages: int
    undecodable: int


def committed_offsets(spark: SparkSession, layout: Layout, consumer: str, topic: str) -> DataFrame:
    """`partition, next_offset, drain` of a group: a row per partition it has read from."""
    try:
        ledger = read_table(spark, layout.offsets)
    except FileNotFoundError:
        ledger = spark.createDataFrame([], OFFSETS)
    own = ledger.where((F.col("consumer") == consumer) & (F.col("topic") == topic))
    return own.groupBy("partition").agg(F.max("next_offset").alias("next_offset"), F.max("drain").alias("drain"))


def starting_offsets(spark: SparkSession, layout: Layout, consumer: str, topic: str) -> str:
    """The ledger as the `startingOffsets` option of the Kafka reader; `earliest` for a new group.

    Partitions that are new to the group are read from their start by naming all `partitions` of the topic there.
    """
    rows = committed_offsets(spark, layout, consumer, topic).collect()  # a row per partition of the topic
    return json.dumps({topic: {str(r.partition): r.next_offset for r in rows}}) if rows else "earliest"


def _undecodable(value: Column) -> Column:
    """Why a message body is no JSON text, NULL if it is."""
    text = F.try_validate_utf8(value.cast("string"))
    return (
        F.when(value.isNull(), F.lit("no_value"))
        .when(text.isNull(), F.lit("not_utf8"))
        .when(J.parse_lenient(text).isNull(), F.lit("invalid_json"))
    )


def _up_to(pending: DataFrame, max_messages: int) -> DataFrame:
    """The first messages by offset, over all partitions alike: a run of each partition from its start.

    Only offsets are ordered to find the last one wanted; the messages themselves are filtered by it.
    """
    place = F.struct("offset", "partition")
    first = pending.select(place.alias("place")).orderBy("place").limit(max_messages)
    return pending.where(place <= first.agg(F.max("place")).scalar())


def _not_read(committed: list) -> Column:
    """Offsets at which a group has not been yet, as a condition that the reader of a message table can use."""
    at = F.col("partition")
    out = ~at.isin([r["partition"] for r in committed]) if committed else F.lit(True)
    for r in committed:
        out = out | ((at == r["partition"]) & (F.col("offset") >= r["next_offset"]))
    return out


def drain_topic(
    messages: DataFrame, layout: Layout, topic: str, consumer: str, max_messages: int | None = None
) -> Drained:
    """Move the messages that `consumer` has not had yet into `layout.messages(topic)`, at most `max_messages`.

    `messages` are those of a topic as the Kafka reader gives them, or of a stored message table: topic, partition,
    offset, timestamp, key, value. A first drain begins at the start of the topic, a later one where the last ended.
    Bodies that are no JSON in UTF-8 go to `layout.undecodable(topic)` as they are and count as read. Which messages a
    drain takes is staged before anything is written, and the ledger is appended to last: a drain that breaks off
    before that is repeated whole by the next, which overwrites its partition. One drain of a group at a time.
    """
    validate_columns(messages, _MESSAGE, "messages")
    spark = messages.sparkSession
    read = committed_offsets(spark, layout, consumer, topic).collect()  # a row per partition of the topic
    number = max((r["drain"] for r in read), default=0) + 1
    pending = messages.where((F.col("topic") == topic) & _not_read(read)).select(*_MESSAGE)
    if max_messages is not None:
        pending = _up_to(pending, max_messages)
    taken = stage(pending.withColumn("reason", _undecodable(F.col("value"))), "drained")
    ends = taken.groupBy("partition").agg(
        (F.max("offset") + 1).alias("next_offset"), F.count(F.lit(1)).alias("n"), F.count("reason").alias("bad")
    ).collect()
    if not ends:
        return Drained(None, 0, 0)
    labelled = taken.withColumnRenamed("timestamp", "sent").withColumns(
        {"key": F.col("key").cast("string"), "drain": F.lit(number).cast("long")}
    )
    good = labelled.where(F.col("reason").isNull()).withColumn("value", F.col("value").cast("string"))
    replace_partitions(good.select(*names(DRAINED)), layout.messages(topic))
    replace_partitions(labelled.where(F.col("reason").isNotNull()).select(*names(UNDECODABLE)), layout.undecodable(topic))
    commit(spark, layout, [(consumer, topic, r.partition, r.next_offset, number) for r in ends])
    n, bad = sum(r.n for r in ends), sum(r.bad for r in ends)
    return Drained(number, n - bad, bad)


def commit(spark: SparkSession, layout: Layout, rows: list[tuple]) -> None:
    """Record how far a group has come: one file, so all partitions or none."""
    append_table(spark.createDataFrame(rows, OFFSETS).coalesce(1), layout.offsets)


def drained_messages(spark: SparkSession, layout: Layout, topic: str, drain: int | None = None) -> DataFrame:
    """Raw records (`value`, `ingest_seq`, `key`) that drains of a topic have written, or one of them."""
    stored = read_table(spark, layout.messages(topic))
    if drain is not None:
        stored = stored.where(F.col("drain") == drain)
    return stored.select("value", F.struct("sent", "partition", "offset").alias("ingest_seq"), "key", "drain")

"""Bounded drains of a stored message table."""

import json

import pytest

from smogway.sources import drain
from smogway.sources.tables import Layout, read_table

SCHEMA = "topic string, partition int, offset long, timestamp timestamp, key binary, value binary"


def messages(spark, *places, topic="t"):
    """(partition, offset[, body]) each."""
    rows = [(topic, p, o, None, b"k", json.dumps({"at": [p, o]}).encode() if not body else body[0]) for p, o, *body in places]
    return spark.createDataFrame(rows, SCHEMA)


def taken(spark, layout):
    return sorted((r.drain, r.partition, r.offset) for r in read_table(spark, layout.messages("t")).collect())


def test_a_second_drain_takes_only_what_is_new(spark, tmp_path):
    layout = Layout(str(tmp_path))
    log = messages(spark, (0, 0), (0, 1), (1, 5))
    assert drain.starting_offsets(spark, layout, "g", "t") == "earliest"
    assert drain.drain_topic(log, layout, "t", "g") == drain.Drained(1, 3, 0)
    assert drain.drain_topic(log, layout, "t", "g") == drain.Drained(None, 0, 0)
    grown = log.unionByName(messages(spark, (0, 2), (2, 0))).unionByName(messages(spark, (0, 9), topic="other"))
    assert drain.drain_topic(grown, layout, "t", "g") == drain.Drained(2, 2, 0)
    assert taken(spark, layout) == [(1, 0, 0), (1, 0, 1), (1, 1, 5), (2, 0, 2), (2, 2, 0)]
    assert json.loads(drain.starting_offsets(spark, layout, "g", "t")) == {"t": {"0": 3, "1": 6, "2": 1}}
    assert drain.drained_messages(spark, layout, "t", 2).count() == 2
    assert drain.drain_topic(grown, layout, "t", "another group").messages == 5


def test_a_bounded_drain_takes_offsets_in_order(spark, tmp_path):
    layout = Layout(str(tmp_path))
    log = messages(spark, *((p, o) for p in range(3) for o in range(4))).repartition(4)
    sizes = [drain.drain_topic(log, layout, "t", "g", 5).messages for _ in range(4)]
    assert sizes == [5, 5, 2, 0]
    assert taken(spark, layout)[:5] == [(1, 0, 0), (1, 0, 1), (1, 1, 0), (1, 1, 1), (1, 2, 0)]
    assert len({r[1:] for r in taken(spark, layout)}) == 12


def test_undecodable_bodies_are_set_aside_and_count_as_read(spark, tmp_path):
    layout = Layout(str(tmp_path))
    log = messages(spark, (0, 0), (0, 1, b"\xff\xfe"), (0, 2, b"{"), (0, 3, b'{"a": NaN}')).unionByName(
        spark.createDataFrame([("t", 0, 4, None, None, None)], SCHEMA))
    assert drain.drain_topic(log, layout, "t", "g") == drain.Drained(1, 2, 3)
    bad = sorted((r.offset, r.reason, r.value) for r in read_table(spark, layout.undecodable("t")).collect())
    assert bad == [(1, "not_utf8", bytearray(b"\xff\xfe")), (2, "invalid_json", bytearray(b"{")), (4, "no_value", None)]
    assert drain.drain_topic(log, layout, "t", "g").number is None


def test_a_drain_that_breaks_off_is_repeated(spark, tmp_path, monkeypatch):
    layout, log = Layout(str(tmp_path)), messages(spark, (0, 0), (0, 1, b"\xff"), (1, 0))
    real = drain.commit

    def lost(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(drain, "commit", lost)
    with pytest.raises(RuntimeError):
        drain.drain_topic(log, layout, "t", "g")
    monkeypatch.setattr(drain, "commit", real)
    assert drain.drain_topic(log, layout, "t", "g") == drain.Drained(1, 2, 1)
    assert taken(spark, layout) == [(1, 0, 0), (1, 1, 0)]
    assert read_table(spark, layout.undecodable("t")).count() == 1

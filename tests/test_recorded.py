"""A recorded topic: Kafka's columns and offsets, from files."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from panelkit.sources import FEEDS
from panelkit.sources.recorded import SCHEMA, RecordedReader, record_segment
from panelkit.sources.storage import arrow_address
from panelkit.streaming import append_stream, ingest_feed, read_stream
from tests.conftest import rows

MESSAGES = "key STRING, value STRING, timestamp TIMESTAMP, partition INT"
T = [datetime(2024, 1, 1, i) for i in range(9)]


@pytest.fixture
def topic(spark, frame, tmp_path):
    """A topic that messages are added to, and what a stream of it has taken in so far."""
    folder, out = str(tmp_path / "topics"), str(tmp_path / "out")

    def add(*messages, **options):
        return record_segment(frame(MESSAGES, *messages), folder, "t", **options)

    def take(**options):
        stream = read_stream(spark, "recorded", {"path": folder, "topic": "t", **options})
        append_stream(stream, out, str(tmp_path / "checkpoint")).awaitTermination()
        found = spark.read.parquet(out) if list((tmp_path / "out").glob("*/*.parquet")) else None
        text = lambda c: F.col(c).cast("string").alias(c)
        return rows(found.select("partition", "offset", text("key"), text("value")), "partition", "offset") if found else []

    return add, take, folder


def test_columns_are_those_of_kafka(spark, topic):
    add, _, folder = topic
    add(("k", "v", T[0], 1))
    stream = read_stream(spark, "recorded", {"path": folder, "topic": "t"})
    assert stream.schema == spark.createDataFrame([], SCHEMA).schema


def test_offsets_resume_where_they_stopped(topic):
    add, take, _ = topic
    assert add(("a", "1", T[0], 0), ("b", "2", T[1], 0), ("c", "3", T[0], 2)) == {0: 2, 2: 1}
    first = [(0, 0, "a", "1"), (0, 1, "b", "2"), (2, 0, "c", "3")]
    assert take() == first and take() == first
    # a tombstone, a partition that is new, and one without anything new
    assert add(("a", None, T[2], 0), ("d", "4", T[2], 1)) == {0: 3, 1: 1, 2: 1}
    add(("e", "5", T[3], 2))
    assert take() == sorted([*first, (0, 2, "a", None), (1, 0, "d", "4"), (2, 1, "e", "5")])


def test_an_empty_topic_and_an_empty_segment(topic):
    add, take, _ = topic
    assert take() == []
    add()
    assert take() == []
    add(("a", "1", T[0], 0))
    assert take() == [(0, 0, "a", "1")]


def test_only_new_messages_from_the_latest_offset_on(topic):
    add, take, _ = topic
    add(("a", "1", T[0], 0))
    assert take(startingOffsets="latest") == []
    add(("b", "2", T[1], 0))
    assert take(startingOffsets="latest") == [(0, 1, "b", "2")]


def test_stretches_name_the_segments_they_need(topic):
    add, _, folder = topic
    for i in range(4):
        add(("a", str(i), T[i], 0), ("a", f"{i}+", T[i], 0), *([("b", "x", T[i], 1)] if i == 2 else []))
    reader = RecordedReader({"path": folder, "topic": "t"})
    assert reader.latestOffset() == {"0": 8, "1": 1}
    (one, two) = reader.partitions({"0": 3}, {"0": 6, "1": 1})
    assert ([int(s) for s in one.segments], [int(s) for s in two.segments]) == ([1, 2], [2])
    values = [v for batch in reader.read(one) for v in batch.column("value").to_pylist()]
    assert values == [b"1+", b"2", b"2+"]
    assert reader.partitions({"0": 8, "1": 1}, {"0": 8, "1": 1}) == []


def test_a_second_recorder_of_the_same_segment_fails(topic, monkeypatch):
    from panelkit.sources import recorded

    add, _, _ = topic
    add(("a", "1", T[0], 0))
    monkeypatch.setattr(recorded, "create_text", lambda *a: False)
    with pytest.raises(RuntimeError, match="another recorder"):
        add(("b", "2", T[0], 0))


def test_a_feed_from_a_recorded_topic(store, spark, tmp_path):
    feed, folder = FEEDS["worldbank_gdp"], str(tmp_path / "topics")
    texts = [json.dumps({"countryiso3code": c, "country": {"value": c}, "date": "2020", "value": 1.5}) for c in ("AFG", "BEN")]
    messages = spark.createDataFrame([("a", texts[0]), ("b", texts[1]), ("c", None), ("d", "{bad")], "key STRING, value STRING")
    record_segment(messages, folder, feed.topic, partitions=2)
    for _ in range(2):
        ingest_feed(store, feed, "recorded", {"path": folder})
    bronze = store.read("bronze", feed.table)
    assert bronze.count() == 4 and rows(bronze.filter("bad_record IS NOT NULL").select("bad_record")) == [("{bad",)]


def test_addresses_of_buckets():
    for address, wanted in (("s3a://b/t", "s3://b/t"), ("s3n://b/t", "s3://b/t"), ("hdfs://n/t", "hdfs://n/t"), ("/t", "/t")):
        assert arrow_address(address) == wanted

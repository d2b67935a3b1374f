from __future__ import annotations

import json

import pytest
from sample import messages, text

from gaugeflow import schemas as S
from gaugeflow.plans import event_records as er
from gaugeflow.sources import documents
from gaugeflow.sources.messages import (
    Subscription,
    bounded_files,
    message_scan,
    message_stream,
)
from gaugeflow.streaming import runs, sinks


def test_kafka_options():
    whole = Subscription(("a", "b"))
    assert whole.kafka_options(streaming=True) == {
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "maxRecordsPerPartition": "1000000",
        "maxOffsetsPerTrigger": "1000000000",
    }
    part = Subscription(("a",), start={"a": {0: 5, 1: -2}}, end={"a": {0: 9, 1: -1}})
    options = part.kafka_options(streaming=False)
    assert json.loads(options["startingOffsets"]) == {"a": {"0": 5, "1": -2}}
    assert json.loads(options["endingOffsets"]) == {"a": {"0": 9, "1": -1}}
    assert "endingOffsets" not in part.kafka_options(streaming=True)
    assert "maxOffsetsPerTrigger" not in options


def test_file_streams_are_bounded_once():
    assert bounded_files({}) == {"maxBytesPerTrigger": str(1 << 40)}
    assert bounded_files({"maxFilesPerTrigger": "1"}) == {"maxFilesPerTrigger": "1"}


def test_impossible_subscriptions(spark, tmp_path):
    with pytest.raises(ValueError):
        Subscription(())
    with pytest.raises(ValueError):
        Subscription(("a",), end="earliest")
    with pytest.raises(ValueError):
        message_stream(spark, Subscription(("a",), start="latest"), "parquet", str(tmp_path))


def _table(spark, tmp_path):
    path = str(tmp_path / "envelopes")
    for topic in ("a", "b", "c"):
        messages(spark, ["{}"] * 10, topic).write.mode("append").parquet(path)
    return path


@pytest.mark.parametrize(
    "subscription, wanted",
    [
        (Subscription(("a", "b")), {("a", i) for i in range(10)} | {("b", i) for i in range(10)}),
        (Subscription(("a",), start="latest"), set()),
        (Subscription(("a",), start={"a": {0: 7}}), {("a", 7), ("a", 8), ("a", 9)}),
        (Subscription(("a",), start={"a": {0: -1}}), set()),
        (Subscription(("a",), start={"a": {0: -2}}, end={"a": {0: 2}}), {("a", 0), ("a", 1)}),
        (Subscription(("b",), start={"a": {0: 7}}, end={"b": {0: 1}}), {("b", 0)}),
        (Subscription(("none",)), set()),
    ],
)
def test_positions(spark, tmp_path, subscription, wanted):
    rows = message_scan(spark, subscription, "parquet", _table(spark, tmp_path)).collect()
    assert {(r.topic, r.offset) for r in rows} == wanted
    assert len(rows) == len(wanted)


def test_positions_reach_the_file_scan(spark, tmp_path, plan_of):
    subscription = Subscription(("a",), start={"a": {0: 7}})
    plan = plan_of(message_scan(spark, subscription, "parquet", _table(spark, tmp_path)))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "topic,a" in pushed and "offset,7" in pushed


def test_stream_and_scan_of_a_table_agree(spark, tmp_path):
    path = _table(spark, tmp_path)
    subscription = Subscription(("a", "c"), start={"a": {0: 4}})
    stream = message_stream(spark, subscription, "parquet", path, maxFilesPerTrigger="1")
    writer = sinks.to_table(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query = runs.run_available(writer)
    assert len(query.recentProgress) >= 3
    got = spark.read.schema(S.ENVELOPE).parquet(str(tmp_path / "out"))
    wanted = message_scan(spark, subscription, "parquet", path)
    assert got.count() == 16
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0


def test_collections_with_and_without_schema(spark, tmp_path):
    path = str(tmp_path / "documents")
    spark.createDataFrame([(text(),), (text(cat0="worn"),)], "value string").write.text(path)
    declared = documents.scan_collection(spark, "json", path, S.NAMED_RECORD)
    inferred = documents.scan_collection(spark, "json", path)
    fields = ["Result", "Categories.cat0", "Sensors.sensor9"]
    wanted = [(1, "sound", 9.0), (1, "worn", 9.0)]
    for collection in (declared, inferred):
        rows = collection.select(*fields).orderBy("cat0").collect()
        assert [tuple(r) for r in rows] == wanted


def test_event_stream_is_bounded(spark, sf_dir, config):
    stream = er.event_messages(er.event_stream(spark, sf_dir), config)
    assert stream.isStreaming and stream.columns == S.ENVELOPE.names

"""Topic tables: publishing, places, streams over them, and how far those are."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gaugeflow import session
from gaugeflow.sources import topic_stream
from gaugeflow.sources.messages import Subscription, message_stream
from gaugeflow.streaming import progress, runs, sinks, topics


def _rows(spark, n, topic="a", **columns):
    rows = spark.range(n).select(F.lit(topic).alias("topic"), F.col("id").cast("string").alias("key"))
    return rows.withColumns({"value": F.concat(F.lit("v"), F.col("key")), **columns})


@pytest.fixture
def table(tmp_path):
    return topics.TopicTable(str(tmp_path / "topic"), partitions=3)


def _all(spark, table, *names):
    return table.scan(spark, Subscription(names or ("a", "b"))).collect()


def _gapless(rows):
    seen = {}
    for r in rows:
        seen.setdefault((r.topic, r.partition), []).append(r.offset)
    return all(sorted(places) == list(range(len(places))) for places in seen.values())


def test_places_go_on_without_gaps(spark, table):
    assert table.last_entry(spark) == -1 and _all(spark, table) == []
    one = table.publish(_rows(spark, 100).unionByName(_rows(spark, 50, "b")).repartition(7))
    two = table.publish(_rows(spark, 30).withColumn("key", F.lit(None).cast("string")))
    rows = _all(spark, table)
    assert (one.n_messages, two.n_messages, len(rows)) == (150, 30, 180)
    assert _gapless(rows)
    assert {r.partition for r in rows} <= {0, 1, 2}
    assert {(r.topic, r.partition): r.next for r in table.places(spark).collect()} == {
        place: n for place, n in Counter((r.topic, r.partition) for r in rows).items()
    }


def test_same_key_same_partition_in_order(spark, table):
    for _ in range(2):
        table.publish(_rows(spark, 60, key=F.lit("k")).coalesce(1))
    rows = sorted(_all(spark, table), key=lambda r: r.offset)
    assert len({r.partition for r in rows}) == 1
    assert [bytes(r.value) for r in rows] == [bytes(r.value) for r in rows[:60]] * 2


def test_a_batch_is_published_once(spark, table):
    rows = _rows(spark, 20)
    assert table.publish(rows, "w", 0).n_messages == 20
    assert table.publish(rows, "w", 0) is None
    assert table.publish(rows, "other", 0).n_messages == 20
    assert table.publish(rows, "w", 0) is None
    assert table.publish(rows, "w", 1).n_messages == 20
    assert table.publish(rows.limit(0), "w", 2) is None
    assert len(_all(spark, table)) == 60 and _gapless(_all(spark, table))


def test_a_batch_without_its_entry_is_not_there(spark, table, monkeypatch):
    table.publish(_rows(spark, 10), "w", 0)
    with monkeypatch.context() as broken:
        broken.setattr(session, "renamed", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.publish(_rows(spark, 10, "b"), "w", 1)
    assert {r.topic for r in _all(spark, table)} == {"a"}
    assert table.publish(_rows(spark, 10, "b"), "w", 1).n_messages == 10
    rows = _all(spark, table)
    assert Counter(r.topic for r in rows) == {"a": 10, "b": 10} and _gapless(rows)


def test_messages_need_a_topic(spark, table):
    with pytest.raises(ValueError):
        table.publish(_rows(spark, 3, key=F.lit("x")).withColumn("topic", F.lit(None).cast("string")))
    assert table.last_entry(spark) == -1


def test_report_of_one_publish(spark, table):
    table.publish(_rows(spark, 9, partition=F.lit(0)))
    delivery = table.publish(_rows(spark, 4, partition=F.lit(0)))
    lines = [r.line for r in delivery.report(spark).orderBy("offset").collect()]
    assert lines == [f"topic=a  partition=0  offset={9 + i}: \nv{i}" for i in range(4)]
    assert [tuple(r) for r in delivery.ranges(spark).collect()] == [("a", 0, 9, 13, 4)]


def test_one_partition_fills_several_files(spark, table):
    """A topic partition that holds everything is not gathered into one task."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.publish(_rows(spark, 5000, partition=F.lit(0)).repartition(4))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = table.ledger(spark).where("kind = 'file'").orderBy("first").collect()
    assert len(files) == 8 and max(f.next - f.first for f in files) < 2000
    assert [f.first for f in files[1:]] == [f.next for f in files[:-1]]


def test_publishing_reads_no_old_messages(spark, table):
    table.publish(_rows(spark, 10), "w", 0)
    session.discard(spark, f"{table.path}/messages")
    assert table.publish(_rows(spark, 5), "w", 1).n_messages == 5
    assert {r.next for r in table.places(spark).collect()} and sum(r.next for r in table.places(spark).collect()) == 15


def _stream(spark, table, tmp_path, start="earliest", most=None, name="q"):
    bound = {"maxOffsetsPerTrigger": str(most), "planned": str(tmp_path / f"{name}.json")} if most else {}
    return message_stream(
        spark, Subscription(("a", "b"), start=start), topic_stream.NAME, table.path, recordsPerTask="7", **bound
    )


def _run(stream, tmp_path, name="q"):
    return runs.run_caught_up(sinks.to_table(stream, str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-c")))


def _sizes(query):
    return [p.numInputRows for p in query.recentProgress if p.numInputRows]


def test_stream_reads_all_once_in_bounded_batches(spark, table, tmp_path):
    table.publish(_rows(spark, 100).unionByName(_rows(spark, 20, "b")).unionByName(_rows(spark, 9, "c")))
    stream = _stream(spark, table, tmp_path, most=50)
    assert _sizes(_run(stream, tmp_path)) == [50, 50, 20]
    table.publish(_rows(spark, 60))
    # A restarted query keeps the bound, and reads on from where it was.
    assert _sizes(_run(_stream(spark, table, tmp_path, most=50), tmp_path)) == [50, 10]
    assert _sizes(_run(_stream(spark, table, tmp_path, most=50), tmp_path)) == []
    got = spark.read.parquet(str(tmp_path / "q-out"))
    wanted = table.scan(spark, Subscription(("a", "b")))
    assert got.count() == 180
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0


@pytest.mark.parametrize(
    "start, wanted",
    [
        ("latest", {("a", i) for i in range(10, 15)}),
        ({"a": {0: 7}}, {("a", i) for i in range(7, 15)}),
        ({"a": {0: -1}}, {("a", i) for i in range(10, 15)}),
        ({"a": {0: -2}}, {("a", i) for i in range(15)}),
        ({"a": {0: 12}}, {("a", i) for i in range(12, 15)}),
    ],
)
def test_start_positions_of_a_stream(spark, table, tmp_path, start, wanted):
    table.publish(_rows(spark, 10, partition=F.lit(0)))
    stream = _stream(spark, table, tmp_path, start)
    _run(stream, tmp_path)
    table.publish(_rows(spark, 5, partition=F.lit(0)))
    _run(stream, tmp_path)
    rows = spark.read.parquet(str(tmp_path / "q-out")).collect()
    assert {(r.topic, r.offset) for r in rows} == wanted and len(rows) == len(wanted)


def test_only_committed_batches_are_streamed(spark, table, tmp_path, monkeypatch):
    table.publish(_rows(spark, 10))
    with monkeypatch.context() as broken:
        broken.setattr(session, "renamed", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.publish(_rows(spark, 10))
    assert sum(_sizes(_run(_stream(spark, table, tmp_path), tmp_path))) == 10


def test_a_bound_needs_a_place_for_the_plan(spark, table, tmp_path):
    with pytest.raises(ValueError):
        topic_stream.TopicStreamReader({"path": table.path, "topics": "[]", "maxoffsetspertrigger": "5"})


def test_dealt_shares():
    latest = {"a": {"0": 100, "1": 10}, "b": {"0": 1}}
    end = topic_stream.dealt({}, latest, 37)
    assert sum(n for ps in end.values() for n in ps.values()) == 37
    assert end["a"]["0"] >= 30
    assert topic_stream.dealt(end, latest, None) == latest
    assert topic_stream.dealt(latest, latest, 5) == latest
    ahead = {"a": {"0": 500}, "b": {}}
    assert topic_stream.dealt(ahead, latest, 1000)["a"]["0"] == 500


def test_places_reached_and_messages_behind(spark, table, tmp_path):
    place = str(tmp_path / "places")
    assert progress.recorded(spark, place).count() == 0
    table.publish(_rows(spark, 10, partition=F.lit(0)))
    for _ in range(2):
        query = _run(_stream(spark, table, tmp_path), tmp_path)
        progress.record(query, spark, place)
        progress.record(query, spark, place)
        table.publish(_rows(spark, 4, partition=F.lit(0)).unionByName(_rows(spark, 3, partition=F.lit(1))))
    rows = progress.recorded(spark, place).orderBy("batch").collect()
    assert [(r.topic, r.partition, r.start, r.committed) for r in rows if r.partition == 0] == [
        ("a", 0, 0, 10), ("a", 0, 10, 14),
    ]
    reached = progress.committed(spark, place)
    late = progress.behind(reached, table.places(spark)).orderBy("partition").collect()
    assert [(r.partition, r.committed, r.behind) for r in late] == [(0, 14, 4), (1, 3, 3)]


def test_offsets_of_a_broker_are_read_alike():
    assert progress._offsets(json.loads('{"t": {"0": 5}}')) == {("t", 0): 5}
    assert progress._offsets({"logOffset": 3}) == {}
    assert progress._offsets(None) == {}


def test_stream_publisher_after_a_lost_driver(spark, table, tmp_path):
    """The batch is published, the driver ends before Spark notes it, and the query starts again."""
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    _rows(spark, 40).write.parquet(source)
    stream = spark.readStream.schema("topic string, key string, value string").parquet(source)

    def fail(batch, batch_id):
        table.publish(batch, "stream", batch_id)
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        runs.run_available(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(fail))
    _rows(spark, 25, "b").write.mode("append").parquet(source)
    runs.run_available(topics.publish_stream(stream, table, checkpoint))
    rows = _all(spark, table)
    assert Counter(r.topic for r in rows) == {"a": 40, "b": 25} and _gapless(rows)


def test_a_file_is_cut_into_row_groups(spark, tmp_path):
    """A reader of some places opens part of a file, however many messages the file holds."""
    import pyarrow.parquet as pq

    noise = F.concat(*[F.sha2(F.concat("id", F.lit(f" {k}")), 512) for k in range(6)])
    rows = spark.range(60_000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit("k").alias("key"), noise.alias("value"))
    table = topics.TopicTable(f"{tmp_path}/topic")
    table.publish(rows.coalesce(1))
    groups = []
    for file in tmp_path.glob("topic/messages/entry=*/*.parquet"):
        held = pq.ParquetFile(file).metadata
        groups += [held.row_group(k).num_rows for k in range(held.num_row_groups)]
    assert sum(groups) == 60_000 and max(groups) <= 20_000
    assert table.scan(spark, Subscription(("t",))).select("offset").distinct().count() == 60_000

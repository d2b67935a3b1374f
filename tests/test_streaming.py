from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sample import messages, text

from gaugeflow import schemas as S
from gaugeflow.operators import decode, features
from gaugeflow.operators import model as models
from gaugeflow.plans import catalog, jobs
from gaugeflow.plans.fixed_model import FIXED
from gaugeflow.sources.messages import TOPIC_TABLE, Subscription, message_scan, message_stream
from gaugeflow.streaming import manifests, runs, sinks

TOPIC = Subscription(("epd01",))


@pytest.fixture
def place(tmp_path):
    class Place:
        source = str(tmp_path / "source")
        out = str(tmp_path / "out")
        other = str(tmp_path / "other")
        checkpoint = str(tmp_path / "checkpoint")

    return Place


def _arrive(spark, place, values, first_offset=0):
    messages(spark, values, first_offset=first_offset).write.mode("append").parquet(place.source)


def _stream(spark, place, **options):
    return message_stream(spark, TOPIC, "parquet", place.source, **options)


def _archived(spark, sink):
    return sorted((r.offset, r.batch) for r in sink.read(spark, catalog.ARCHIVED).collect())


def test_a_restart_adds_only_what_is_new(spark, place):
    sink = sinks.TableSink(place.out)
    _arrive(spark, place, [text()] * 3)
    for _ in range(2):
        runs.run_available(jobs.archive(_stream(spark, place), sink, place.checkpoint))
    assert _archived(spark, sink) == [(0, 0), (1, 0), (2, 0)]
    _arrive(spark, place, [text()] * 2, first_offset=3)
    runs.run_available(jobs.archive(_stream(spark, place), sink, place.checkpoint))
    assert _archived(spark, sink) == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1)]


def test_a_batch_written_again_replaces_itself(spark, place):
    sink = sinks.TableSink(place.out, partition_by=("status",))
    for values in ([text(), "x", "y"], [text(), "x", "y"]):
        sink.write(decode.archive_rows(messages(spark, values)), 0)
    sink.write(decode.archive_rows(messages(spark, [text()], first_offset=3)), 1)
    assert _archived(spark, sink) == [(0, 0), (1, 0), (2, 0), (3, 1)]


def test_a_batch_is_replaced_whole_whatever_the_session_says(spark, place):
    sink = sinks.TableSink(place.out, partition_by=("status",))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sink.write(decode.archive_rows(messages(spark, [text(), "x"])), 0)
        sink.write(decode.archive_rows(messages(spark, [text()])), 0)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert _archived(spark, sink) == [(0, 0)]


def test_an_archive_needs_no_shuffle(spark, place, plan_of):
    _arrive(spark, place, [text()])
    stored = spark.read.schema(S.ENVELOPE).parquet(place.source)
    plan = plan_of(decode.archive_rows(stored))
    for operator in ("Exchange", "Python", "Sort", "UDF"):
        assert operator not in plan


def test_a_failed_batch_is_taken_up_again(spark, place):
    _arrive(spark, place, [text()] * 4)
    sink = sinks.TableSink(place.out)

    class Failing:
        def write(self, batch, batch_id):
            sink.write(batch.limit(1), batch_id)
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        runs.run_available(jobs.archive(_stream(spark, place), Failing(), place.checkpoint))
    runs.run_available(jobs.archive(_stream(spark, place), sink, place.checkpoint))
    assert _archived(spark, sink) == [(0, 0), (1, 0), (2, 0), (3, 0)]


def test_both_branches_get_every_row(spark, place):
    values = [text(), "x", None]
    _arrive(spark, place, values)
    _arrive(spark, place, values, first_offset=3)
    console, store = sinks.TableSink(place.out), sinks.TableSink(place.other)
    stream = _stream(spark, place, maxFilesPerTrigger="1")
    runs.run_available(jobs.consume(stream, console, store, place.checkpoint))
    assert [o for o, _ in _archived(spark, store)] == list(range(6))
    lines = spark.read.parquet(place.out).select("line").collect()
    assert sorted(r.line.split(", key")[0] for r in lines) == [
        f"Consumer: topic = epd01, partition = 0, offset = {i}" for i in range(6)
    ]


def test_nothing_stays_cached_after_a_fan_out(spark, place):
    _arrive(spark, place, [text()])
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    console, store = sinks.TableSink(place.out), sinks.TableSink(place.other)
    runs.run_available(jobs.consume(_stream(spark, place), console, store, place.checkpoint))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_stream_and_table_are_scored_alike(spark, place, config):
    values = [text(), text(cat0="worn", sensor9=-5.0), "x", None, text(cat0="?"), text(Result=0)]
    _arrive(spark, place, values)
    runs.run_available(
        jobs.score(_stream(spark, place), FIXED, config, place.out, place.checkpoint)
    )
    wanted = jobs.scored_messages(messages(spark, values), FIXED, config)
    got = spark.read.schema(wanted.schema).parquet(place.out).select(*wanted.columns)
    assert got.count() == len(values)
    assert got.exceptAll(wanted).count() == 0
    unscored = got.where("status <> 'ok'").orderBy("offset").collect()
    assert [(r.offset, r.prediction, r.value) for r in unscored] == [
        (2, None, "x"), (3, None, None), (4, None, values[4]),
    ]
    assert got.where("status = 'ok' AND value IS NULL").count() == 3


def test_a_trained_model_scores_a_stream(spark, place, config):
    values = [text(cat0=c, sensor0=float(i)) for i, c in enumerate(["sound", "worn"] * 10)]
    _arrive(spark, place, [v if i % 3 else text(Result=0, sensor0=90.0) for i, v in enumerate(values)])
    _arrive(spark, place, ["x"], first_offset=20)

    def prepared(rows):
        return features.assemble(decode.accepted(decode.decode_messages(rows, config)))

    batch = prepared(spark.read.schema(S.ENVELOPE).parquet(place.source))
    models.save(models.fit(batch), place.other)
    loaded = models.load(place.other)
    scored = loaded.transform(prepared(_stream(spark, place))).select("offset", "prediction")
    runs.run_available(sinks.to_table(scored, place.out, place.checkpoint))
    got = {r.offset: r.prediction for r in spark.read.parquet(place.out).collect()}
    wanted = {r.offset: r.prediction for r in loaded.transform(batch).collect()}
    assert got == wanted and len(got) == 20


def test_modes(spark, place, config):
    _arrive(spark, place, [text(), "x"])
    stream = _stream(spark, place)
    with pytest.raises(ValueError):
        jobs.run("sing", stream, config, place.out, place.checkpoint)
    with pytest.raises(ValueError):
        jobs.run("score", stream, config, place.out, place.checkpoint)
    runs.run_available(jobs.run("archive", stream, config, place.out, place.checkpoint))
    counts = {r.status: r["count"] for r in spark.read.parquet(place.out).groupBy("status").count().collect()}
    assert counts == {"ok": 1, "malformed": 1}


def test_a_bounded_run_ends_by_itself(spark, place):
    _arrive(spark, place, [text()] * 2)
    sink = sinks.TableSink(place.out)
    started = time.time()
    query = runs.run_for(jobs.archive(_stream(spark, place), sink, place.checkpoint), 8)
    assert not query.isActive and time.time() - started < 60
    assert [o for o, _ in _archived(spark, sink)] == [0, 1]


def test_rows_to_the_console(spark, place):
    # The JVM prints; what a test can see is that the rows went through.
    _arrive(spark, place, [text()])
    query = runs.run_available(
        jobs.archive(_stream(spark, place), sinks.console_sink(), place.checkpoint)
    )
    assert sum(p.numInputRows for p in query.recentProgress) == 1


@pytest.mark.parametrize(
    "n, sizes", [(0, []), (9, [9]), (10, [10]), (11, [10, 1]), (35, [10, 10, 10, 5])]
)
def test_inserts_of_a_task(spark, n, sizes):
    numbered = messages(spark, ["{}"] * n).withColumn("insert_no", sinks.insert_number())
    counted = numbered.groupBy("insert_no").count().orderBy("insert_no").collect()
    assert [r["count"] for r in counted] == sizes


def test_inserts_are_counted_per_task(spark):
    rows = spark.range(0, 70, 1, 2).withColumn("task", F.spark_partition_id())
    counted = rows.groupBy("task", sinks.insert_number().alias("insert")).count()
    assert sorted(r["count"] for r in counted.collect()) == [5, 5, 10, 10, 10, 10, 10, 10]


class _Files:
    """A client that writes one file per insert."""

    def __init__(self, folder: str, partition: int, epoch: int):
        self.stem = f"{folder}/{epoch}-{partition}"
        self.n = 0

    def insert_many(self, documents):
        with open(f"{self.stem}-{self.n}", "w") as file:
            file.write("\n".join(documents))
        self.n += 1

    def close(self):
        open(f"{self.stem}-closed", "w").close()


@pytest.mark.parametrize(
    "n, sizes", [(0, []), (9, [9]), (10, [10]), (35, [10, 10, 10, 5])]
)
def test_buffered_inserts(spark, place, tmp_path, n, sizes):
    folder = tmp_path / "inserts"
    folder.mkdir()
    _arrive(spark, place, [text()] * n)
    stream = decode.archive_rows(_stream(spark, place))
    inserts = sinks.BufferedInserts(lambda p, e: _Files(str(folder), p, e))
    runs.run_available(
        stream.writeStream.foreach(inserts).option("checkpointLocation", place.checkpoint)
    )
    written = sorted(p for p in folder.iterdir() if not p.name.endswith("closed"))
    assert [len(p.read_text().splitlines()) for p in written] == sizes
    if n:
        assert any(p.name.endswith("closed") for p in folder.iterdir())


def test_the_rest_is_inserted_after_an_error():
    calls = []

    class Client:
        def insert_many(self, documents):
            calls.append(list(documents))

        def close(self):
            calls.append("closed")

    inserts = sinks.BufferedInserts(lambda p, e: Client(), insert_size=2)
    inserts.close(None)
    assert inserts.open(0, 0)
    for name in "abc":
        inserts.process({"value": name})
    inserts.close(RuntimeError())
    inserts.close(None)
    assert calls == [["a", "b"], ["c"], "closed"]


def test_connector_options():
    sink = sinks.mongo_sink(insert_size=25, collection="records")
    assert sink.all_options() == {
        "operationType": "replace",
        "idFieldList": "_id",
        "upsertDocument": "true",
        "collection": "records",
        "maxBatchSize": "25",
    }
    assert sinks.mongo_sink().all_options()["maxBatchSize"] == "10"


def test_lines_and_documents_appear_together(spark, place):
    values = [text(), "x", None]
    _arrive(spark, place, values)
    runs.run_available(jobs.consume_whole(_stream(spark, place), place.out, place.checkpoint))
    _arrive(spark, place, values, first_offset=3)
    runs.run_available(jobs.consume_whole(_stream(spark, place), place.out, place.checkpoint))
    table = manifests.WholeBatches(place.out)
    stored = table.read(spark, "documents", decode.archive_schema())
    assert sorted((r.offset, r.batch, r.status) for r in stored.collect()) == [
        (3 * b + i, b, s) for b in (0, 1) for i, s in enumerate(["ok", "malformed", "blank"])
    ]
    assert table.read(spark, "lines", T.StructType([T.StructField("line", T.StringType())])).count() == 6


def test_a_stream_is_published_into_a_topic_table(spark, place):
    _arrive(spark, place, [text()] * 5)
    for _ in range(2):
        runs.run_available(
            jobs.publish_stream(_stream(spark, place).drop("offset"), place.checkpoint, TOPIC_TABLE, place.out)
        )
    read = message_scan(spark, TOPIC, TOPIC_TABLE, place.out)
    assert sorted(r.offset for r in read.collect()) == list(range(5))

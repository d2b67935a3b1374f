"""Inserts of ten from columns, committed by batch."""

from __future__ import annotations

import datetime
import json
import pickle
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeflow.plans import event_records as er
from gaugeflow.plans import topic_queries
from gaugeflow.streaming import inserts, runs


class _Listed:
    """A store in memory, for one process."""

    def __init__(self, fails_at: int | None = None):
        self.calls, self.closed, self.undone, self.fails_at = [], 0, [], fails_at

    def connect(self, task):
        return self

    def insert_many(self, documents):
        if len(self.calls) == self.fails_at:
            raise OSError("store is gone")
        self.calls.append(documents)
        return str(len(self.calls))

    def close(self):
        self.closed += 1

    def abort(self, batch, done):
        self.undone += [name for m in done for name in m.names]


def _batches(*sizes):
    at = 0
    for n in sizes:
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(at, at + n), pa.int64())})
        at += n


@pytest.mark.parametrize(
    "sizes", [(), (0,), (9,), (10,), (11,), (25,), (3, 3, 3, 3), (9, 1), (9, 0, 2), (35, 35, 1), (1,) * 30, (10, 10)]
)
def test_all_inserts_but_the_last_are_full(sizes):
    store = _Listed()
    told = inserts.write_inserts(_batches(*sizes), store, 3, 10)
    n = sum(sizes)
    assert told.sizes == [10] * (n // 10) + ([n % 10] if n % 10 else [])
    assert [len(c) for c in store.calls] == told.sizes and told.task == 3
    assert [d["i"] for c in store.calls for d in c] == list(range(n))
    assert store.closed == 1 and len(told.names) == len(told.sizes)


def test_a_failed_task_undoes_its_inserts():
    store = _Listed(fails_at=2)
    with pytest.raises(OSError):
        inserts.write_inserts(_batches(35), store, 0, 10)
    assert store.undone == ["1", "2"] and store.closed == 1


def test_inserts_hold_documents():
    with pytest.raises(ValueError):
        inserts.insert_source(_Listed(), 0)


def _stored(path):
    found = {}
    for file in Path(path).glob("batch=*/*.json"):
        found[file.parent.name, file.name] = [json.loads(x) for x in file.read_text().splitlines()]
    return found


def test_table(spark, tmp_path):
    store = inserts.FolderStore(str(tmp_path / "store"))
    rows = spark.range(0, 64, 1, 3).select("id", F.current_date().alias("day"))
    inserts.insert_table(rows, store)
    found = _stored(store.path)
    by_task = {}
    for (_, name), documents in found.items():
        by_task.setdefault(name[:10], []).append((name, len(documents)))
    assert sorted([n for _, n in sorted(files)] for files in by_task.values()) == [[10, 10, 1], [10, 10, 1], [10, 10, 2]]
    assert sorted(d["id"] for ds in found.values() for d in ds) == list(range(64))
    assert not list(Path(store.path, "_aside").glob("*"))


def test_a_failed_table_leaves_nothing(spark, tmp_path):
    store = inserts.FolderStore(str(tmp_path / "store"))
    broken = spark.range(0, 64, 1, 4).select(
        F.when(F.col("id") == 40, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(Exception, match="bad row"):
        inserts.insert_table(broken, store)
    # What killed tasks leave aside is not read.
    assert _stored(store.path) == {}
    assert not list(Path(store.path).glob("batch=*"))


def test_stream_batches_are_committed_once(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    spark.range(0, 25, 1, 1).write.parquet(source)
    store = inserts.FolderStore(str(tmp_path / "store"))
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(source)
    runs.run_available(inserts.insert_stream(stream, store, checkpoint))
    spark.range(25, 32, 1, 1).write.mode("append").parquet(source)
    runs.run_available(inserts.insert_stream(stream, store, checkpoint))
    found = _stored(store.path)
    assert sorted(d["id"] for ds in found.values() for d in ds) == list(range(32))
    assert sorted(len(ds) for ds in found.values()) == [5, 7, 10, 10]
    # A batch that comes again is dropped, with what its tasks have written.
    again = store.connect(0)
    name = again.insert_many([{"id": 0}])
    store.commit(0, [inserts.Inserted(0, [1], [name])])
    assert _stored(store.path) == found and not list(Path(store.path).glob("_aside/*.json"))


class _Weighed(inserts.FolderStore):
    """Keeps how many bytes the driver has been told of a batch."""

    def commit(self, batch, done):
        Path(f"{self.path}-told").write_text(str(len(pickle.dumps([vars(m) for m in done]))))
        super().commit(batch, done)


def test_the_driver_holds_as_much_of_many_inserts_as_of_few(spark, tmp_path):
    told, listed = [], []
    for n in (20, 2000):
        store = _Weighed(str(tmp_path / f"store-{n}"))
        inserts.insert_table(spark.range(0, n, 1, 2), store, 5)
        read = store.read(spark, spark.range(1).schema)
        assert sorted(r.id for r in read.collect()) == list(range(n))
        assert read.select("file_name").distinct().count() == n // 5
        told.append(int(Path(f"{store.path}-told").read_text()))
        listed.append(len(read.inputFiles()))
    assert told[0] == told[1] and listed == [2, 2]


def test_sizes_of_inserts_without_a_list_of_their_files(spark, tmp_path):
    moment = datetime.datetime(2024, 1, 1)
    rows = [(i, moment + datetime.timedelta(seconds=i), i % 7, "view", 1.0, "{}") for i in range(1006)]
    spark.createDataFrame(rows, er.EVENTS).write.parquet(str(tmp_path / "events.parquet"))
    found = topic_queries.insert_sizes(spark, str(tmp_path))
    assert len(found.inputFiles()) <= er.PARTITIONS
    wanted = [(p, k, 10) for p in range(4) for k in range(25)] + [(0, 25, 2), (1, 25, 2), (2, 25, 1), (3, 25, 1)]
    assert sorted(map(tuple, found.select("partition", "insert_no", "size").collect())) == sorted(wanted)


def test_committed_documents_are_read_and_no_others(spark, tmp_path):
    store = inserts.FolderStore(str(tmp_path / "store"))
    kind = "id bigint, text string"
    empty = store.read(spark, spark.createDataFrame([], kind).schema)
    assert empty.columns == ["id", "text", "file_name"] and empty.count() == 0
    texts = ["plain", "two\nlines\r\n", 'a "quote" \\ \u2028 \u0085 Zoë 好', "", None, "x" * 3_000_000, "y" * 3_000_000]
    rows = spark.createDataFrame(list(enumerate(texts)), kind).coalesce(1)
    inserts.insert_table(rows, store, 2)
    client = store.connect(0)
    store.commit(7, [inserts.Inserted(0, [1], [client.insert_many([{"id": 7, "text": "named"}])])])
    store.commit(8, [])
    client.insert_many([{"id": 9, "text": "aside"}])
    found = store.read(spark, rows.schema).collect()
    assert sorted((r.id, r.text) for r in found) == [*enumerate(texts), (7, "named")]
    for r in found:
        (held,) = Path(store.path).glob(f"batch=*/{r.file_name}")
        assert r.id in [json.loads(line)["id"] for line in held.read_text().splitlines()]


def test_listed_inserts_are_undone(tmp_path):
    store = inserts.FolderStore(str(tmp_path / "store"))
    told = inserts.write_inserts(_batches(35), store, 0, 10)
    again = inserts.write_inserts(_batches(15), store, 1, 10)
    assert told.listed and told.names == [] and told.sizes == []
    store.abort(0, [told, again])
    store.abort(0, [told])
    assert not list(Path(store.path, "_aside").glob("*"))


def test_a_task_whose_list_fails_undoes_its_inserts(tmp_path):
    class Full(inserts.FolderStore):
        def report(self, done):
            raise OSError("no space")

    store = Full(str(tmp_path / "store"))
    with pytest.raises(OSError, match="no space"):
        inserts.write_inserts(_batches(35), store, 0, 10)
    assert not list(Path(store.path, "_aside").glob("*"))

"""Inserts of a fixed size into a store of one's own: a sink of Spark's data source API.

Tasks get columns, cut them into inserts, and tell the driver what they inserted. The driver
commits a batch when all of its tasks are done, and has it undone if one of them failed. What
it holds of a task does not grow with the inserts, if the store keeps the names of those.
"""

from __future__ import annotations

import io
import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.streaming import DataStreamWriter

# Tasks need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Documents per insert call; a fixed value.
INSERT_SIZE = 10
# Bytes of documents that a reader of inserts holds before it passes them on.
READ_BYTES = 4 << 20
# In every batch of a folder, the lists of its inserts; files and folders of such names are not read as data.
NAMES = "_names"


@dataclass
class Inserted(WriterCommitMessage):
    """What a task has inserted; `names` is what its client calls the inserts.

    With `listed` the names are in a list of that name, which the store keeps.
    """

    task: int
    sizes: list[int]
    names: list[str]
    listed: str = ""


class Client(Protocol):
    """A task's connection to a store."""

    def insert_many(self, documents: list[dict]) -> str: ...

    def close(self) -> None: ...


class Store(Protocol):
    """Where documents go; pickled, and opened by every task.

    A batch may come again under its number after a failure, and a task may run twice. Inserts
    count from `commit` on; `batch` is None for a table. `abort` undoes what it is given. A task
    sends to the driver what `report` makes of its inserts, or all it did if there is no such method.
    """

    def connect(self, task: int) -> Client: ...

    def report(self, done: Inserted) -> Inserted:
        return done

    def commit(self, batch: int | None, done: Sequence[Inserted]) -> None: ...

    def abort(self, batch: int | None, done: Sequence[Inserted]) -> None: ...


def write_inserts(batches: Iterator, store: Store, task: int, insert_size: int) -> Inserted:
    """Insert the rows of column batches, all inserts full but the last one of the task."""
    sizes: list[int] = []
    names: list[str] = []
    client = store.connect(task)

    def insert(documents: list[dict]) -> None:
        names.append(client.insert_many(documents))
        sizes.append(len(documents))

    try:
        held: list[dict] = []
        for batch in batches:
            at = 0
            if held:
                at = min(insert_size - len(held), batch.num_rows)
                held += batch.slice(0, at).to_pylist()
                if len(held) < insert_size:
                    continue
                insert(held)
            full = at + (batch.num_rows - at) // insert_size * insert_size
            for k in range(at, full, insert_size):
                insert(batch.slice(k, insert_size).to_pylist())
            held = batch.slice(full).to_pylist()
        if held:
            insert(held)
        done = Inserted(task, sizes, names)
        return store.report(done) if hasattr(store, "report") else done
    except BaseException:
        # The driver hears nothing of a failed task, so the task undoes its own inserts.
        store.abort(None, [Inserted(task, sizes, names)])
        raise
    finally:
        client.close()


class _Writer(DataSourceArrowWriter):
    def __init__(self, store: Store, insert_size: int):
        self.store, self.insert_size = store, insert_size

    def write(self, iterator: Iterator) -> Inserted:
        return write_inserts(iterator, self.store, TaskContext.get().partitionId(), self.insert_size)

    def commit(self, messages: list) -> None:
        self.store.commit(None, [m for m in messages if m is not None])

    def abort(self, messages: list) -> None:
        self.store.abort(None, [m for m in messages if m is not None])


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, store: Store, insert_size: int):
        self.store, self.insert_size = store, insert_size

    def write(self, iterator: Iterator) -> Inserted:
        return write_inserts(iterator, self.store, TaskContext.get().partitionId(), self.insert_size)

    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803
        self.store.commit(batchId, [m for m in messages if m is not None])

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        self.store.abort(batchId, [m for m in messages if m is not None])


def insert_source(store: Store, insert_size: int = INSERT_SIZE, name: str = "inserts") -> type[DataSource]:
    """A sink format that inserts into a store."""
    if insert_size < 1:
        raise ValueError("an insert holds at least one document")

    class Inserts(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self):
            raise NotImplementedError("a sink only")

        def writer(self, schema, overwrite: bool) -> _Writer:
            return _Writer(store, insert_size)

        def streamWriter(self, schema, overwrite: bool) -> _StreamWriter:  # noqa: N802
            return _StreamWriter(store, insert_size)

    return Inserts


def insert_stream(
    stream: DataFrame, store: Store, checkpoint: str, insert_size: int = INSERT_SIZE
) -> DataStreamWriter:
    name = f"inserts_{uuid.uuid4().hex}"
    stream.sparkSession.dataSource.register(insert_source(store, insert_size, name))
    return stream.writeStream.format(name).outputMode("append").option("checkpointLocation", checkpoint)


def insert_table(rows: DataFrame, store: Store, insert_size: int = INSERT_SIZE) -> None:
    name = f"inserts_{uuid.uuid4().hex}"
    rows.sparkSession.dataSource.register(insert_source(store, insert_size, name))
    rows.write.format(name).mode("append").save()


@dataclass(frozen=True)
class FolderStore:
    """Documents as lines of JSON in a shared folder, a file for each insert.

    Tasks write aside; committing a batch moves its files to `batch=<number>`, once. What a task
    that was killed leaves aside is read by nobody. Each task lists its files in one more, which
    goes along, so neither a commit nor a reader holds the names of a batch.
    """

    path: str

    def _place(self):
        from pyarrow import fs

        remote = "://" in self.path or self.path.startswith("file:")
        return fs.FileSystem.from_uri(self.path) if remote else (fs.LocalFileSystem(), self.path)

    def connect(self, task: int) -> FolderClient:
        return FolderClient(*self._place(), task)

    def report(self, done: Inserted) -> Inserted:
        if done.listed or not done.names:
            return done
        files, root = self._place()
        listed = f"task-{done.task:05d}-{uuid.uuid4().hex}.txt"
        with files.open_output_stream(f"{root}/_aside/{listed}") as file:
            for k in range(0, len(done.names), 10_000):
                file.write("".join(f"{name}\n" for name in done.names[k : k + 10_000]).encode())
        return Inserted(done.task, [], [], listed)

    def _named(self, message: Inserted) -> Iterator[str]:
        """The names of a task's inserts; none if its list has gone."""
        from pyarrow import fs

        files, root = self._place()
        yield from message.names
        listed = f"{root}/_aside/{message.listed}"
        if message.listed and files.get_file_info(listed).type != fs.FileType.NotFound:
            with io.TextIOWrapper(files.open_input_stream(listed), "utf-8") as lines:
                yield from (line.rstrip("\n") for line in lines)

    def commit(self, batch: int | None, done: Sequence[Inserted]) -> None:
        from pyarrow import fs

        files, root = self._place()
        target = f"{root}/batch={'table-' + uuid.uuid4().hex if batch is None else batch}"
        if files.get_file_info(target).type != fs.FileType.NotFound:
            self.abort(batch, done)
            return
        collected = f"{root}/_aside/{uuid.uuid4().hex}"
        files.create_dir(f"{collected}/{NAMES}", recursive=True)
        for message in map(self.report, done):
            for name in self._named(message):
                files.move(f"{root}/_aside/{name}", f"{collected}/{name}")
            if message.listed:
                files.move(f"{root}/_aside/{message.listed}", f"{collected}/{NAMES}/{message.listed}")
        # One rename, so the batch is there with all of its inserts or not at all.
        files.move(collected, target)

    def abort(self, batch: int | None, done: Sequence[Inserted]) -> None:
        from pyarrow import fs

        files, root = self._place()

        def delete(name: str) -> None:
            if files.get_file_info(f"{root}/_aside/{name}").type != fs.FileType.NotFound:
                files.delete_file(f"{root}/_aside/{name}")

        for message in done:
            for name in self._named(message):
                delete(name)
            if message.listed:
                delete(message.listed)

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """Committed documents, each with the name of its insert's file as `file_name`.

        Tasks open the files that the lists name, so the driver gets to know as many files as
        there were tasks, and not as many as there were inserts.
        """
        from pyarrow import fs

        files, root = self._place()
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        batches = sorted(i.base_name for i in found if i.base_name.startswith("batch="))
        if not batches:
            return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("file_name", T.StringType())]))
        listed = spark.read.schema("value string, batch string").option("basePath", self.path)
        named = listed.text([f"{self.path}/{batch}/{NAMES}" for batch in batches]).select("batch", "value")
        lines = named.mapInArrow(self._lines, "file_name string, line string")
        documents = lines.select(F.from_json("line", schema).alias("document"), "file_name")
        return documents.select("document.*", "file_name")

    def _lines(self, named: Iterator) -> Iterator:
        """The lines of inserts, from their batches and names."""
        import pyarrow as pa

        files, root = self._place()
        names: list[str] = []
        lines: list[str] = []
        size = 0

        def held():
            return pa.RecordBatch.from_pydict({"file_name": names, "line": lines}, pa.schema(kinds))

        kinds = [("file_name", pa.string()), ("line", pa.string())]
        for columns in named:
            for batch, name in zip(*(c.to_pylist() for c in columns.columns), strict=True):
                with files.open_input_stream(f"{root}/batch={batch}/{name}") as file:
                    text = file.read()
                found = [line for line in text.decode().split("\n") if line]
                names += [name] * len(found)
                lines += found
                size += len(text)
                if size >= READ_BYTES:
                    yield held()
                    names, lines, size = [], [], 0
        if lines:
            yield held()


class FolderClient:
    def __init__(self, files: Any, root: str, task: int):
        self.files, self.root, self.task, self.own = files, root, task, uuid.uuid4().hex
        self.n = 0
        files.create_dir(f"{root}/_aside", recursive=True)

    def insert_many(self, documents: list[dict]) -> str:
        name = f"task-{self.task:05d}-insert-{self.n:07d}-{self.own}.json"
        self.n += 1
        with self.files.open_output_stream(f"{self.root}/_aside/{name}") as file:
            file.write("".join(f"{json.dumps(d, default=str)}\n" for d in documents).encode())
        return name

    def close(self) -> None:
        pass

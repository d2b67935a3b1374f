"""Where batches of a stream go. Writing a batch again leaves one copy of it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from gaugeflow import session

# Documents per insert call; a fixed value.
INSERT_SIZE = 10


class Sink(Protocol):
    def write(self, batch: DataFrame, batch_id: int) -> None: ...


@dataclass(frozen=True)
class TableSink:
    """A table with one folder per batch, so a batch that runs again replaces itself.

    `partition_by` splits each batch further without a shuffle.
    """

    path: str
    fmt: str = "parquet"
    partition_by: tuple[str, ...] = ()
    options: Mapping[str, str] = field(default_factory=dict)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.format(self.fmt).mode("overwrite").options(**self.options)
        # The whole folder is replaced, whatever the session says about partitions.
        writer = writer.option("partitionOverwriteMode", "static")
        writer.partitionBy(*self.partition_by).save(f"{self.path}/batch={batch_id}")

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """All batches, with the number of the batch as column `batch`."""
        whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        return spark.read.format(self.fmt).schema(whole).load(self.path)


@dataclass(frozen=True)
class ConnectorSink:
    """A store reached through a connector on the classpath.

    Give options by which the store replaces a document of the same `_id`, as a
    batch may be written twice. `insert_size` goes to the connector under the
    name it has there.
    """

    fmt: str
    options: Mapping[str, str]
    insert_size: int = INSERT_SIZE
    insert_size_option: str | None = None

    def all_options(self) -> dict[str, str]:
        options = dict(self.options)
        if self.insert_size_option:
            options.setdefault(self.insert_size_option, str(self.insert_size))
        return options

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.format(self.fmt).mode("append").options(**self.all_options()).save()


def mongo_sink(insert_size: int = INSERT_SIZE, **options: str) -> ConnectorSink:
    """The public MongoDB connector, replacing documents of the same `_id`."""
    replacing = {"operationType": "replace", "idFieldList": "_id", "upsertDocument": "true"}
    return ConnectorSink("mongodb", {**replacing, **options}, insert_size, "maxBatchSize")


def console_sink() -> ConnectorSink:
    """A preview: the first rows of each batch and no more. It replaces no sink."""
    return ConnectorSink("console", {"truncate": "false"})


def to_sink(
    stream: DataFrame,
    sink: Sink,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> DataStreamWriter:
    """Write every batch of a stream to one sink."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sink.write(shape(batch), batch_id)

    return _writer(stream, checkpoint).foreachBatch(write)


@dataclass(frozen=True)
class Branch:
    """One side of a fan-out: what to make of each row, and where it goes."""

    shape: Callable[[DataFrame], DataFrame]
    sink: Sink


def fan_out(stream: DataFrame, branches: Mapping[str, Branch], checkpoint: str) -> DataStreamWriter:
    """Write every row to every branch.

    A batch is written once to the shared folder, where the branches read it in turn, so
    the source is read once and no executor holds a part of it. The folder goes when the
    branches are done. They do not commit together: each is safe to write again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = session.work_folder(spark, "batch")
        try:
            batch.write.parquet(folder)
            held = spark.read.schema(batch.schema).parquet(folder)
            for branch in branches.values():
                branch.sink.write(branch.shape(held), batch_id)
        finally:
            session.discard(spark, folder)

    return _writer(stream, checkpoint).foreachBatch(write)


def to_table(
    stream: DataFrame, path: str, checkpoint: str, *partition_by: str
) -> DataStreamWriter:
    """Spark's own file sink: readers see finished batches only, each once."""
    writer = _writer(stream, checkpoint).format("parquet").option("path", path)
    return writer.partitionBy(*partition_by) if partition_by else writer


def _writer(stream: DataFrame, checkpoint: str) -> DataStreamWriter:
    return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)


def insert_number(insert_size: int = INSERT_SIZE) -> Column:
    """Which insert call of its task a row belongs to, from 0.

    The lower 33 bits of the row id count the rows of a task, so neither a
    shuffle nor a window is needed.
    """
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.floor(position / insert_size)


class Client(Protocol):
    def insert_many(self, documents: list[str]) -> None: ...

    def close(self) -> None: ...


class BufferedInserts:
    """For `writeStream.foreach`: insert through a client of your own.

    Each partition of each batch opens a client, inserts whenever the buffer is
    full, and inserts the rest on closing, after an error too. Rows pass through
    Python one at a time, so prefer a connector where there is one. A partition
    may run again: the client must replace documents it already has.
    """

    def __init__(
        self,
        connect: Callable[[int, int], Client],
        insert_size: int = INSERT_SIZE,
        column: str = "value",
    ):
        self.connect = connect
        self.insert_size = insert_size
        self.column = column
        self.client: Client | None = None
        self.buffer: list[str] = []

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.client = self.connect(partition_id, epoch_id)
        self.buffer = []
        return True

    def process(self, row: Row) -> None:
        self.buffer.append(row[self.column])
        if len(self.buffer) >= self.insert_size:
            self._flush()

    def close(self, error: Any) -> None:
        if self.client is None:
            return
        try:
            self._flush()
        finally:
            self.client.close()
            self.client = None

    def _flush(self) -> None:
        if self.buffer:
            self.client.insert_many(self.buffer)
            self.buffer = []

"""Topics kept as a table: every published batch whole or not at all, every message in its place.

    <path>/messages/entry=<n>/...   the messages of the n-th batch, sorted by place
    <path>/_ledger/entry=<n>/...    what the batch holds; it is committed once this folder is there

An entry of the ledger names the files of its batch with the places that each holds, the next
free place of every topic and partition so far, and the last batch of every writer. So a
batch needs the latest entry only, and no messages that were published before. A batch that
did not get as far as its entry is written again under the same number.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from gaugeflow import schemas as S
from gaugeflow import session
from gaugeflow.functions import records
from gaugeflow.sources.messages import Subscription

PARTITIONS = 8
#: Bytes of messages that are read together. A reader of some places skips the rest of a file.
ROW_GROUP = 8 << 20
MESSAGES, LEDGER = "messages", "_ledger"
FILE, NEXT, WRITER = "file", "next", "writer"
ENTRY = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("next", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("writer", T.StringType()),
        T.StructField("batch", T.LongType()),
    ]
)
_PLACE = (1 << 33) - 1


def key_partition(partitions: int = PARTITIONS) -> Column:
    """The partition of a message by its key; messages without a key are spread by their text."""
    return F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(partitions)).cast("int")


@dataclass(frozen=True)
class TopicTable:
    """One publisher at a time writes a table; any number of readers may read it meanwhile."""

    path: str
    partitions: int = PARTITIONS

    def _entry(self, number: int) -> str:
        return f"{self.path}/{LEDGER}/entry={number:012d}"

    def last_entry(self, spark: SparkSession) -> int:
        """The number of the latest batch; -1 if there is none."""
        names = session.listed(spark, f"{self.path}/{LEDGER}")
        return max((int(n.split("=")[1]) for n in names if n.startswith("entry=")), default=-1)

    def _state(self, spark: SparkSession, number: int) -> DataFrame:
        if number < 0:
            return spark.createDataFrame([], ENTRY)
        return spark.read.schema(ENTRY).parquet(self._entry(number))

    def ledger(self, spark: SparkSession) -> DataFrame:
        """All entries, with the number of each as `entry`."""
        whole = T.StructType([*ENTRY.fields, T.StructField("entry", T.LongType())])
        if self.last_entry(spark) < 0:
            return spark.createDataFrame([], whole)
        return spark.read.schema(whole).option("basePath", f"{self.path}/{LEDGER}").parquet(f"{self.path}/{LEDGER}/*")

    def places(self, spark: SparkSession) -> DataFrame:
        """The next free place of every topic and partition."""
        now = self._state(spark, self.last_entry(spark)).where(F.col("kind") == NEXT)
        return now.select("topic", "partition", "next")

    def _placed(self, messages: DataFrame, state: DataFrame) -> tuple[DataFrame, int]:
        """Messages in the order of their arrival, numbered on from the ledger without gaps, and how many.

        Rows are counted by task, topic and partition, and only those counts are ordered.
        """
        own = F.col("partition") if "partition" in messages.columns else key_partition(self.partitions)
        moment = F.col("timestamp") if "timestamp" in messages.columns else F.current_timestamp()
        arrived = messages.withColumn("_own", F.monotonically_increasing_id()).select(
            F.col("key").cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            "topic",
            own.cast("int").alias("partition"),
            moment.cast("timestamp").alias("timestamp"),
            "_own",
        )
        sorted_rows = arrived.sortWithinPartitions("topic", "partition", "_own").drop("_own")
        held = session.stage(
            sorted_rows.select(
                "*",
                F.spark_partition_id().alias("_task"),
                F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("_place"),
            ),
            "published",
        )
        of_partition = Window.partitionBy("topic", "partition").orderBy("_task")
        runs = held.groupBy("_task", "topic", "partition").agg(
            F.min("_place").alias("_first"), F.count("*").alias("_n")
        )
        unplaced = F.col("topic").isNull() | F.col("partition").isNull()
        arrived_n = runs.agg(F.sum("_n").alias("n"), F.count_if(unplaced).alias("lost")).first()
        if arrived_n.lost:
            raise ValueError("every message needs a topic, and a partition if there is such a column")
        before = F.sum("_n").over(of_partition) - F.col("_n") - F.col("_first")
        shifts = (
            runs.withColumn("_before", before)
            .join(state.where(F.col("kind") == NEXT).select("topic", "partition", "next"), ["topic", "partition"], "left")
            .select("_task", "topic", "partition", (F.col("_before") + F.coalesce("next", F.lit(0))).alias("_shift"))
        )
        placed = held.join(shifts, ["_task", "topic", "partition"]).select(
            "key", "value", "topic", "partition", (F.col("_place") + F.col("_shift")).alias("offset"),
            "timestamp", F.lit(0).alias("timestampType"),
        )
        return placed, arrived_n.n or 0

    def publish(self, messages: DataFrame, writer: str = "", batch: int | None = None) -> Delivery | None:
        """Append messages with `topic`, `key`, `value`; give back what was delivered.

        With a number, a batch that the writer has published already is left out, so it may
        come again. None means that there was nothing to publish.
        """
        spark = messages.sparkSession
        last = self.last_entry(spark)
        state = self._state(spark, last).where(F.col("kind") != FILE).cache()
        try:
            if batch is not None:
                done = state.where((F.col("kind") == WRITER) & (F.col("writer") == writer) & (F.col("batch") >= batch))
                if not done.isEmpty():
                    return None
            return self._append(messages, state, last + 1, writer, batch)
        finally:
            state.unpersist()

    def _append(self, messages: DataFrame, state: DataFrame, number: int, writer: str, batch: int | None):
        spark = messages.sparkSession
        folder = f"{self.path}/{MESSAGES}/entry={number:012d}"
        keys = ["topic", "partition", "offset"]
        placed, n = self._placed(messages, state)
        if not n:
            return None
        # By ranges, so a topic or partition with most of the messages fills many files.
        ranged = placed.repartitionByRange(*keys).sortWithinPartitions(*keys)
        out = ranged.write.mode("overwrite").option("partitionOverwriteMode", "static")
        out.option("parquet.block.size", str(ROW_GROUP)).parquet(folder)
        written = spark.read.schema(S.ENVELOPE).parquet(folder)
        files = written.groupBy("topic", "partition", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"))
        ranges = files.agg(
            F.min("offset").alias("first"), (F.max("offset") + 1).alias("next"), F.count("*").alias("n")
        )
        ranges = session.stage(ranges, "ranges")
        told = ranges.agg(F.sum("n").alias("n"), F.count_if(F.expr("next - first <> n")).alias("gaps")).first()
        if told.n != n or told.gaps:
            raise RuntimeError(f"{n} messages came and {told.n} were written, {told.gaps} files with gaps")
        rows = ranges.withColumn("file", F.concat(F.lit(f"entry={number:012d}/"), "file")).withColumn("kind", F.lit(FILE))
        now = state.where(F.col("kind") == NEXT).select("topic", "partition", "next")
        now = now.unionByName(ranges.select("topic", "partition", "next")).groupBy("topic", "partition")
        made = rows.unionByName(
            now.agg(F.max("next").alias("next")).withColumn("kind", F.lit(NEXT)), allowMissingColumns=True
        ).unionByName(state.where((F.col("kind") == WRITER) & (F.col("writer") != writer)), allowMissingColumns=True)
        if batch is not None:
            own = spark.createDataFrame([(WRITER, writer, batch)], "kind string, writer string, batch bigint")
            made = made.unionByName(own, allowMissingColumns=True)
        aside = f"{self.path}/{LEDGER}/.{uuid.uuid4().hex}"
        made.select(*[F.col(f.name).cast(f.dataType) for f in ENTRY]).coalesce(1).write.parquet(aside)
        session.renamed(spark, aside, self._entry(number))
        return Delivery(self, number, n)

    def scan(self, spark: SparkSession, subscription: Subscription) -> DataFrame:
        """Committed messages of a subscription."""
        last = self.last_entry(spark)
        if last < 0:
            return spark.createDataFrame([], S.ENVELOPE)
        whole = T.StructType([*S.ENVELOPE.fields, T.StructField("entry", T.LongType())])
        there = spark.read.schema(whole).parquet(f"{self.path}/{MESSAGES}")
        return there.where((F.col("entry") <= last) & subscription.selected()).select(*S.ENVELOPE.names)


@dataclass(frozen=True)
class Delivery:
    """What one publish has written."""

    table: TopicTable
    entry: int
    n_messages: int

    def ranges(self, spark: SparkSession) -> DataFrame:
        """First and next place, and number of messages, of every topic and partition it wrote to."""
        rows = self.table._state(spark, self.entry).where(F.col("kind") == FILE)
        return rows.groupBy("topic", "partition").agg(
            F.min("first").alias("first"), F.max("next").alias("next"), F.sum(F.col("next") - F.col("first")).alias("n")
        )

    def messages(self, spark: SparkSession) -> DataFrame:
        folder = f"{self.table.path}/{MESSAGES}/entry={self.entry:012d}"
        return spark.read.schema(S.ENVELOPE).parquet(folder)

    def report(self, spark: SparkSession) -> DataFrame:
        """The report line of every message that it delivered, and of no other."""
        text = self.messages(spark).withColumn("key", records.text("key")).withColumn("value", records.text("value"))
        return text.select("key", "topic", "partition", "offset", records.delivery_line().alias("line"))


def publish_stream(messages: DataFrame, table: TopicTable, checkpoint: str, writer: str = "stream") -> DataStreamWriter:
    """Publish a stream of `topic`, `key`, `value`. Give every checkpoint a writer name of its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.publish(batch, writer, batch_id)

    return (
        messages.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    )

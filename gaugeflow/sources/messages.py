"""Message topics: what to subscribe to, and from where to where.

The same subscription opens a Kafka source or selects from an envelope table,
so jobs and tests differ in the format name only.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.schemas import ENVELOPE
from gaugeflow.sources.topic_stream import NAME as TOPIC_TABLE
from gaugeflow.sources.topic_stream import TopicSource

# Names and numbers the Kafka source gives to open positions.
EARLIEST, LATEST = "earliest", "latest"
FROM_EARLIEST, FROM_LATEST = -2, -1

# A topic partition becomes one task unless it is cut; one partition may hold
# a third of a topic.
RECORDS_PER_TASK = 1_000_000
# What a micro-batch takes in at most, so that whatever it holds in memory, and
# whatever a failed one repeats, stays small against the whole.
RECORDS_PER_BATCH = 1_000_000_000
BYTES_PER_BATCH = 1 << 40

Offsets = Mapping[str, Mapping[int, int]]
Position = str | Offsets


@dataclass(frozen=True)
class Subscription:
    """Topics, the first offset to read, and for a scan the offset to stop before.

    A position is `earliest`, `latest`, or offsets by topic and partition, where
    -2 stands for earliest and -1 for latest. On a table, partitions that are not
    listed are read whole; Kafka wants every partition listed.
    """

    topics: tuple[str, ...]
    start: Position = EARLIEST
    end: Position = LATEST

    def __post_init__(self) -> None:
        if not self.topics:
            raise ValueError("name at least one topic")
        if self.end == EARLIEST:
            raise ValueError("a scan cannot end at earliest")

    def kafka_options(self, streaming: bool) -> dict[str, str]:
        options = {
            "subscribe": ",".join(self.topics),
            "startingOffsets": _kafka_position(self.start),
            "maxRecordsPerPartition": str(RECORDS_PER_TASK),
        }
        if streaming:
            options["maxOffsetsPerTrigger"] = str(RECORDS_PER_BATCH)
        else:
            options["endingOffsets"] = _kafka_position(self.end)
        return options

    def topic_options(self) -> dict[str, str]:
        """Options of a stream over a topic table."""
        return {"topics": json.dumps(self.topics), "start": _kafka_position(self.start)}

    def selected(self) -> Column:
        """The same choice as a predicate on an envelope table."""
        chosen = F.col("topic").isin(*self.topics)
        return chosen & self._from_start() & self._before_end()

    def _from_start(self) -> Column:
        if isinstance(self.start, str):
            return F.lit(self.start == EARLIEST)
        skipped = F.lit(False)
        for topic, partition, offset in _listed(self.start):
            if offset == FROM_LATEST:
                skipped = skipped | _at(topic, partition)
            elif offset != FROM_EARLIEST:
                skipped = skipped | (_at(topic, partition) & (F.col("offset") < offset))
        return ~skipped

    def _before_end(self) -> Column:
        if isinstance(self.end, str):
            return F.lit(True)
        skipped = F.lit(False)
        for topic, partition, offset in _listed(self.end):
            if offset != FROM_LATEST:
                skipped = skipped | (_at(topic, partition) & (F.col("offset") >= offset))
        return ~skipped


def _listed(offsets: Offsets):
    for topic, by_partition in offsets.items():
        for partition, offset in by_partition.items():
            yield topic, partition, offset


def _at(topic: str, partition: int) -> Column:
    return (F.col("topic") == topic) & (F.col("partition") == partition)


def _kafka_position(position: Position) -> str:
    if isinstance(position, str):
        return position
    named = {t: {str(p): o for p, o in ps.items()} for t, ps in position.items()}
    return json.dumps(named, sort_keys=True)


def bounded_files(options: Mapping[str, str]) -> dict[str, str]:
    """Options of a file stream, with a bound on its batches if they have none."""
    if {"maxFilesPerTrigger", "maxBytesPerTrigger"} & set(options):
        return dict(options)
    return {**options, "maxBytesPerTrigger": str(BYTES_PER_BATCH)}


def message_stream(
    spark: SparkSession,
    subscription: Subscription,
    fmt: str = "kafka",
    path: str | None = None,
    **options: str,
) -> DataFrame:
    """Messages as a stream.

    Another bound for micro-batches can be given as `maxOffsetsPerTrigger` for
    Kafka, or `maxFilesPerTrigger` or `maxBytesPerTrigger` for an envelope table. A topic
    table takes in all there is, or `maxOffsetsPerTrigger`, kept over restarts if `planned`
    names a file of the query's own; `runs.run_caught_up` reads it to its end in such batches.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        return reader.options(**subscription.kafka_options(streaming=True)).options(**options).load()
    if fmt == TOPIC_TABLE:
        spark.dataSource.register(TopicSource)
        reader = reader.options(path=path, **subscription.topic_options())
        return reader.options(**options).load()
    if subscription.start == LATEST:
        raise ValueError("a stream over files has no positions; it starts at its first file")
    files = reader.schema(ENVELOPE).options(**bounded_files(options)).load(path)
    return files.where(subscription.selected())


def message_scan(
    spark: SparkSession,
    subscription: Subscription,
    fmt: str = "kafka",
    path: str | None = None,
    **options: str,
) -> DataFrame:
    """Messages between two positions as a table."""
    reader = spark.read.format(fmt)
    if fmt == "kafka":
        return (
            reader.options(**subscription.kafka_options(streaming=False)).options(**options).load()
        )
    if fmt == TOPIC_TABLE:
        from gaugeflow.streaming.topics import TopicTable

        return TopicTable(path).scan(spark, subscription)
    return reader.schema(ENVELOPE).options(**options).load(path).where(subscription.selected())

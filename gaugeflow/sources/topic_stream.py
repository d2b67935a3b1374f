"""A stream over a topic table, by places: a source of Spark's data source API.

Offsets are the next place to read of every topic and partition, as for a broker. The ledger
of the table says which files hold which places, so a batch opens the files it needs, and a
partition with many messages is cut into tasks. Only committed batches are seen.

With a bound, a batch takes in at most that many messages, dealt out over the partitions in
proportion to what they hold. How far batches have been planned is kept in a file, since
Spark does not tell a source where a restarted query stands before it asks for its next end.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The processes that plan and read a stream need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "topic_table"
RECORDS_PER_TASK = 100_000
ENVELOPE = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
)
# Names and numbers of open positions, as the broker's source has them.
EARLIEST, LATEST = "earliest", "latest"
FROM_EARLIEST, FROM_LATEST = -2, -1

Offsets = dict[str, dict[str, int]]


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Ledger:
    """What is committed to a table; entries are read once, as they do not change."""

    def __init__(self, path: str, topics: list[str]):
        self.path, self.topics = path, topics
        self.read = -1
        self.next: Offsets = {t: {} for t in topics}
        self.files: list[tuple[str, int, int, int, str]] = []

    def refresh(self) -> None:
        import pyarrow.parquet as pq
        from pyarrow import fs

        files, root = _file_system(self.path)
        found = files.get_file_info(fs.FileSelector(f"{root}/_ledger", allow_not_found=True))
        for info in sorted(found, key=lambda i: i.base_name):
            if not info.base_name.startswith("entry=") or int(info.base_name[6:]) <= self.read:
                continue
            for row in pq.read_table(info.path, filesystem=files, partitioning=None).to_pylist():
                if row["topic"] not in self.next:
                    continue
                if row["kind"] == "next":
                    self.next[row["topic"]][str(row["partition"])] = row["next"]
                elif row["kind"] == "file":
                    self.files.append((row["topic"], row["partition"], row["first"], row["next"], row["file"]))
            self.read = int(info.base_name[6:])

    def latest(self) -> Offsets:
        self.refresh()
        return {t: dict(p) for t, p in self.next.items()}


class Stretch(InputPartition):
    """Places of one topic and partition, and the files that hold them."""

    def __init__(self, topic: str, partition: int, first: int, end: int, files: list[str]):
        self.topic, self.partition, self.first, self.end, self.files = topic, partition, first, end, files


def dealt(start: Offsets, latest: Offsets, most: int | None) -> Offsets:
    """An end with at most so many messages after start: a share of what each partition holds."""
    waiting = {(t, p): n - start.get(t, {}).get(p, 0) for t, ps in latest.items() for p, n in ps.items()}
    waiting = {place: n for place, n in waiting.items() if n > 0}
    total = sum(waiting.values())
    end = {t: dict(ps) for t, ps in start.items()}
    for t in latest:
        end.setdefault(t, {})
    left = total if most is None else min(most, total)
    for (t, p), n in sorted(waiting.items(), key=lambda x: (x[1], x[0])):
        share = -(-n * left // total) if total else 0
        total -= n
        left -= min(share, n)
        if share:
            end[t][p] = start.get(t, {}).get(p, 0) + min(share, n)
    return end


class TopicStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, Any]):
        self.path = options["path"].rstrip("/")
        topics = json.loads(options["topics"])
        start = options.get("start", EARLIEST)
        self.start = start if start in (EARLIEST, LATEST) else json.loads(start)
        self.most = int(options["maxoffsetspertrigger"]) if "maxoffsetspertrigger" in options else None
        self.per_task = int(options.get("recordspertask", RECORDS_PER_TASK))
        self.plan_file = options.get("planned")
        if self.most is not None and not self.plan_file:
            raise ValueError("a bound per batch needs `planned`, a file of the query's own")
        self.ledger = Ledger(self.path, topics)
        self.planned: Offsets | None = None

    def initialOffset(self) -> Offsets:
        latest = self.ledger.latest()
        if self.start == LATEST:
            return latest
        begin: Offsets = {t: {} for t in self.ledger.topics}
        if self.start == EARLIEST:
            return begin
        for topic, places in self.start.items():
            for partition, place in places.items():
                if topic in begin and place != FROM_EARLIEST:
                    now = latest[topic].get(partition, 0)
                    begin[topic][partition] = now if place == FROM_LATEST else place
        return begin

    def _read_plan(self) -> Offsets | None:
        if not self.plan_file:
            return None
        files, path = _file_system(self.plan_file)
        if not files.get_file_info(path).is_file:
            return None
        with files.open_input_stream(path) as file:
            return json.loads(file.read())

    def _write_plan(self, planned: Offsets) -> None:
        if self.plan_file:
            files, path = _file_system(self.plan_file)
            files.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with files.open_output_stream(f"{path}.new") as file:
                file.write(json.dumps(planned).encode())
            files.move(f"{path}.new", path)

    def latestOffset(self) -> Offsets:
        latest = self.ledger.latest()
        if self.most is None:
            # A start beyond what is there stays where it is.
            begin = self.planned or self.initialOffset()
            end = {
                t: {p: max(n, begin.get(t, {}).get(p, 0)) for p, n in {**begin.get(t, {}), **ps}.items()}
                for t, ps in latest.items()
            }
        else:
            end = dealt(self.planned or self._read_plan() or self.initialOffset(), latest, self.most)
            self._write_plan(end)
        self.planned = end
        return end

    def partitions(self, start: Offsets, end: Offsets) -> list[Stretch]:
        self.ledger.refresh()
        if self.planned is None:
            self.planned = end
        by_place: dict[tuple[str, int], list[tuple[int, int, str]]] = {}
        for topic, partition, first, after, file in self.ledger.files:
            by_place.setdefault((topic, partition), []).append((first, after, file))
        made = []
        for topic, places in end.items():
            for name, last in places.items():
                first = start.get(topic, {}).get(name, 0)
                held = by_place.get((topic, int(name)), [])
                for a in range(first, last, self.per_task):
                    b = min(last, a + self.per_task)
                    files = [f for x, y, f in sorted(held) if x < b and y > a]
                    if files:
                        made.append(Stretch(topic, int(name), a, b, files))
        return made

    def read(self, partition: Stretch) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        files, root = _file_system(self.path)
        kinds = pa.schema(
            [
                ("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
                ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")), ("timestampType", pa.int32()),
            ]
        )
        chosen = (
            (pc.field("topic") == partition.topic)
            & (pc.field("partition") == partition.partition)
            & (pc.field("offset") >= partition.first)
            & (pc.field("offset") < partition.end)
        )
        for name in partition.files:
            there = ds.dataset(f"{root}/messages/{name}", filesystem=files, format="parquet", partitioning=None)
            for batch in there.to_batches(columns=kinds.names, filter=chosen, batch_size=10_000):
                if batch.num_rows:
                    columns = [_as(batch.column(f.name), f.type) for f in kinds]
                    yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    def commit(self, end: Offsets) -> None:
        pass

    def stop(self) -> None:
        pass


def _as(column, kind):
    import pyarrow as pa

    if pa.types.is_timestamp(kind) and column.type != kind:
        # What Spark writes is in UTC, with or without saying so.
        return column.cast(pa.timestamp("us"), safe=False).cast(pa.int64()).cast(kind)
    return column.cast(kind)


class TopicSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return ENVELOPE

    def streamReader(self, schema) -> TopicStreamReader:
        return TopicStreamReader({k.lower(): v for k, v in self.options.items()})

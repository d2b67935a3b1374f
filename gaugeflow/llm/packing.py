"""Operator 4, best-fit packing: documents into sequences of at most `capacity` ids.

Only lengths matter for a packing, so the plan is made from the number of pieces of each
length, at most `capacity` numbers however large the corpus. Best-two-fit fills a bin
greedily, always with the longest piece that fits. Then it takes out the bin's smallest
piece as long as two unpacked pieces fit the wider gap more tightly than it did. A filled
bin is used as often as the counts allow. Pieces learn their place from their rank among
those of their length; ranks are counted in salted groups, so a frequent length is spread.

Null texts are empty documents of the end id alone. Rows that are equal in doc_id, piece
and ids are interchangeable; each gets a place of its own. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow import session
from gaugeflow.llm.bpe_stream import shared_codec, texts_of
from gaugeflow.llm.tables import per_batch

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PIECES_WITH_IDS = PIECES + ", ids binary"


@dataclass
class Plan:
    """Ranks first[i] up to the next first of a length go into bins from bin[i] on."""

    length: np.ndarray
    first: np.ndarray
    per_bin: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    bins: int

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of the pieces of these lengths and ranks."""
        base = np.int64(1) << 40
        at = np.searchsorted(self.length * base + self.first, length * base + rank, "right") - 1
        inside = rank - self.first[at]
        return self.bin[at] + inside // self.per_bin[at], self.offset[at] + inside % self.per_bin[at] * length


def _two_that_fit(left: np.ndarray, below: np.ndarray, room: int) -> tuple[int, int]:
    """The two unpacked lengths with the largest sum up to room; (0, 0) if there are none."""
    a = np.flatnonzero(left[: room + 1])
    a = a[a > 0]
    if not len(a):
        return 0, 0
    most = np.minimum(a, room - a)
    same = (most == a) & (left[a] < 2)
    b = below[np.where(same, most - 1, most)]
    total = np.where(b > 0, a + b, 0)
    k = int(np.argmax(total))
    return (int(a[k]), int(b[k])) if total[k] else (0, 0)


def packing_plan(counts: dict[int, int], capacity: int) -> Plan:
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros(capacity + 1, np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    bins = 0
    index = np.arange(capacity + 1)

    def largest() -> np.ndarray:
        return np.maximum.accumulate(np.where(left > 0, index, 0))

    below = largest()
    while top := int(below[capacity]):
        filled: list[int] = []
        gap, fits = capacity, top
        while fits:
            times = min(int(left[fits]), gap // fits)
            filled += [fits] * times
            left[fits] -= times
            gap -= fits * times
            below = largest()
            fits = int(below[gap])
        while gap and len(filled) > 1:
            smallest = filled[-1]
            a, b = _two_that_fit(left, below, gap + smallest)
            if a + b <= smallest:
                break
            filled.pop()
            left[smallest] += 1
            left[a] -= 1
            left[b] -= 1
            gap += smallest - a - b
            filled = sorted([*filled, a, b], reverse=True)
            below = largest()
        lengths, per_bin = np.unique(filled, return_counts=True)
        more = int((left[lengths] // per_bin).min())
        left[lengths] -= more * per_bin
        offset = 0
        for length, k in zip(lengths.tolist(), per_bin.tolist(), strict=True):
            rows.append((length, int(used[length]), k, bins, offset))
            used[length] += k * (more + 1)
            offset += length * k
        bins += more + 1
        below = largest()
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(*(np.ascontiguousarray(table[:, k]) for k in range(5)), bins)


def pieces_of(
    docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """Documents as pieces of at most capacity ids, each document ended by end_id."""

    codec = shared_codec(docs, tokenizer_path)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        kind = np.dtype(codec.value.merges.kind)
        end, step = np.array([end_id], kind).tobytes(), capacity * kind.itemsize
        out: dict[str, list] = {x.split()[0]: [] for x in (PIECES_WITH_IDS if with_ids else PIECES).split(", ")}
        encoded = codec.value.encode_batch(texts_of(batch.column("text")))
        for name, raw in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
            raw += end
            wide = np.frombuffer(raw, kind).astype("<u4").tobytes()
            for piece, at in enumerate(range(0, len(raw), step)):
                own = wide[4 * piece * capacity : 4 * (piece + 1) * capacity]
                row = (name, piece, piece * capacity, len(own) // 4, zlib.crc32(own), own)
                for column, value in zip(out.values(), row, strict=False):
                    column.append(value)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(out.values(), kinds, strict=False)]
        return pa.RecordBatch.from_arrays(columns, list(out))

    return per_batch(docs.select("doc_id", "text"), cut, PIECES_WITH_IDS if with_ids else PIECES)


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """One row per piece with its sequence and its offset there; with_ids adds the ids themselves."""
    spark = docs.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = pieces_of(docs, tokenizer_path, capacity, end_id, with_ids)
    # By the place of the row, which is written down: rows that are repeated differ in it.
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    salted = session.stage(made.withColumn("salt", salt), "pieces")
    counts = {r.length: r.n for r in salted.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = packing_plan(counts, capacity)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    bases = (
        salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", before.alias("base"))
    )
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("row", F.row_number().over(order) - 1)
        .join(bases, ["length", "salt"])
        .withColumn("rank", F.col("base") + F.col("row"))
        .select(*made.columns, "rank")
    )
    shape = PIECES + ", sequence_id bigint, offset bigint" + (", ids binary" if with_ids else "")

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        sequence, offset = plan.places(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
        made = {n: batch.column(n) for n in batch.schema.names if n not in ("rank", "ids")}
        made |= {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
        made |= {"ids": batch.column("ids")} if with_ids else {}
        return pa.RecordBatch.from_pydict(made)

    return per_batch(ranked, place, shape)

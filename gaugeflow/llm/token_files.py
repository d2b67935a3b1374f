"""Operator 1, token-id output: ids in the fewest bits that the vocabulary needs.

A shard image is one binary value:

    magic "IDPK", version u16, bits per id u16, number of ids u64, ids per block u32,
    number of blocks u32, byte offset of each block in the payload and its end u64 each,
    payload

all little-endian. A block holds its ids one after the other, the lowest bit first, and
ends on a whole byte, so any block unpacks alone and by numpy. Images travel in Parquet
rows next to the documents they hold, which lets Spark write and read them in any store.

Null texts are empty documents of one id, the end id. Documents are in ascending order
of doc_id, null first; rows with the same doc_id are next to each other in the order of
their texts' hash. An empty table gives no image. Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.llm.tables import give_back, per_batch, text_key
from gaugeflow.llm.tokens import kept_encoder

MAGIC, VERSION, HEAD = b"IDPK", 1, "<4sHHQII"
HEAD_BYTES = struct.calcsize(HEAD)
BLOCK_IDS = 4096
SHARD_IDS = 1 << 20
SHARDS = (
    "shard int, part int, n_ids long, doc_ids array<bigint>, doc_starts array<bigint>, image binary"
)


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def _pack_block(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(each.astype(np.uint8).ravel(), bitorder="little").tobytes()


def _unpack_block(raw: np.ndarray, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return raw[: n * bits // 8].view(f"<u{bits // 8}").astype("<u4")
    each = np.unpackbits(raw, count=n * bits, bitorder="little").reshape(n, bits)
    return (each.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def pack_image(ids: np.ndarray, bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    ids = np.asarray(ids, np.uint32)
    blocks = [_pack_block(ids[k : k + block_ids], bits) for k in range(0, len(ids), block_ids)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8").tobytes()
    return b"".join([struct.pack(HEAD, MAGIC, VERSION, bits, len(ids), block_ids, len(blocks)), offsets, *blocks])


def read_ids(image: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids from first up to last; only the blocks that hold them are unpacked."""
    magic, version, bits, n, block_ids, blocks = struct.unpack_from(HEAD, image)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a packed id image")
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, "<u4")
    offsets = np.frombuffer(image, "<u8", blocks + 1, HEAD_BYTES).astype(np.int64)
    payload = np.frombuffer(image, np.uint8, offset=HEAD_BYTES + 8 * (blocks + 1))
    head, tail = first // block_ids, (last - 1) // block_ids
    if bits in (8, 16, 32) or head == tail:
        n_read = min(n, (tail + 1) * block_ids) - head * block_ids
        made = _unpack_block(payload[offsets[head] : offsets[tail + 1]], n_read, bits)
    else:
        made = np.concatenate(
            [
                _unpack_block(payload[offsets[k] : offsets[k + 1]], min(block_ids, n - k * block_ids), bits)
                for k in range(head, tail + 1)
            ]
        )
    return made[first - head * block_ids : last - head * block_ids]


def write_shards(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0
) -> None:
    """Encode documents and write their ids to a folder of shards, in order of doc_id."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(tokenizer_path)
        bits, end = bits_for(encoder.vocabulary), np.array([end_id], encoder.kind).tobytes()
        width = encoder.kind.itemsize
        shard, part = TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        names: list[int | None] = []
        sizes: list[int] = []

        def made() -> pa.RecordBatch:
            n = np.array(sizes, np.int64)
            image = pack_image(np.frombuffer(b"".join(ids), encoder.kind), bits)
            row = {
                "shard": [shard], "part": [part], "n_ids": [int(n.sum())], "doc_ids": [names],
                "doc_starts": [(np.cumsum(n) - n).tolist()], "image": [image],
            }
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], list(row)
            )

        held = 0
        for batch in batches:
            encoded = encoder.encode(batch.column("text").to_pylist())
            for name, raw in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                ids += (raw, end)
                names.append(name)
                sizes.append(len(raw) // width + 1)
                held += sizes[-1]
                if held >= SHARD_IDS:
                    yield made()
                    part, held, ids, names, sizes = part + 1, 0, [], [], []
        if names:
            yield made()
        give_back()

    ranged = (
        # The last one cuts a row that is repeated very often into ranges.
        docs.select("doc_id", "text", text_key().alias("k"), F.monotonically_increasing_id().alias("own"))
        .repartitionByRange("doc_id", "k", "own")
        .sortWithinPartitions("doc_id", "k")
    )
    ranged.select("doc_id", "text").mapInArrow(pack, SHARDS).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARDS).parquet(path)


def document_ids(shards: DataFrame) -> DataFrame:
    """Every document's ids, read back from the images."""

    def unpack(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, ids = [], []
        rows = batch.select(["doc_ids", "doc_starts", "n_ids", "image"]).to_pylist()
        for row in rows:
            whole = read_ids(row["image"])
            ids += np.split(whole, row["doc_starts"][1:])
            names += row["doc_ids"]
        offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, "<u4"), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "ids"]
        )

    return per_batch(shards, unpack, "doc_id bigint, ids array<bigint>")


def document_digests(shards: DataFrame) -> DataFrame:
    """doc_id, start among all ids, n_tokens and crc32 of the ids, read back from the images."""

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in ("shard", "part", "doc_id", "local", "n_tokens", "ids_crc32")}
        for row in batch.to_pylist():
            ids = read_ids(row["image"])
            bounds = [*row["doc_starts"], row["n_ids"]]
            for name, a, b in zip(row["doc_ids"], bounds, bounds[1:], strict=False):
                raw = ids[a:b].astype("<u4").tobytes()
                for key, value in zip(out, (row["shard"], row["part"], name, a, b - a, zlib.crc32(raw)), strict=True):
                    out[key].append(value)
        kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out)
        )

    read = per_batch(
        shards, digest, "shard int, part int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"
    )
    # One row per image, then one per shard: the only ordered sum over all is that over shards.
    parts = shards.select("shard", "part", "n_ids")
    totals = parts.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard")) - F.col("n")
    inside = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("part")) - F.col("n_ids")
    starts = (
        parts.withColumn("inside", inside)
        .join(totals.select("shard", before.alias("before")), "shard")
        .select("shard", "part", (F.col("before") + F.col("inside")).alias("base"))
    )
    return read.join(starts, ["shard", "part"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )

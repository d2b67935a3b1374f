"""Bitmaps and counters of fixed size over hashes. Their size does not depend on the data."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow import session
from gaugeflow.llm.tables import text_key

BITS = 21
SLICE = 512


def buckets(hashes: np.ndarray) -> np.ndarray:
    """The bucket, below 2 to the BITS, of 64-bit hashes."""
    return (hashes.view(np.uint64) >> np.uint64(64 - BITS)).astype(np.int64)


def bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """Which buckets the hashes of a column fall into: at most 2 to the BITS numbers reach the driver."""
    bucket = F.shiftrightunsigned(F.col(column), 64 - BITS).cast("int")
    found = rows.select(bucket.alias("b")).where("b IS NOT NULL").distinct().toArrow()
    out = np.zeros(1 << BITS, bool)
    out[found.column("b").to_numpy()] = True
    return out


def without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Documents but those named by rows (doc_id, k, keep); where keep is true, one of them stays.

    Documents outside a filter of fixed size over the names are passed on where they are;
    only the others are joined.
    """
    name = F.xxhash64("doc_id", "k")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(rows.select(name.alias("h")), "h"))

    @F.arrow_udf("boolean")
    def met(hashes: pa.Array) -> pa.Array:
        return pa.array(wanted.value[buckets(hashes.to_numpy(zero_copy_only=False))])

    own = {x: f"__{i}" for i, x in enumerate(("key", "met", "id", "k", "keep", "row"))}
    keyed = docs.withColumn(own["key"], text_key())
    keyed = keyed.withColumn(own["met"], met(F.xxhash64(F.col("doc_id"), F.col(own["key"]))))
    named = rows.select(
        F.col("doc_id").alias(own["id"]), F.col("k").alias(own["k"]), F.col("keep").alias(own["keep"])
    ).distinct()
    order = Window.partitionBy("doc_id", own["key"], own["keep"]).orderBy(own["key"])
    joined = keyed.where(own["met"]).join(
        named, F.col("doc_id").eqNullSafe(F.col(own["id"])) & (F.col(own["key"]) == F.col(own["k"])), "left"
    )
    kept = joined.withColumn(own["row"], F.row_number().over(order)).where(
        F.col(own["keep"]).isNull() | (F.col(own["keep"]) & (F.col(own["row"]) == 1))
    )
    return keyed.where(~F.col(own["met"])).select(*docs.columns).unionByName(kept.select(*docs.columns))


def counter_rows(counts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Counts of 16 bits in slices; slices without any count are left out."""
    table = counts.reshape(-1, SLICE)
    used = np.flatnonzero(table.any(axis=1))
    return used, [table[k].astype("<u2").tobytes() for k in used]


def merged_levels(slices: DataFrame) -> np.ndarray:
    """Rarity of each bucket from rows (slice, counts): eight steps for each doubling, 255 at most.

    Each of the 2 to the BITS / SLICE slices is added up by itself, one row at a time.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(raw, "<u2")
                if k in held:
                    held[k] += own
                else:
                    held[k] = own.astype(np.int64)
        if held:
            levels = [np.minimum(255, np.round(8 * np.log2(1 + x))).astype(np.uint8).tobytes() for x in held.values()]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(levels, pa.binary())], ["k", "l"])

    found = session.stage(slices.repartition("slice").mapInArrow(add, "k int, l binary"), "levels").toArrow()
    out = np.zeros((1 << BITS) // SLICE * SLICE, np.uint8).reshape(-1, SLICE)
    for k, raw in zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True):
        out[k] = np.frombuffer(raw, np.uint8)
    return out.ravel()

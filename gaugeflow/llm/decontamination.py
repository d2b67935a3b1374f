"""Operator 10, benchmark decontamination: a prefix-filtered join of word windows.

Every WINDOW consecutive words of a benchmark item are a window; an item with fewer is one
window of all its words. A window is contained in a document only if all its shingles of
GRAM words are, so its prefix can be as short as one shingle. Shingles are ordered by
rarity, counted over all documents, and the rarest shingle of each window is its prefix.
Documents send out the places where they hold a prefix, and Spark joins both sides on it.
The place of the prefix in the window bounds the place of the window in the document
(position), which has to end within the document (length); then the words themselves are
compared. A filter of fixed size keeps most other places from being sent; it never loses
one. Nothing of the benchmark is broadcast but that filter, so either side may grow.

Null and empty texts have no words: such a document is clean, such an item is in none.
Items that are equal count each under its item_id; rows that repeat an item_id count
once. Documents that are equal in doc_id and text get equal results, one row each. Items with a null
item_id mark words as hit but are not listed. Empty tables give no rows, or only clean ones.
Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import session
from gaugeflow.llm import sketch, words
from gaugeflow.llm.tables import per_batch, text_key

WINDOW, GRAM = 10, 3
ITEM_WINDOWS = "item_id bigint, window string, size int, grams array<bigint>"
PLACES = (
    "doc_id bigint, k bigint, n_words bigint, gram bigint, pos bigint, before int, around string"
)


def _said(block: words.Words, first: int, last: int) -> str:
    """Words first up to last of a block, one space between them."""
    raw = block.read[block.start[first] : block.end[last - 1]].tobytes()
    return b" ".join(raw.split(b" ")).decode() if b"  " not in raw else b" ".join(raw.split()).decode()


def item_windows(items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Windows of each item with the shingles that they hold."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.column("item_id").to_pylist()
        rows = []
        for block in words.blocks(batch.column("text"), words.ALNUM_LOWER):
            hashes = block.hashes()
            grams = {q: block.shingles(hashes, q)[0].view(np.int64) for q in range(1, gram + 1)}
            for i in range(block.texts):
                a, b = int(block.of[i]), int(block.of[i + 1])
                size = min(window, b - a)
                q = min(gram, size)
                for at in range(a, b - size + 1) if size else ():
                    rows.append(
                        (names[block.first + i], _said(block, at, at + size), size, grams[q][at : at + size - q + 1].tolist())
                    )
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["item_id", "window", "size", "grams"]
        )

    return per_batch(items.select("item_id", "text"), cut, ITEM_WINDOWS)


def gram_counts(docs: DataFrame, wanted: np.ndarray, sizes: list[int]) -> DataFrame:
    """How often documents hold the shingles whose buckets are wanted."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for block in words.blocks(batch.column("text"), words.ALNUM_LOWER):
            hashes = block.hashes()
            for q in sizes:
                grams, whole = block.shingles(hashes, q)
                found.append(grams[whole & wanted[sketch.buckets(grams)]])
        values, n = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n, pa.int64())], ["gram", "n"])

    counted = per_batch(docs.select("text"), count, "gram bigint, n bigint")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def prefix_places(docs: DataFrame, wanted: np.ndarray, sizes: list[int], window: int = WINDOW) -> DataFrame:
    """A row for each document, without a gram, and one for each place of a wanted shingle in it."""

    def send(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        lengths = np.zeros(n, np.int64)
        row, gram, pos, before, around = [], [], [], [], []
        for block in words.blocks(batch.column("text"), words.ALNUM_LOWER):
            lengths[block.first : block.first + block.texts] = np.diff(block.of)
            hashes, text_of = block.hashes(), block.text_of()
            for q in sizes:
                grams, whole = block.shingles(hashes, q)
                for at in np.flatnonzero(whole & wanted[sketch.buckets(grams)]):
                    i = text_of[at]
                    a, b = block.of[i], block.of[i + 1]
                    first = max(a, at - window + q)
                    row.append(block.first + i)
                    gram.append(grams[at : at + 1].view(np.int64)[0])
                    pos.append(at - a)
                    before.append(at - first)
                    around.append(_said(block, first, min(b, at + window)))
        every = np.concatenate([np.arange(n), np.array(row, np.int64)])
        take = pa.array(every)

        def padded(values: list, kind: pa.DataType) -> pa.Array:
            return pa.concat_arrays([pa.nulls(n, kind), pa.array(values, kind)])

        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(take), batch.column("k").take(take), pa.array(lengths[every]),
                padded(gram, pa.int64()), padded(pos, pa.int64()), padded(before, pa.int32()), padded(around, pa.string()),
            ],
            ["doc_id", "k", "n_words", "gram", "pos", "before", "around"],
        )

    return per_batch(docs.select("doc_id", text_key().alias("k"), "text"), send, PLACES)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, k, n_words, n_hit, n_items, item_ids (sorted text) and contaminated, a row per document."""
    of_items = session.stage(item_windows(items), "item-windows")
    once = of_items.groupBy("window", "size").agg(F.first("grams").alias("grams"))
    sizes = sorted(r.q for r in once.select(F.least(F.col("size"), F.lit(GRAM)).alias("q")).distinct().collect())
    grams = once.select("window", "size", F.posexplode("grams").alias("place", "gram"))
    counts = gram_counts(docs, sketch.bitmap(grams, "gram"), sizes)
    # A window with a shingle that no document holds is in none.
    rarest = F.min(F.struct(F.col("n"), F.col("gram"), F.col("place"))).alias("r")
    prefixes = session.stage(
        grams.join(counts, "gram", "left")
        .groupBy("window", "size")
        .agg(rarest, F.count("n").alias("found"), F.count("*").alias("all"))
        .where(F.col("found") == F.col("all"))
        .select("window", "size", F.col("r.gram").alias("gram"), F.col("r.place").alias("place")),
        "window-prefixes",
    )
    places = session.stage(prefix_places(docs, sketch.bitmap(prefixes, "gram"), sizes), "prefix-places")
    start = F.col("pos") - F.col("place")
    inside = (F.col("place") <= F.col("before")) & (start + F.col("size") <= F.col("n_words"))
    held = F.array_join(
        F.slice(F.split("around", " "), F.col("before") - F.col("place") + 1, F.col("size")), " "
    )
    hits = session.stage(
        places.where("gram IS NOT NULL")
        .join(prefixes, "gram")
        .where(inside)
        .where(held == F.col("window"))
        .select("doc_id", "k", start.alias("start"), "size", "window"),
        "window-hits",
    )
    # Words covered by the windows of a document, from left to right.
    step = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to")),
        lambda s, w: F.struct(
            (s["n"] + F.greatest(F.lit(0), w["end"] - F.greatest(w["start"], s["to"]))).cast("bigint").alias("n"),
            F.greatest(s["to"], w["end"]).cast("bigint").alias("to"),
        ),
        lambda s: s["n"],
    )
    covered = hits.groupBy("doc_id", "k").agg(step.alias("n_hit"))
    item_of = of_items.where("item_id IS NOT NULL").select("item_id", "window").distinct()
    listed = (
        hits.select("doc_id", "k", "window")
        .distinct()
        .join(item_of, "window")
        .groupBy("doc_id", "k")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    every = places.where("gram IS NULL").select("doc_id", "k", "n_words")

    def same(left: DataFrame, right: DataFrame):
        return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["k"] == right["k"])

    found = covered.join(listed, same(covered, listed), "left").select(
        covered["doc_id"].alias("hit_id"), covered["k"].alias("hit_k"), "n_hit", "items"
    )
    none = F.array().cast("array<string>")
    return every.join(
        found, every["doc_id"].eqNullSafe(found["hit_id"]) & (every["k"] == found["hit_k"]), "left"
    ).select(
        "doc_id",
        "k",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("bigint").alias("n_items"),
        F.array_join(F.coalesce("items", none), ",").alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )

"""Operator 13, ranked lexical search over bit-sliced signatures.

Every document has a Bloom signature of its terms, and of the steps that their frequencies
reach. Documents whose signatures have the same length are shelved together, and a shelf
is stored by bits: one bitmap over its documents for each place of the signature. The bitmaps
of a term's places, taken together, say which documents may hold it; they never miss one. Summed
with the weights of an item's terms they bound its score with every document from above.

The documents with the highest bounds are scored exactly first. The lowest of an item's best
scores so found is a limit, and all documents whose bound for some item reaches its limit are
then scored exactly, from their whole texts. What is left out cannot be among the best.
Candidates reach the scan of the texts as a filter of their names, sized by their number up to
FILTER_BITS; a full filter only lets more documents be scored.

Items are taken in blocks of at most BLOCK_ENTRIES terms, an item with more being its own.

Documents without a term, null ones too, are not ranked and not counted; items without a term
or a match have no rows. Equal scores are ranked by doc_id, null first; rows that are repeated are
documents of their own, as are repeated items. Terms are told apart by a hash, their length and
their last eight bytes, which is exact up to sixteen bytes. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from gaugeflow import session
from gaugeflow.llm.tables import give_back, text_key
from gaugeflow.llm.words import ALNUM_LOWER, Words, blocks, mixed

PLACES = 4
BITS_EACH = 8
#: A signature also holds the terms that occur twice, four times and eight times.
STEPS = 4
SHELF_CELLS = 1 << 23
SEEDS = 16
FILTER_BITS = 24
BLOCK_ENTRIES = 50_000
_CELLS = 1 << 21
_STEP = 0xA0761D6478BD642F

INDEX = (
    "kind string, bits int, n_docs long, n_words long, names binary, lengths binary, most binary, slices binary, "
    "h array<bigint>, size array<bigint>, tail array<bigint>, df array<bigint>"
)


def _elements(hashes: np.ndarray, step: int) -> np.ndarray:
    return mixed(hashes + np.uint64(_STEP * (step + 1) % (1 << 64)))


def _places(elements: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The places of an element in a signature of so many bits, a power of two."""
    second = (elements >> np.uint64(32)) | np.uint64(1)
    for k in range(PLACES):
        yield ((elements + second * np.uint64(k)) & np.uint64(bits - 1)).astype(np.int64)


def _tails(w: Words, which: np.ndarray) -> np.ndarray:
    """The last eight bytes, or all, of some words."""
    padded = np.concatenate([np.zeros(8, np.uint8), w.read])
    eights = np.ndarray((len(w.read) + 1,), "<u8", padded, strides=(1,))
    length = np.minimum(w.end[which] - w.start[which], 8).astype(np.uint64)
    return (eights[w.end[which]] >> ((np.uint64(8) - length) * np.uint64(8) % np.uint64(64))) * (length > 0)


def _counted(of: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of words by text and hash, and where each run of equal ones begins."""
    order = np.argsort(hashes)
    texts = of[order]
    order = order[np.argsort(texts.astype(np.uint16) if len(texts) and texts.max() < 1 << 16 else texts, kind="stable")]
    a, b = of[order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(new)


class _Shelf:
    """Documents with signatures of the same length, until there are enough for a row."""

    def __init__(self, bits: int):
        self.bits = bits
        self.most_docs = max(8, SHELF_CELLS // bits // 8 * 8)
        self.clear()

    def clear(self) -> None:
        self.names: list[int] = []
        self.lengths: list[int] = []
        self.most: list[int] = []
        self.elements: list[np.ndarray] = []

    def row(self) -> dict:
        n = len(self.names)
        cells = np.zeros((self.bits, -(-n // 8) * 8), bool)
        flat = np.concatenate(self.elements)
        of = np.repeat(np.arange(n), [len(e) for e in self.elements])
        for place in _places(flat, self.bits):
            cells[place, of] = True
        made = {
            "kind": "shelf", "bits": self.bits, "n_docs": n, "n_words": sum(self.lengths),
            "names": np.array(self.names, "<i8").tobytes(), "lengths": np.array(self.lengths, "<i8").tobytes(),
            "most": np.array(self.most, "<i8").tobytes(),
            "slices": np.packbits(cells, axis=1, bitorder="little").tobytes(),
        }
        self.clear()
        return made


def _index_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {
        "kind": pa.string(), "bits": pa.int32(), "n_docs": pa.int64(), "n_words": pa.int64(),
        **dict.fromkeys(("names", "lengths", "most", "slices"), pa.binary()),
        **dict.fromkeys(("h", "size", "tail", "df"), pa.list_(pa.int64())),
    }
    return pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in rows], t) for k, t in kinds.items()], list(kinds))


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def named_filter(rows: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """A bitmap over 64-bit values, with sixteen bits for each up to 2 to the FILTER_BITS in all."""
    n = rows.count()
    bits = min(FILTER_BITS, max(12, (16 * n).bit_length()))
    bucket = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = rows.groupBy(F.shiftright(bucket, 5).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - bits}) & 31 AS int))")).alias("b")
    )
    found = words.toArrow()
    out = np.zeros(1 << (bits - 5), "<u4")
    out[found.column("w").to_numpy()] = found.column("b").to_numpy().astype(np.uint32)
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool), bits


def _sums(h, size, tail, n) -> tuple[np.ndarray, ...]:
    """Counts added up for equal terms."""
    order = np.lexsort((tail, size, h))
    h, size, tail, n = h[order], size[order], tail[order], n[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (size[1:] != size[:-1]) | (tail[1:] != tail[:-1])
    at = np.flatnonzero(new)
    return h[at], size[at], tail[at], np.add.reduceat(n, at) if len(at) else n[:0]


def index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Shelves of all documents, and how many documents hold each term that may be among `terms`.

    The counts are rows of kind `terms`, one for each task, filtered by a bitmap of the terms.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(named_filter(terms, "h"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, filter_bits = wanted.value
        shelves: dict[int, _Shelf] = {}
        counts = tuple(np.zeros(0, t) for t in ("u8", "i8", "u8", "i8"))
        new: list[tuple] = []
        waiting = 0
        for batch in batches:
            names, first = batch.column("name").to_numpy(), 0
            for w in blocks(batch.column("text"), ALNUM_LOWER):
                hashes, of = w.hashes(), w.text_of()
                order, at = _counted(of, hashes)
                tf = np.diff(np.append(at, len(order)))
                word, text = order[at], of[order[at]]
                met = bitmap[_bucket(hashes[word], filter_bits)]
                some = word[met]
                if len(some):
                    one = np.ones(len(some), np.int64)
                    new.append(_sums(hashes[some], w.end[some] - w.start[some], _tails(w, some), one))
                    waiting += len(new[-1][0])
                bounds = np.searchsorted(text, np.arange(w.texts + 1))
                reached = [tf >= 1 << s for s in range(STEPS)]
                for k in np.flatnonzero(np.diff(w.of)).tolist():
                    a, b = bounds[k], bounds[k + 1]
                    own = hashes[word[a:b]]
                    made = np.concatenate([_elements(own[reached[s][a:b]], s) for s in range(STEPS)])
                    bits = 1 << max(6, (BITS_EACH * len(made) - 1).bit_length())
                    shelf = shelves.setdefault(bits, _Shelf(bits))
                    shelf.names.append(int(names[w.first + k]))
                    shelf.lengths.append(int(w.of[k + 1] - w.of[k]))
                    shelf.most.append(int(tf[a:b].max()))
                    shelf.elements.append(made)
                    if len(shelf.names) >= shelf.most_docs:
                        yield _index_batch([shelf.row()])
                first += w.texts
            if waiting > 1 << 20:
                counts, new, waiting = _sums(*map(np.concatenate, zip(counts, *new, strict=True))), [], 0
            give_back()
        for shelf in shelves.values():
            if shelf.names:
                yield _index_batch([shelf.row()])
        h, size, tail, df = _sums(*map(np.concatenate, zip(counts, *new, strict=True)))
        if len(h):
            lists = {"h": h.view("i8"), "size": size, "tail": tail.view("i8"), "df": df}
            yield _index_batch([{"kind": "terms"} | {k: v.tolist() for k, v in lists.items()}])
        give_back()

    return _named(docs).mapInArrow(work, INDEX)


def _named(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64(F.col("doc_id"), text_key()).alias("name"))


def item_terms(items: DataFrame) -> DataFrame:
    """One row per item and distinct term: number of the item's row, item_id, term and repeats."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in blocks(batch.column("text"), ALNUM_LOWER):
                hashes, of = w.hashes(), w.text_of()
                order, at = _counted(of, hashes)
                some = order[at]
                rows = pa.array(w.first + of[some])
                columns = {
                    "row": batch.column("row").take(rows), "item_id": batch.column("item_id").take(rows),
                    "h": pa.array(hashes[some].view("i8")), "size": pa.array(w.end[some] - w.start[some]),
                    "tail": pa.array(_tails(w, some).view("i8")), "q": pa.array(np.diff(np.append(at, len(order)))),
                }
                if len(some):
                    yield pa.RecordBatch.from_pydict(columns)

    kind = items.schema["item_id"].dataType.simpleString()
    rows = session.stage(items.select(F.monotonically_increasing_id().alias("row"), "item_id", "text"), "items")
    shape = f"row bigint, item_id {kind}, h bigint, size bigint, tail bigint, q bigint"
    return session.stage(rows.mapInArrow(work, shape), "terms")


@dataclass
class Block:
    """Some items: their terms, and entries (item, term, repeats times weight) by item."""

    n_docs: int
    n_words: int
    hashes: np.ndarray
    size: np.ndarray
    tail: np.ndarray
    item: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    items: int

    @classmethod
    def of(cls, rows: list[Row], items: int, n_docs: int, n_words: int) -> Block:
        names = sorted({(r.h & (2**64 - 1), r.size, r.tail & (2**64 - 1)): r.df for r in rows}.items())
        at = {name: k for k, (name, _) in enumerate(names)}
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for _, df in names]
        entries = sorted((r.item, at[r.h & (2**64 - 1), r.size, r.tail & (2**64 - 1)], r.q) for r in rows)
        entries = [(i, t, q * weight[t]) for i, t, q in entries if weight[t] > 0]
        table = np.array(entries, np.int64).reshape(-1, 3)
        keys = [k for k, _ in names]
        return cls(
            n_docs, n_words, np.array([k[0] for k in keys], np.uint64), np.array([k[1] for k in keys], np.int64),
            np.array([k[2] for k in keys], np.uint64), *np.ascontiguousarray(table.T), items,
        )

    def slope(self, lengths: np.ndarray) -> np.ndarray:
        """The part of a document's length in its scores."""
        return 100 - 75 + 75 * lengths * self.n_docs // self.n_words

    def bounds(self, row: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Names of some of a shelf's documents, and the bound of each item with each of them."""
        bits, n = row["bits"], row["n_docs"]
        slices = np.frombuffer(row["slices"], np.uint8).reshape(bits, -1)
        names, lengths, most = (np.frombuffer(row[k], "<i8") for k in ("names", "lengths", "most"))
        which, found, reached = np.arange(len(self.hashes)), None, []
        for step in range(STEPS):
            for place in _places(_elements(self.hashes[which], step), bits):
                found = slices[place] if found is None else found & slices[place]
            some = found.any(axis=1)
            which, found = which[some], found[some]
            reached.append((which, found))
        if not len(reached[0][0]):
            return
        # The largest frequency that goes with each number of steps reached, and its part of a score.
        tf = np.array([0, *((1 << s + 1) - 1 for s in range(STEPS - 1)), 1 << 40])[:, None]
        tf = np.minimum(tf, most)
        part = 1_000_000_000 * tf // (1000 * tf + 8 * self.slope(lengths))
        there = np.full(len(self.hashes), -1)
        there[reached[0][0]] = np.arange(len(reached[0][0]))
        entry = np.flatnonzero(there[self.term] >= 0)
        if not len(entry):
            return
        begins = np.flatnonzero(np.diff(self.item[entry], prepend=-1))
        wide = max(8, _CELLS // len(entry) // 8 * 8)
        for a in range(0, n, wide):
            b = min(n, a + wide)
            level = np.zeros((len(reached[0][0]), b - a), np.uint8)
            for terms, bitmap in reached:
                level[there[terms]] += np.unpackbits(bitmap[:, a // 8 : -(-b // 8)], axis=1, bitorder="little")[:, : b - a]
            parts = part[:, a:b][level, np.arange(b - a)]
            bound = np.zeros((self.items, b - a), np.int64)
            bound[self.item[entry[begins]]] = np.add.reduceat(
                parts[there[self.term[entry]]] * self.weight[entry, None], begins, axis=0
            )
            yield names[a:b], bound

    def scores(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, item and exact score of each pair of a text and an item that score."""
        hashes, of = w.hashes(), w.text_of()
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        met = np.flatnonzero(self.hashes[at] == hashes) if len(self.hashes) else np.zeros(0, np.int64)
        # Words whose hash is that of a term, but which differ from it, are none.
        same = (w.end[met] - w.start[met] == self.size[at[met]]) & (_tails(w, met) == self.tail[at[met]])
        met = met[same]
        terms = len(self.hashes)
        pair, tf = np.unique(of[met] * terms + at[met], return_counts=True)
        text, term = pair // max(terms, 1), pair % max(terms, 1)
        by_term = np.argsort(self.term, kind="stable")
        first = np.searchsorted(self.term[by_term], term, "left")
        n = np.searchsorted(self.term[by_term], term, "right") - first
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        entry = by_term[np.repeat(first, n) + inside]
        part = 1_000_000_000 * tf // (1000 * tf + 8 * self.slope(np.diff(w.of)[text]))
        gained = self.weight[entry] * np.repeat(part, n)
        key = np.repeat(text, n) * self.items + self.item[entry]
        order = np.argsort(key, kind="stable")
        key, gained = key[order], gained[order]
        begins = np.flatnonzero(np.diff(key, prepend=-1))
        total = np.add.reduceat(gained, begins) if len(begins) else gained
        key = key[begins]
        return key // self.items, key % self.items, total


BEST = "item int, bound bigint, name bigint"


def _highest_bounds(shelves: DataFrame, shared) -> DataFrame:
    """The names with the SEEDS highest bounds of each item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        bound = np.zeros((block.items, SEEDS), np.int64)
        name = np.zeros((block.items, SEEDS), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                for names, more in block.bounds(row):
                    both = np.concatenate([bound, more], axis=1)
                    top = np.argpartition(both, -SEEDS, axis=1)[:, -SEEDS:]
                    all_names = np.concatenate([name, np.broadcast_to(names, more.shape)], axis=1)
                    bound = np.take_along_axis(both, top, axis=1)
                    name = np.take_along_axis(all_names, top, axis=1)
        item, place = np.nonzero(bound)
        if len(item):
            found = {"item": pa.array(item, pa.int32()), "bound": bound[item, place], "name": name[item, place]}
            yield pa.RecordBatch.from_pydict(found)
        give_back()

    best = shelves.mapInArrow(work, BEST)
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "name")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SEEDS).select("name")


def _not_excluded(shelves: DataFrame, shared, limits: np.ndarray) -> DataFrame:
    """Names of the documents whose bound reaches the limit of some item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for names, bound in shared.value.bounds(row):
                    kept = names[(bound >= limits[:, None]).any(axis=0)]
                    if len(kept):
                        yield pa.RecordBatch.from_pydict({"name": kept})
        give_back()

    return shelves.mapInArrow(work, "name bigint")


def _scored(docs: DataFrame, names: DataFrame, shared, limits: np.ndarray) -> DataFrame:
    """Exact scores that reach the limit of their item, of documents that the filter lets through."""
    passing = docs.sparkSession.sparkContext.broadcast(named_filter(names, "name"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, bits = passing.value
        for batch in batches:
            rows = np.flatnonzero(bitmap[_bucket(batch.column("name").to_numpy(), bits)])
            if not len(rows):
                continue
            batch = batch.take(pa.array(rows))
            for w in blocks(batch.column("text"), ALNUM_LOWER):
                text, item, score = shared.value.scores(w)
                high = score >= limits[item]
                found = {
                    "item": pa.array(item[high], pa.int32()),
                    "doc_id": batch.column("doc_id").take(pa.array(w.first + text[high])),
                    "score": pa.array(score[high]),
                }
                if high.any():
                    yield pa.RecordBatch.from_pydict(found)
            give_back()

    return _named(docs).mapInArrow(work, f"item int, doc_id {kind}, score bigint")


def _best(scored: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _item_blocks(terms: DataFrame) -> list[DataFrame]:
    """The terms of some items each: as many blocks as the number of terms asks for."""
    n = -(-terms.count() // BLOCK_ENTRIES)
    if n <= 1:
        return [terms] * n
    block = F.pmod(F.xxhash64("row"), F.lit(2 * n))
    staged = session.stage(terms.withColumn("block", block), "item-blocks", "block")
    return [staged.where(F.col("block") == k).drop("block") for k in range(2 * n)]


def search(docs: DataFrame, items: DataFrame, most: int = 10) -> DataFrame:
    """The documents with the highest scores for each item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    terms = item_terms(items)
    made = session.stage(index(docs, terms), "index", "kind")
    shelves = made.where("kind = 'shelf'")
    sums = shelves.agg(F.sum("n_docs").alias("n"), F.sum("n_words").alias("l")).first()
    counts = made.where("kind = 'terms'").select(F.explode(F.arrays_zip("h", "size", "tail", "df")).alias("t"))
    counts = counts.groupBy("t.h", "t.size", "t.tail").agg(F.sum("t.df").alias("df"))
    known = session.stage(terms.join(counts, ["h", "size", "tail"]), "weighted-terms")
    found = []
    for own in _item_blocks(known) if sums.n else []:
        rows = own.collect()  # of about BLOCK_ENTRIES terms
        if not rows:
            continue
        at = {row: k for k, row in enumerate(sorted({r.row for r in rows}))}
        numbered = [Row(item=at[r.row], h=r.h, size=r.size, tail=r.tail, q=r.q, df=r.df) for r in rows]
        shared = spark.sparkContext.broadcast(Block.of(numbered, len(at), sums.n, sums.l))
        limits = np.ones(len(at), np.int64)
        seeds = session.stage(_highest_bounds(shelves, shared).distinct(), "seeds")
        tenth = _best(_scored(docs, seeds, shared, limits), most).where(F.col("rank") == most)
        for row in tenth.select("item", "score").collect():  # one for each item of the block
            limits[row.item] = row.score
        candidates = session.stage(_not_excluded(shelves, shared, limits), "candidates")
        ranked = _best(_scored(docs, candidates, shared, limits), most)
        item_ids = {at[r.row]: r.item_id for r in rows}
        named = spark.createDataFrame(
            sorted(item_ids.items()), f"item int, item_id {terms.schema['item_id'].dataType.simpleString()}"
        )
        found.append(ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        shape = f"item_id {terms.schema['item_id'].dataType.simpleString()}, rank int, "
        return spark.createDataFrame([], shape + f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score bigint")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


SQL = r"""
WITH said AS (
    SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), asked AS (
    SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), total AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_words FROM said WHERE len(w) > 0),
tf AS (SELECT d, term, count(*)::BIGINT AS tf FROM said, unnest(w) AS u(term) GROUP BY d, term),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
wanted AS (SELECT i, item_id, term, count(*)::BIGINT AS q FROM asked, unnest(w) AS u(term) GROUP BY i, item_id, term),
weighted AS (
    SELECT i, item_id, term, q, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
    FROM wanted JOIN df USING (term), total
), scored AS (
    SELECT i, any_value(item_id) AS item_id, doc_id, d, sum(q * weight * ((1000000000 * tf)
        // (1000 * tf + 8 * (100 - 75 + (75 * len(w)::BIGINT * n_docs) // n_words))))::BIGINT AS score
    FROM weighted JOIN tf USING (term) JOIN said USING (d), total GROUP BY i, d, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

"""Operator 3, toxicity: sentences scored by a model that is learned from document labels.

A document is a bag of sentences, of which one is enough to make it toxic. With p_s for
the sentences, noisy-or gives the document 1 - prod(1 - p_s); p_s is a logistic function
of the sentence's words and of their first four and five bytes, hashed. The weights are
learned by gradient descent on the document labels, so no sentence is labelled. The same
p_s then locate the sentences that offend.

The sample is bounded for each class: SAMPLE_ROWS documents and SAMPLE_BYTES of text, of
texts up to TEXT_BYTES. Where a class has longer texts only, the beginnings of long texts, of at
most as many bytes, take part in the fit as well. Scores are always those of whole texts.

A sentence ends at a full stop, exclamation mark, question mark or line feed. Null and
empty texts have no sentence and score 0. Rows with the same doc_id are scored apart; a
doc_id labelled more than once is toxic if any label says so. Without labels of both
kinds every score is 0. An empty table gives no rows, other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow import session
from gaugeflow.llm import words
from gaugeflow.llm.tables import bounded_sample, give_back, text_key

#: Labelled documents of each class, as many of their texts, and bytes of these, that a model is fitted on.
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 32 << 20
#: Longer texts are scored as all others are, but a model is fitted on their beginnings at most.
TEXT_BYTES = 1 << 20
BUCKET_BITS = 22
SLICE_BUCKETS = 1 << 16
PREFIXES = (4, 5)
LEAST_Z, LEAST_DOCUMENTS = 4.0, 4
IS_END = np.zeros(256, bool)
IS_END[list(b".!?\n")] = True


@dataclass
class Model:
    """Weights of the telling buckets; the others weigh nothing."""

    telling: np.ndarray
    values: np.ndarray
    bias: float
    _dense: np.ndarray | None = None

    @property
    def weights(self) -> np.ndarray:
        if self._dense is None:
            self._dense = np.zeros(1 << BUCKET_BITS, np.float32)
            self._dense[self.telling] = self.values
        return self._dense


def _buckets(block: words.Words) -> np.ndarray:
    """Three bucket numbers for each word."""
    mask = np.uint64((1 << BUCKET_BITS) - 1)
    kinds = [block.hashes(), *(words.mixed(block.hashes(k) + np.uint64(k)) for k in PREFIXES)]
    return np.stack([(h & mask).astype(np.int64) for h in kinds], axis=1)


def _sentences(block: words.Words) -> np.ndarray:
    """The number of the sentence of each word, counted through the block's texts with words."""
    if not len(block.start):
        return np.zeros(0, np.int64)
    ended = np.concatenate([[0], np.cumsum(IS_END[block.raw])])[block.start]
    new = np.ones(len(ended), bool)
    new[1:] = (np.diff(ended) > 0) | (np.diff(block.text_of()) > 0)
    return np.cumsum(new) - 1


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _margins(block: words.Words, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The margin of each sentence, and the number of its first word."""
    sentence = _sentences(block)
    if not len(sentence):
        return np.zeros(0), np.zeros(0, np.int64)
    own = model.weights[_buckets(block)].sum(axis=1)
    first = np.flatnonzero(np.diff(sentence, prepend=-1))
    return np.add.reduceat(own, first) + model.bias, first


def score_texts(column: pa.Array, model: Model) -> np.ndarray:
    out = np.zeros(len(column))
    for block in words.blocks(column, words.ALNUM_LOWER):
        z, first = _margins(block, model)
        if len(first):
            total = np.bincount(block.text_of()[first], _softplus(z), block.texts)
            out[block.first : block.first + block.texts] = -np.expm1(-total)
    return out


def score(text: Column | str, model: Model) -> Column:
    """The probability, 0 to 1, that a text is toxic."""

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        made = pa.array(score_texts(column, model))
        give_back()
        return made

    return scored(text)


SPANS = "array<struct<first_byte:bigint,end_byte:bigint,score:double,text:string>>"


def offending(text: Column | str, model: Model, least: float = 0.3) -> Column:
    """The sentences whose own score is at least `least`, from first to last word."""

    @F.arrow_udf(SPANS)
    def located(column: pa.Array) -> pa.Array:
        out: list[list[dict]] = [[] for _ in range(len(column))]
        for block in words.blocks(column, words.ALNUM_LOWER):
            z, first = _margins(block, model)
            p = 1 / (1 + np.exp(-z))
            ends = np.append(first[1:], len(block.start)) - 1
            text_of = block.text_of()
            for k in np.flatnonzero(p >= least):
                i, a, b = text_of[first[k]], block.start[first[k]], block.end[ends[k]]
                out[block.first + i].append(
                    {
                        "first_byte": int(a - block.offsets[i]), "end_byte": int(b - block.offsets[i]),
                        "score": float(p[k]), "text": block.raw[a:b].tobytes().decode("utf-8", "replace"),
                    }
                )
        kind = pa.list_(
            pa.struct(
                [("first_byte", pa.int64()), ("end_byte", pa.int64()), ("score", pa.float64()), ("text", pa.string())]
            )
        )
        return pa.array(out, kind)

    return located(text)


def _telling(held: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each bucket among the telling ones, or -1, and the telling ones; a slice at a time."""
    n = np.array([(~toxic).sum(), toxic.sum()], float)
    place, found = np.full(held.shape[1], -1, np.int32), []
    for a in range(0, held.shape[1], SLICE_BUCKETS):
        own = held[:, a : a + SLICE_BUCKETS]
        both = own.sum(axis=0)
        share = (both + 0.5) / (n.sum() + 1)
        z = (own[1] / n[1] - own[0] / n[0]) / np.sqrt(share * (1 - share) * (1 / n).sum())
        found.append(a + np.flatnonzero((np.abs(z) >= LEAST_Z) & (both >= LEAST_DOCUMENTS)))
    telling = np.concatenate(found)
    place[telling] = np.arange(len(telling))
    return place, telling


def fit_texts(
    column: pa.Array, toxic: np.ndarray, weight: np.ndarray, rounds: int = 400, rate: float = 0.1, decay: float = 1e-4
) -> Model:
    """Fit on texts with their labels and the weight of each.

    The driver does this, so it holds eight bytes for each feature and works on a block at a time.
    """
    none = Model(np.zeros(0, np.int64), np.zeros(0), -30.0)
    if not toxic.any() or toxic.all():
        return none
    size = 1 << BUCKET_BITS
    # First pass: documents of each class that hold a bucket. Second: the telling buckets.
    held = np.zeros((2, size), np.int32)
    for block in words.blocks(column, words.ALNUM_LOWER):
        pairs = np.sort((block.text_of()[:, None] * size + _buckets(block)).ravel())
        pairs = pairs[np.diff(pairs, prepend=-1) > 0]
        of = toxic[block.first + pairs // size].astype(int)
        np.add.at(held, (of, pairs % size), 1)
    place, telling = _telling(held, toxic)
    del held
    # Features of a block by sentence, the sentences counted from the block's first.
    parts: list[tuple[slice, np.ndarray, np.ndarray]] = []
    text_of, sentences = [], 0
    for block in words.blocks(column, words.ALNUM_LOWER):
        sentence = _sentences(block)
        if not len(sentence):
            continue
        first = np.flatnonzero(np.diff(sentence, prepend=-1))
        text_of.append((block.first + block.text_of()[first]).astype(np.int32))
        at = place[_buckets(block)]
        row, _ = np.nonzero(at >= 0)
        parts.append((slice(sentences, sentences + len(first)), sentence[row].astype(np.int32), at[at >= 0]))
        sentences += len(first)
    if not sentences:
        return none
    text = np.concatenate(text_of)
    del place, text_of
    wanted, scale = toxic.astype(float), weight / weight.sum()
    w = np.zeros(len(telling) + 1)
    w[-1] = -5.0
    mean, square = np.zeros_like(w), np.zeros_like(w)
    margin = np.empty(sentences)
    for step in range(1, rounds + 1):
        for own, of, f in parts:
            margin[own] = np.bincount(of, w[f], own.stop - own.start) + w[-1]
        total = np.maximum(np.bincount(text, _softplus(margin), len(toxic)), 1e-12)
        # Loss: total for a clean document, -log(1 - exp(-total)) for a toxic one.
        slope = scale * np.where(wanted > 0, -1 / np.expm1(np.minimum(total, 50)), 1.0)
        by_sentence = slope[text] / (1 + np.exp(-margin))
        gradient = np.zeros_like(w)
        for own, of, f in parts:
            np.add.at(gradient, f.astype(np.intp), by_sentence[own][of])
        gradient[-1] = by_sentence.sum()
        gradient[:-1] += decay * w[:-1]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Model(telling, w[:-1], float(w[-1]))


def fit(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES,
    text_bytes: int = TEXT_BYTES,
) -> Model:
    """Learn from labels(doc_id, toxic), of which at most sample_rows of each class are used."""
    once = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
    )
    said = docs.where("text IS NOT NULL").select("doc_id", F.octet_length("text").alias("size"))
    shortest = said.groupBy("doc_id").agg(F.min("size").alias("size"))
    known = session.stage(once.join(shortest, "doc_id"), "labelled")
    short = F.count_if(F.col("size") <= text_bytes).alias("short")
    if known.groupBy("toxic").agg(short).where("short = 0").take(1):
        # A character has four bytes at most.
        begun = F.when(F.octet_length("text") <= text_bytes, F.col("text")).otherwise(
            F.substring("text", 1, text_bytes // 4)
        )
        docs, usable = docs.withColumn("text", begun), known
    else:
        usable = known.where(F.col("size") <= text_bytes)
    chosen = bounded_sample(usable.select("doc_id", "toxic"), "toxic", sample_rows)
    # At most two classes of sample_rows ids, but an id may have many texts; copies count once.
    texts = docs.where(F.octet_length("text") <= text_bytes).select("doc_id", "text", text_key().alias("k"))
    keys = (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("k", "toxic")
        .agg(F.min("doc_id").alias("doc_id"), F.min(F.octet_length("text")).alias("size"))
    )
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "k")
    taken = (
        bounded_sample(session.stage(keys, "texts"), "toxic", sample_rows, "k")
        .withColumn("size", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("size") <= max(sample_bytes, text_bytes))
    )
    sample = (
        texts.join(F.broadcast(taken.drop("size")), ["doc_id", "k"])
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    ).select("text", "toxic").toArrow()
    toxic = np.array(sample.column("toxic").to_pylist(), bool)
    text = sample.column("text").combine_chunks() if sample.num_rows else pa.array([], pa.string())
    del sample
    counts = {r.toxic: r.n for r in once.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    weight = np.ones(len(toxic))
    for kind in (True, False):
        weight[toxic == kind] = counts.get(kind, 0) / max(1, (toxic == kind).sum())
    model = fit_texts(text, toxic, weight)
    del text
    give_back()
    return model

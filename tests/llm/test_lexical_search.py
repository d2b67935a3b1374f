"""Ranked search against a plain version in Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeflow import session
from gaugeflow.llm import lexical_search, queries, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id bigint, text string, score string, item string, name string"
ITEMS = "item_id bigint, text string, row string, q string"


def _terms(text):
    return WORD.findall((text or "").translate(LOWER))


def _brute(docs, items, most=10):
    said = [(d, Counter(_terms(t))) for d, t in docs if _terms(t)]
    n_docs, n_words = len(said), sum(c.total() for _, c in said)
    df = Counter(t for _, c in said for t in c)
    for item_id, text in items:
        scores = []
        for d, c in said:
            m = 100 - 75 + 75 * c.total() * n_docs // n_words
            total = 0
            for term in _terms(text):
                if c[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    total += w * (1_000_000_000 * c[term] // (1000 * c[term] + 8 * m))
            if total > 0:
                scores.append((-total, d is not None, d or 0, d))
        for k, (score, _, _, d) in enumerate(sorted(scores)[:most]):
            yield item_id, k + 1, d, -score


def _tables(seed=1, n=600):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" if i % 3 else f"é{i}" for i in range(900)] + ["averyverylongword" + "x" * k for k in range(20)]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]

    def text(most):
        return " ".join(rng.choices(vocabulary, weights, k=int(rng.paretovariate(0.9) * 3) % most))

    docs = [(i, text(2000)) for i in range(n)] + [(n + i, "Copy of w4 w5, W4-w50!") for i in range(120)]
    docs += [(7, "Copy of w4")] * 15 + [(None, "w4 w7"), (n + 300, None), (n + 301, " \n,"), (n + 302, "w1 " * 30_000)]
    docs += [(n + 303, "x" * 60_000), (n + 304, "\x00w8\x7fw10")]
    items = [(i, text(40)) for i in range(60)] + [(60, None), (61, "w4 w5 w4"), (61, "w4 w5 w4"), (62, "nowhere"), (None, "w8")]
    return docs, items + [(63, "x" * 60_000), (64, " ".join(vocabulary))]


@pytest.mark.parametrize("entries", [lexical_search.BLOCK_ENTRIES, 200])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, entries):
    monkeypatch.setattr(lexical_search, "BLOCK_ENTRIES", entries)
    docs, items = _tables()
    named = spark.createDataFrame([(*d, "clash", "clash", "clash") for d in docs], DOCS).repartition(5)
    named.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(*i, "clash", "clash") for i in items], ITEMS).write.parquet(str(tmp_path / "benchmark.parquet"))
    got = queries.QUERIES["op13_lexical_search"](spark, str(tmp_path))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    rows = Counter(map(tuple, got.collect()))
    wanted = Counter(_brute(docs, items))
    assert rows == wanted


def test_no_documents_and_no_items(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a")], ITEMS.rsplit(", ", 2)[0])
    assert lexical_search.search(docs, items).count() == 0
    some = spark.createDataFrame([(1, "a b", "", "", ""), (2, None, "", "", "")], DOCS)
    assert lexical_search.search(some, items.limit(0)).count() == 0
    assert lexical_search.search(some, items.select("item_id", F.lit(None).cast("string").alias("text"))).count() == 0
    assert [tuple(r) for r in lexical_search.search(some, items).collect()] == list(_brute([(1, "a b")], [(1, "a")]))


def test_bounds_hold_and_exclude(spark):
    """No score is above its bound, and most pairs of a document and an item are bounded closely."""
    docs, items = _tables(2, 300)
    frame = spark.createDataFrame([(*d, "", "", "") for d in docs], DOCS)
    terms = lexical_search.item_terms(spark.createDataFrame([(*i, "", "") for i in items], ITEMS))
    shelves = session.stage(lexical_search.index(frame, terms), "index").where("kind = 'shelf'").collect()
    said = {d: Counter(_terms(t)) for d, t in docs if _terms(t)}
    n_docs = sum(r.n_docs for r in shelves)
    n_words = sum(r.n_words for r in shelves)
    df = Counter()
    hashed = {}
    texts = pa.array([t for _, t in docs])
    counted = []
    for w in words.blocks(texts, words.ALNUM_LOWER):
        counted.append((w, w.hashes()))
    for _, t in docs:
        df.update(set(_terms(t)))
    for row in terms.collect():
        hashed.setdefault(row.row, []).append(row)
    from pyspark.sql import Row

    numbered, at = [], {row: k for k, row in enumerate(sorted(hashed))}
    exact = Counter()
    for w, h in counted:
        exact.update((int(x), int(y)) for x, y in set(zip(h.view("i8").tolist(), w.text_of().tolist(), strict=True)))
    holding = Counter(h for h, _ in exact)
    for row, own in hashed.items():
        numbered += [Row(item=at[row], h=r.h, size=r.size, tail=r.tail, q=r.q, df=holding[r.h]) for r in own if holding[r.h]]
    block = lexical_search.Block.of(numbered, len(at), n_docs, n_words)
    names = {r.name: (r.doc_id, r.text) for r in lexical_search._named(frame).collect()}
    position = {}
    for w, _ in counted:
        for text, item, score in zip(*block.scores(w), strict=True):
            position[docs[w.first + text][1], int(item)] = int(score)
    above, total = 0, 0
    for shelf in shelves:
        for some, bound in block.bounds(shelf.asDict()):
            for k, name in enumerate(some.tolist()):
                own = np.array([position.get((names[name][1], i), 0) for i in range(block.items)])
                assert (bound[:, k] >= own).all()
                above += int((bound[:, k] > 2 * own + 1).sum())
                total += block.items
    assert sum(len(r.names) // 8 for r in shelves) == n_docs == len([1 for _, t in docs if _terms(t)])
    assert said and above < total / 3


def test_filter_holds_what_it_was_given(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("name"))
    bitmap, bits = lexical_search.named_filter(rows, "name")
    names = np.array([r.name for r in rows.collect()])
    assert bitmap[lexical_search._bucket(names, bits)].all()
    assert bitmap.sum() <= 5000 and 12 <= bits <= lexical_search.FILTER_BITS
    assert not lexical_search.named_filter(rows.limit(0), "name")[0].any()

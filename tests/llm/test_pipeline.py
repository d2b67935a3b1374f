"""The corpus pipeline against plain Python, stage by stage, with planted rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from gaugeflow.llm import language_id, queries, toxicity
from gaugeflow.llm.tables import held_out

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PASSAGE = "the benchmark asks which river runs past the old mill at dawn and why it floods in spring"


def _prose(rng, n):
    lexicon = ["".join(rng.choice(list("aeinrstlmo"), rng.integers(2, 9))) for _ in range(400)]
    said = [str(x) for x in rng.choice(lexicon, n)]
    return ". ".join(" ".join(said[k : k + 9]) for k in range(0, n, 9)) + "."


def _rows():
    rng = np.random.default_rng(11)
    rows = [(i, _prose(rng, 60 + i % 40)) for i in range(200)]
    toxic = {i for i in range(200) if i % 5 == 0}
    rows = [(i, f"{t} You are a vile toad and a rotten fool. {t}" if i in toxic else t) for i, t in rows]
    clean = [t for i, t in rows if i not in toxic]
    rows += [(1000 + k, clean[k]) for k in range(5)]  # copies
    rows += [(1, rows[1][1]), (1, rows[1][1])]  # rows that are repeated
    for k in range(5, 10):  # near copies
        said = clean[k].split(" ")
        rows.append((1000 + k, " ".join("changed" if j == 30 else w for j, w in enumerate(said))))
    rows += [(2000 + k, f"{clean[20 + k]} {PASSAGE}. {_prose(rng, 30)}") for k in range(4)]
    rows += [(2010, "short item here"), (2011, "A SHORT, item; here!"), (2012, f"{_prose(rng, 20)} {PASSAGE[:40]}")]
    rows += [(3000, None), (3001, ""), (3002, " 12 34 . !"), (3003, "x"), (None, _prose(rng, 50)), (3004, "word " * 5000)]
    return rows, toxic


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows, toxic = _rows()
    docs = [(i, t, "en" if (i or 0) % 2 else "de", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(200)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, PASSAGE), (2, "short item here"), (3, None), (4, "")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def _words(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


def _one_of_each_group(rows):
    def shingles(text):
        said = _words(text, r"[^\x20\x09-\x0D]+")
        return frozenset(tuple(said[k : k + 5]) for k in range(max(1, len(said) - 4))) if said else frozenset()

    sets = [shingles(t) for _, t in rows]
    home = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]) and home[i] != home[j]:
                a, b = home[i], home[j]
                home = [min(a, b) if h in (a, b) else h for h in home]
    groups = {}
    for k, h in enumerate(home):
        groups.setdefault(h if sets[k] else ("empty", k), []).append(rows[k])
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def _holds_an_item(text):
    said = _words(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for item in (PASSAGE, "short item here"):
        words = _words(item, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        size = min(10, len(words))
        windows = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
        if any(tuple(said[k : k + size]) in windows for k in range(len(said) - size + 1)):
            return True
    return False


def test_every_stage_keeps_what_a_plain_version_keeps(spark, place):
    rows = spark.read.parquet(f"{place}/documents.parquet")
    labels = spark.read.parquet(f"{place}/labels.parquet").where(~held_out())
    toxic = _rows()[1]

    model = toxicity.fit(rows, labels)
    scored = rows.select("doc_id", "text", toxicity.score("text", model).alias("s")).collect()
    wanted = [(r.doc_id, r.text) for r in scored if r.s < queries.TOXIC_SCORE]
    gone = {r.doc_id for r in scored if r.s >= queries.TOXIC_SCORE}
    assert gone == toxic  # planted ones go and no other

    kept, stages = rows, dict(corpus_pipeline.STAGES)
    plain = {
        "toxicity": lambda given: wanted,
        "language": lambda given: [r for r in given if any(c.isalpha() for c in r[1] or "")],
        "near_duplicates": _one_of_each_group,
        "decontamination": lambda given: [r for r in given if not _holds_an_item(r[1])],
    }
    given = [tuple(r) for r in rows.select("doc_id", "text").collect()]
    for name, version in plain.items():
        kept = stages[name](spark, kept, place)
        given = version(given)
        assert kept.columns == rows.columns
        got = Counter(tuple(r) for r in kept.select("doc_id", "text").collect())
        assert got == Counter(given), name
    assert {2000, 2001, 2002, 2003, 2010, 2011}.isdisjoint(d for d, _ in given) and 2012 in {d for d, _ in given}
    assert not {1000 + k for k in range(10)} & {d for d, _ in given}


def test_the_run_packs_what_the_stages_keep(spark, place):
    from tokenizers import Tokenizer

    kept = spark.read.parquet(f"{place}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, place)
    tokenizer = Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json"))
    wanted = Counter()
    for row in kept.collect():
        ids = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 0]
        for piece, k in enumerate(range(0, len(ids), 2048)):
            part = ids[k : k + 2048]
            wanted[row.doc_id, piece, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    packed = corpus_pipeline.run(spark, place).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == wanted
    filled = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048
    # No fewer sequences are possible, but for one.
    assert len(filled) <= -(-sum(filled.values()) // 2048) + 1


def test_languages_are_learned_from_the_texts(spark, place):
    model = language_id.fit(spark.read.parquet(f"{place}/documents.parquet").where(~held_out()))
    assert model.languages == ["de", "en"]

"""Streamed BPE against the tokenizers library, on whole texts and at every cut."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import bpe_stream, queries

PATH = queries.tokenizer("word_bpe_49k.json")
PARTS = [
    *"aabeinstthr'  \n.,!?013<|>", "İ", "İ!", "Σ", "é", "é", "́", "̧", "한", "ᅡ", "ᄀ",
    "<|endoftext|>", "<|startoftext|>", "<|endof", "'s", "'re", "'ll", "\x1c", "　", "\xa0", "中", "😀", "ß",
    "ﬁ", "Å", "٣", "Ᲊ", "՘", "Ⅰ",
]


@pytest.fixture(scope="module")
def codec():
    return bpe_stream.codec_of(PATH)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


def _ids(codec, text):
    return np.frombuffer(b"".join(codec.encoder.encode(text)), codec.merges.kind).tolist()


def _texts(seed, n, most, parts=PARTS):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_random_texts_equal_the_library(codec, library):
    texts = _texts(1, 20_000, 40)
    for text, wanted in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert _ids(codec, text) == wanted.ids, repr(text)
        decoded = "".join(t for _, t in codec.passes(text))
        assert decoded == library.decode(wanted.ids, skip_special_tokens=False), repr(text)


def test_every_character_equals_the_library(codec, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b" for c in points]
    wanted = library.encode_batch(texts, add_special_tokens=False)
    assert [hex(c) for c, t, w in zip(points, texts, wanted, strict=True) if _ids(codec, t) != w.ids] == []


@pytest.mark.parametrize("block", [1, 7, 300])
def test_long_stretches_are_streamed_exactly(codec, library, monkeypatch, block):
    monkeypatch.setattr(bpe_stream, "BLOCK", block)
    spaceless = [p for p in PARTS if not set(p) & set(" \n")]
    texts = _texts(block, 150, 900, spaceless) + _texts(block, 20, 4000, list("aeinst"))
    texts += ["a" * 5000, "!" * 5000, "ab" * 3000, "́" * 900, "é" * 900, "'" * 700 + "s" * 700, "  " * 900]
    for text in texts:
        assert _ids(codec, text) == library.encode(text, add_special_tokens=False).ids, repr(text[:80])


def test_tokens_leave_before_the_word_ends(codec):
    word = bpe_stream._Word(codec.merges)
    rng, given, most, got = random.Random(3), b"", 0, []
    for _ in range(4000):
        piece = "".join(rng.choice("aeinst") for _ in range(10)).encode()
        given += piece
        got += word.feed(piece)
        most = max(most, len(word.held))
    assert most <= 4 * codec.merges.lookahead + 74
    assert got + word.finish() == codec.merges.word(given.decode())


def test_lookahead_of_a_small_list():
    """With the list `b c`, `a b` a following c keeps a and b apart: two symbols stay open."""
    symbols = bpe_stream.byte_symbols()
    file = json.loads(open(PATH, encoding="utf-8").read())
    vocab = {s: i for i, s in enumerate([*symbols, *(s + "</w>" for s in symbols)])}
    for token in ("bc", "ab"):
        vocab[token] = len(vocab)
    file["model"] |= {"vocab": vocab, "merges": ["b c", "a b"]}
    file["added_tokens"] = []
    merges = bpe_stream.Merges(json.dumps(file))
    assert merges.ordered and merges.lookahead == 2
    assert [merges.texts[x] for x in merges.word("abcab")] == ["a", "bc", "a", "b</w>"]
    file["model"]["merges"] = ["a b", "b c"]
    assert bpe_stream.Merges(json.dumps(file)).lookahead == 1
    file["normalizer"] = None
    with pytest.raises(ValueError):
        bpe_stream.Merges(json.dumps(file))


def test_cut_characters_wait():
    texts = [*bpe_stream.byte_symbols(), "<|end|>"]
    raw = "é 한 😀".encode() + b"\xff\xe2\x82"
    decoder = bpe_stream.Decoder(texts, "ByteLevel")
    for size in (1, 2, 3, 50):
        ids = [*raw, 256] if size == 50 else list(raw)
        made = "".join([*(decoder.feed(ids[k : k + size]) for k in range(0, len(ids), size)), decoder.finish()])
        assert made == raw.decode("utf-8", "replace") + ("<|end|>" if size == 50 else "")


ROWS = [
    (0, None), (1, ""), (2, " \n\t"), (3, "a"), (4, "The <|endoftext|> İ!? end"), (5, "x" * 200_000), (6, "word " * 9000),
    (7, "same"), (7, "same"), (None, "no id"), (8, "wórd" * 3000),
]


def test_query_and_codec_tables(spark, tmp_path, library):
    rows = [(i, t, 0, "clash") for i, t in ROWS]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int, ids string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    wanted = Counter()
    for name, text in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        hexes = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), decoded.encode())]
        wanted[name, len(ids), *hexes] += 1
    got = queries.QUERIES["op11_bpe_codec"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(map(tuple, got.collect())) == wanted
    encoded = bpe_stream.encode_documents(docs, PATH)
    back = bpe_stream.decode_documents(encoded, PATH).select("doc_id", F.sha2("text", 256).alias("h"))
    assert Counter(map(tuple, back.collect())) == Counter((a, d) for (a, _, _, d) in wanted.elements())
    assert bpe_stream.digests(docs.limit(0), PATH).count() == 0


def test_given_documents_equal_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ids = {r.doc_id: list(r.ids) for r in bpe_stream.encode_documents(docs, PATH).collect()}
    for row in docs.collect():
        assert ids[row.doc_id] == library.encode(row.text or "", add_special_tokens=False).ids


def test_tables_of_a_worker_stay_small():
    """Two workers share an executor with a full heap, so the tables of each are bounded, and ids are the same without."""
    codec = bpe_stream.codec_of(queries.tokenizer("word_bpe_49k.json"))
    letters = "abcdefghijklmnopqrstuvwxyz"

    def word(i: int) -> str:
        return "".join(letters[i // 26**k % 26] for k in range(5))

    for first in range(0, 600_000, 40_000):
        codec.encoder.learn([word(i) for i in range(first, first + 40_000)])
    assert len(codec.encoder.table) <= 550_000 and len(codec.encoder.seen) <= 150_000
    texts = [f"{word(i)}, {word(i + 1).title()}. x{word(i)}!? .,; é{word(i)}," for i in range(599_000, 599_050)]
    fresh = bpe_stream.codec_of(queries.tokenizer("word_bpe_49k.json"))
    assert codec.encode_batch(texts) == [b"".join(fresh.encoder.encode(t)) for t in texts]


class _Counted(dict):
    asked = 0

    def get(self, *given):
        self.asked += 1
        return super().get(*given)


def test_texts_of_a_batch_look_each_stretch_up_once(library):
    """Work in Python is for each different word of a batch, whatever its case and the marks behind it."""
    codec = bpe_stream.codec_of(PATH)
    texts = ["Word other WORD*** word,\nOther. &&& " * 500] * 40
    codec.encoder.table = _Counted(codec.encoder.table)
    made = codec.encode_batch(texts)
    wanted = library.encode(texts[0], add_special_tokens=False).ids
    assert [np.frombuffer(raw, codec.merges.kind).tolist() for raw in made] == [wanted] * 40
    assert codec.encoder.table.asked < 100
    assert set(codec.encoder.table) == {"", "word", "other", ",", ".", "***", "&&&"}


def test_batches_equal_the_library(library, monkeypatch):
    codec = bpe_stream.codec_of(PATH)
    parts = [*PARTS, "***", "&&&", ".***", "'", "İ̧", "<|ENDOFTEXT|>", "<|endoftext|>", "_", " ", " ", "a" * 130]
    texts = ["", None, *_texts(11, 6000, 60, parts), None, "x" * 200_000 + " end", "<|endoftext|>" * 3, " ", "\n\n"]
    texts += ["Ab c*** " * 20_000, "word<|endoftext|> <|STARTOFTEXT|>\n" * 4000, "*" * 300 + " a" + "*" * 300, "É" * 90]
    wanted = [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for together in (bpe_stream.TOGETHER, 500):
        monkeypatch.setattr(bpe_stream, "TOGETHER", together)
        made = codec.encode_batch(texts)
        for text, raw, ids in zip(texts, made, wanted, strict=True):
            assert np.frombuffer(raw, codec.merges.kind).tolist() == ids, repr((text or "")[:200])
    assert codec.encode_batch([]) == [] and codec.encode_batch(["", None]) == [b"", b""]


def test_marks_behind_every_character_equal_the_library(library):
    codec = bpe_stream.codec_of(PATH)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}*. {chr(c)}," for c in points]
    made = codec.encode_batch(texts)
    wanted = library.encode_batch(texts, add_special_tokens=False)
    ids = [np.frombuffer(raw, codec.merges.kind).tolist() for raw in made]
    assert [hex(c) for c, x, w in zip(points, ids, wanted, strict=True) if x != w.ids] == []

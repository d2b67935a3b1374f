"""The corpus operators on small tables with every odd case, against brute force."""

from __future__ import annotations

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import (
    chat_format, decontamination, html_text, jaccard_join, language_id, packing, quality_rules, queries, sketch,
    token_files, tokens, toxicity, url_templates, words,
)

LOREM = "the quick brown fox jumps over the lazy dog while seven wizards mix potions near a quiet river bank"
ODD = [None, "", " ", "\n\t", "a", "A a\x0bA", "word " * 30, "x" * 5000, LOREM, LOREM, LOREM + " again", "É ß 你好   z"]
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, k string, name string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0, "clash", "clash") for i, t in enumerate(ODD)]
    rows += [(3, ODD[8], None, None, None, None, None), (None, LOREM, "en", "s", 1, "", ""), (8, ODD[8], "en", "s", 0, "", "")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_image_round_trip():
    rng = np.random.default_rng(1)
    for bits in (1, 5, 8, 13, 16, 17, 32):
        ids = rng.integers(0, 1 << min(bits, 31), 1001).astype(np.uint32)
        image = token_files.pack_image(ids, bits, block_ids=64)
        assert (token_files.read_ids(image) == ids).all()
        for first, last in ((0, 1), (63, 65), (100, 900), (1000, 1001), (5, 5), (990, 5000)):
            assert (token_files.read_ids(image, first, last) == ids[first:last]).all()
        assert len(token_files.read_ids(token_files.pack_image(ids[:0], bits))) == 0


def _reference_ids(name, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer(name))
    made = tokenizer.encode_batch(texts, add_special_tokens=False)
    return [[*x.ids, 0] for x in made]


def test_token_files_equal_brute_force(spark, docs, empty, tmp_path):
    path = str(tmp_path / "shards")
    token_files.write_shards(docs, path, queries.tokenizer("byte_bpe_50k.json"))
    got = token_files.document_digests(token_files.read_shards(spark, path)).collect()
    texts = _texts(docs)
    ids = _reference_ids("byte_bpe_50k.json", [t or "" for _, t in texts])
    wanted = Counter((d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (d, _), x in zip(texts, ids))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == wanted
    at = 0
    for row in sorted(got, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    none = str(tmp_path / "none")
    token_files.write_shards(empty, none, queries.tokenizer("byte_bpe_50k.json"))
    assert token_files.document_digests(token_files.read_shards(spark, none)).count() == 0


def test_random_texts_are_encoded_as_the_library_does():
    rng = np.random.default_rng(5)
    parts = [*"aabeinst  \n.,!?07<|>'", "  ", "\t", "İ", "İ!", "é", "é", "<|endoftext|>", " <|endoftext|>", "\n<|endoftext|>",
             "the ", " of", "中", "\x1c", "\x85", "　", "😀", "'ll", "Word. "]
    texts = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(20_000)]
    encoder = tokens.TextEncoder(queries.tokenizer("byte_bpe_50k.json"))
    wanted = _reference_ids("byte_bpe_50k.json", texts)
    for k in range(0, len(texts), 500):
        for text, raw, ids in zip(texts[k:], encoder.encode(texts[k : k + 500]), wanted[k:], strict=False):
            assert [*np.frombuffer(raw, encoder.kind).tolist(), 0] == ids, repr(text)


def test_encoder_cuts_and_forgets_rightly(monkeypatch):
    name = "byte_bpe_50k.json"
    monkeypatch.setattr(tokens, "CACHED_STRETCHES", 6)
    encoder = tokens.TextEncoder(queries.tokenizer(name))
    texts = [
        "a  b", "a\n\nb", " a", "a ", "\n\n\n a", "\t a", "x \t\n y", "", "\n", " ", "a\n", "don't stop\nit's!! ok",
        "a\x1cb \x85c", "É,, !?", "a b\x1c d", "one two three four five six seven eight", LOREM, "<|endoftext|> é\u0301",
    ]
    for batch in (texts, texts[::-1], texts[9:], [*texts, *texts]):
        got = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(batch)]
        assert [[*x, 0] for x in got] == _reference_ids(name, batch)
    assert encoder.encode([None]) == [b""]


def test_encoder_looks_up_letters_and_marks_apart(monkeypatch):
    name, stems = "byte_bpe_50k.json", ["vireie", "Éaiou", "x1", "ends"]
    texts = [" ".join(x + mark for x in stems) + "\n" + stems[0] + mark for mark in ("", ".", ",", "!?")] * 50
    encoder = tokens.TextEncoder(queries.tokenizer(name))
    met = []
    learned = encoder._learned
    monkeypatch.setattr(encoder, "_learned", lambda pieces: met.extend(pieces) or learned(pieces))
    got = [[*np.frombuffer(x, encoder.kind).tolist(), 0] for x in encoder.encode(texts)]
    assert got == _reference_ids(name, texts)
    # The first of a line, and those behind a space; marks behind a number stay with it.
    assert Counter(met) == Counter(["\nvireie", "Éaiou", "x1", "x1.", "x1,", "x1!?", "ends"])
    monkeypatch.setattr(tokens, "ALONE", 4)
    assert [[*np.frombuffer(x, encoder.kind).tolist(), 0] for x in encoder.encode(["", "a b", *texts])][2:] == got


def test_packing_encodes_as_the_library_does(spark):
    """Control strings are their ids, and a lowered letter may join the mark behind it."""
    texts = ["a <|endoftext|> b", "<|startoftext|>", "İ!? x", "aİ,", "İ.", "Σας ΟΔΟΣ", "é e\u0301", "x" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = packing.pack(docs, queries.tokenizer("word_bpe_49k.json"), with_ids=True).collect()
    ids = _reference_ids("word_bpe_49k.json", texts)
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == dict(enumerate(ids))


def test_packing_of_one_row_repeated_very_often(spark):
    docs = spark.createDataFrame([(1, LOREM)], "doc_id bigint, text string").crossJoin(spark.range(3000)).drop("id")
    rows = packing.pack(docs.repartition(4), queries.tokenizer("word_bpe_49k.json"), capacity=64).collect()
    places = {(r.sequence_id, r.offset) for r in rows}
    assert len(rows) == len(places) == 3000
    # Three of the 21 ids fit 64; a plan by lengths alone puts them there.
    size = rows[0].length
    assert len({r.sequence_id for r in rows}) == -(-3000 // (64 // size))


def test_packing_is_whole_and_gapless(docs, empty):
    rows = packing.pack(docs, queries.tokenizer("word_bpe_49k.json"), capacity=16).collect()
    texts = _texts(docs)
    ids = _reference_ids("word_bpe_49k.json", [t or "" for _, t in texts])
    wanted = Counter(
        (d, k // 16, k, len(x[k : k + 16]), zlib.crc32(np.array(x[k : k + 16], "<u4").tobytes()))
        for (d, _), x in zip(texts, ids) for k in range(0, len(x), 16)
    )
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    for sequence in {r.sequence_id for r in rows}:
        at = 0
        for row in sorted((r for r in rows if r.sequence_id == sequence), key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= 16
    assert packing.pack(empty, queries.tokenizer("word_bpe_49k.json")).count() == 0


def test_two_pieces_take_the_place_of_one():
    # Greedy fills 6 + 3 of 10; the 3 gives way to 2 + 2, so two bins hold all.
    plan = packing.packing_plan({6: 1, 3: 1, 2: 2, 5: 1}, 10)
    assert plan.bins == 2


def test_chat_round_trip(spark):
    part = chat_format.PART
    said = ["</s>[INST] ok [/INST]", "<|end|>", "<\\|x [\\INST] <\\\\|", "", "plain < [ text", "<"]
    rows = [(1, i, "assistant" if i % 2 else "us<|er", [("text", t, None, None)]) for i, t in enumerate(said)]
    rows += [(2, 0, "user", [("text", "see ", None, None), ("image", None, "a.png", 64), ("audio", None, "b.wav", None)]), (2, 1, None, None)]
    rows += [(None, None, "user", [("text", None, None, None)])]
    messages = spark.createDataFrame(rows, f"conv_id bigint, turn int, role string, parts array<{part}>")
    made = chat_format.format_conversations(messages)
    got = {r.conv_id: r for r in made.select("*", chat_format.read_turns(F.col("formatted")).alias("turns"), chat_format.loss_text(F.col("formatted"), F.col("loss")).alias("learned")).collect()}
    assert [t.text for t in got[1].turns] == said
    assert {t.role for t in got[1].turns} == {"us<|er", "assistant"}
    assert got[1].learned == "".join(said[1::2])
    assert [(a.kind, a.ref, a.tokens) for a in got[2].attachments] == [("image", "a.png", 64), ("audio", "b.wav", 1)]
    assert "<|image:0|><|audio:1|>" in got[2].formatted and got[2].attachment_tokens == 65
    assert [t.text for t in got[None].turns] == [""]
    assert chat_format.format_conversations(messages.limit(0)).count() == 0


def test_chat_parts_forge_nothing(spark):
    part = chat_format.PART
    cases = [
        ["<", "|end|>", "x"], ["<|", "end|>"], ["<\\", "|turn|>"], ["[", "INST]", "[/IN", "ST]"], ["<", "<SYS>", ">"],
        ["<|image:0|>", ("image", "a"), "<|image:0|>"], [("image", "a"), ("image", "b"), "<"], ["<", ("audio", "c"), "|end|>"],
        ["\x01a", ("image", "d"), "\x01t\x01", "\x01"], ["", ""], [("odd kind|>", "e")], ["<\\\\|", "x", "", "|>"],
    ]
    rows = []
    for i, case in enumerate(cases):
        made = [("text", p, None, None) if isinstance(p, str) else (p[0], None, p[1], 3) for p in case]
        rows += [(i, 0, "user", made), (i, 1, "assistant", made), (i, 2, "assistant", [("text", "end", None, None)])]
    messages = spark.createDataFrame(rows, f"conv_id bigint, turn int, role string, parts array<{part}>")
    read = chat_format.format_conversations(messages).select(
        "*", chat_format.read_messages(F.col("formatted")).alias("m"), chat_format.read_turns(F.col("formatted")).alias("t"),
        chat_format.loss_text(F.col("formatted"), F.col("loss")).alias("learned"),
    )
    for row in read.collect():
        wanted, number, plain = [], 0, ""
        for turn in range(2):
            parts = []
            for p in cases[row.conv_id]:
                if isinstance(p, str):
                    if parts and parts[-1][0] == "text":
                        parts[-1] = ("text", parts[-1][1] + p, None)
                    else:
                        parts.append(("text", p, None))
                else:
                    parts.append((re.sub("[^A-Za-z0-9_]", "_", p[0]), None, number))
                    number += 1
            wanted.append([p for p in parts if p[1] != ""])
        assert [t.role for t in row.m] == ["user", "assistant", "assistant"] and len(row.t) == 3
        assert [[tuple(p) for p in t.parts] for t in row.m] == [*wanted, [("text", "end", None)]]
        assert [a.ref for a in row.attachments] == 2 * [p[1] for p in cases[row.conv_id] if not isinstance(p, str)]
        said = "".join(p[1] or f"<|{p[0]}:{p[2]}|>" for p in wanted[1])
        assert row.learned == said + "end" and row.t[1].text == said


def test_toxicity_learns_sentences(spark, docs, empty):
    rows = [(i, f"Some note{i} of {LOREM}. {'You are a vile toad.' if i % 4 == 0 else 'Well met, friend.'} {LOREM}!") for i in range(400)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 400, 2)] + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(texts, labels)
    got = texts.select("doc_id", toxicity.score("text", model).alias("s"), toxicity.offending("text", model).alias("o")).collect()
    assert all((r.s >= 0.3) == (r.doc_id % 4 == 0) for r in got)
    assert all([x.text for x in r.o] == ["You are a vile toad"] for r in got if r.doc_id % 4 == 0)
    odd = docs.select("text", toxicity.score("text", model).alias("s")).collect()
    assert len(odd) == len(ODD) + 3 and all(0 <= r.s <= 1 for r in odd)
    assert all(r.s == 0 for r in odd if not (r.text or "").strip())
    assert not toxicity.fit(empty, labels).telling.size


def test_toxicity_fit_is_bounded_in_the_drivers_memory():
    kinds = np.arange(4000) % 2 == 0
    texts = pa.array([f"Note{i} of {LOREM}. {'You are a vile toad.' if bad else 'Well met, friend.'} {LOREM}!" for i, bad in enumerate(kinds)])
    tracemalloc.start()
    model = toxicity.fit_texts(texts, kinds, np.ones(4000), rounds=5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.telling.size and peak < 100e6


def test_long_texts_do_not_end_the_sample(spark):
    rows = [(i, f"Some note{i} of {LOREM}. {'You are a vile toad.' if i % 4 == 0 else 'Well met, friend.'}") for i in range(200)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id bigint, toxic int")
    first = labels.orderBy(F.xxhash64("doc_id"), "doc_id").first().doc_id
    long = "repeat(concat('A long, long note', doc_id, '. '), {})"
    got = texts.withColumn("text", F.when(F.col("doc_id") == first, F.expr(long.format(2 << 20))).otherwise(F.col("text")))
    model = toxicity.fit(got, labels)
    scored = texts.select("doc_id", toxicity.score("text", model).alias("s")).collect()
    assert all((r.s >= 0.3) == (r.doc_id % 4 == 0) for r in scored)
    one_kind = texts.withColumn("text", F.when(F.col("doc_id") % 4 == 0, F.expr(long.format(60_000))).otherwise(F.col("text")))
    model = toxicity.fit(one_kind.where("doc_id < 60"), labels)
    scored = texts.select("doc_id", toxicity.score("text", model).alias("s")).collect()
    assert model.telling.size and all(0 <= r.s <= 1 for r in scored)


def test_one_long_toxic_text_among_short_clean_ones(spark):
    rows = [(i, f"Some note{i} of {LOREM}. Well met, friend.") for i in range(40)]
    rows.append((40, "You are a vile toad. " * 80_000))
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i == 40)) for i in range(41)], "doc_id bigint, toxic int")
    scored = texts.select("doc_id", toxicity.score("text", toxicity.fit(texts, labels)).alias("s")).collect()
    assert len(scored) == 41 and all(0 <= r.s <= 1 for r in scored)


def test_noisy_or_equals_a_plain_version(spark, docs):
    """A document's score from the scores of its sentences, each scored as a document of its own."""
    rows = [(i, f"Note{i} of {LOREM}. {'You are a vile toad.' if i % 4 == 0 else 'Well met, friend.'}") for i in range(300)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    model = toxicity.fit(texts, labels)
    every = [t for _, t in rows[:20]] + [t for t in ODD if t] + ["vile toad? You are\nvile! a toad... are", "A vile." * 40]
    single = sorted({s for t in every for s in re.split(r"[.!?\n]", t)})
    frame = spark.createDataFrame([(s,) for s in [*single, *every]], "text string")
    got = {r.text: r.s for r in frame.select("text", toxicity.score("text", model).alias("s")).collect()}
    assert sum(got[s] > 0.3 for s in single) >= 3
    for text in every:
        left = 1.0
        for sentence in re.split(r"[.!?\n]", text):
            left *= 1 - got[sentence]
        assert abs(got[text] - (1 - left)) < 1e-5, text[:50]


def _counts(text):
    said = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(said[i : i + 8]) for i in range(len(said) - 7))
    hit = {j for i in range(len(said) - 7) if seen[tuple(said[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(said), sum(map(len, said)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_statistics_equal_brute_force(docs, empty, sf_dir, spark):
    more = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for rows in (docs, more):
        got = quality_rules.with_statistics(rows).collect()
        wanted = Counter((r.doc_id, *_counts(r.text)) for r in rows.collect())
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == wanted
    assert quality_rules.judge(empty, []).count() == 0


def test_samples_bound_rows_of_one_id(spark, monkeypatch):
    rows = [(1, f"{LOREM} one{i} stays.") for i in range(300)] + [(i, f"{LOREM} two{i} goes.") for i in range(2, 30)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 30)], "doc_id bigint, toxic int, quality int")
    seen = []
    monkeypatch.setattr(toxicity, "fit_texts", lambda column, toxic, weight: seen.append(toxic))
    monkeypatch.setattr(quality_rules, "learn_rules", lambda table, bad: seen.append(bad))
    toxicity.fit(texts, labels, sample_rows=40)
    quality_rules.fit(texts, labels, sample_rows=40)
    assert [(sorted(Counter(x.tolist()).values())) for x in seen] == [[14, 40]] * 2


def test_rules_cover_what_is_bad():
    rng = np.random.default_rng(0)
    table = {"upper_share": rng.random(600), "mark_share": rng.random(600)}
    bad = (table["upper_share"] > 0.8) | (table["mark_share"] > 0.9)
    rules = quality_rules.learn_rules(table, bad)
    covered = np.any([quality_rules._covers(r, table) for r in rules], axis=0)
    assert (covered == bad).mean() > 0.97 and not (covered & ~bad).sum() > 6
    assert quality_rules.learn_rules(table, np.zeros(600, bool)) == []


PAGE = """<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>menu</ul></nav>
<div class="cookie-notice">We use cookies, really.</div><article><h1>A  title</h1><p>First &amp; <b>bold</b> text, with words.<br>
<p>Second paragraph, it is longer &eacute; and has marks; many.<script>var a="</p>";</script><ul><li>one<li>two</ul></article>
<div class="comments"><p>I disagree, strongly, with all of it.</p></div><!-- x --><aside>side</aside><footer>foot</footer>"""


def test_main_text():
    wanted = ["A title", "First & bold text, with words.", "Second paragraph, it is longer é and has marks; many.", "one", "two"]
    assert html_text.extract(PAGE) == "\n\n".join(wanted)
    assert [html_text.extract(x) for x in (None, "", "<p", "<!-- ", "<nav>x</nav>")] == ["", "", "<p", "", ""]
    assert html_text.extract("<div>" * 2000 + "deep, text.") == "deep, text."


@pytest.mark.parametrize("around", ["<font>{}</font>", "<a name=top>{}", "<b>{}", "<span class=x>{}</span>"])
def test_open_inline_tag_around_content(around):
    said = ["First, a text.", "Second, with bold, text."]
    content = "<div class=content><p>First, a text.</p><p>Second, with <b>bold</b>, text.</p></div>"
    page = f"<html><body>{around.format(content)}</body></html>"
    assert html_text.extract(page) == "\n\n".join(said)


LONG = [f"Paragraph {i} says, at some length, what there is to say; it has marks, words and an end." for i in range(10)]
BODY = "<div class=body>" + "".join(f"<p>{x}</p>" for x in LONG) + "</div>"
LINKS = "<ul class=more>" + "".join(f"<li><a href=/{i}>Another story {i}</a>" for i in range(5)) + "</ul>"


@pytest.mark.parametrize(
    ("page", "before", "after"),
    [
        (f"<body><nav>x</nav><article><h1>Title</h1><p class=lead>short</p>{BODY}<figure><figcaption>Cap</figcaption></figure></article>{LINKS}", ["Title", "short"], ["Cap"]),
        (f"<body><main><h1>Title</h1><article><p class=lead>short</p>{BODY}</article></main><footer>x</footer>", ["Title", "short"], []),
        (f"<body><nav>x</nav><div class=post><h1>Title</h1><div class=share>Share</div><div><p class=lead>short</p>{BODY}</div><ul class=list><li>one</ul></div>{LINKS}", ["Title", "short"], ["one"]),
        (f"<body><div class=all><h1>Title</h1><p class=lead>short</p>{BODY}{LINKS}</div><p class=legal>All rights reserved.</p>", ["Title", "short"], []),
    ],
)
def test_whole_nested_article(page, before, after):
    assert html_text.extract(page).split("\n\n") == [*before, *LONG, *after]


ARTICLE = f"<article><h1>Title</h1>{BODY}</article>"
COMMENTS = "<p>" + "I disagree, strongly, with all of it. " * 60 + "</p>"


@pytest.mark.parametrize(
    "page",
    [
        *(f"<body><div {x}>{ARTICLE}{LINKS}</div>" for x in ("class='page with-sidebar'", "class=no-sidebar", "id='menu-content'", "class='search widget'")),
        f"<body><nav>x</nav><div class='page sidebar'><h1>Title</h1>{BODY}</div>",
        f"<body><article><div class='entry-header'><h1>Title</h1></div>{BODY}</article>",
        f"<body><article><div class='header'><h1>Title</h1></div>{BODY}<div class=share>Share it</div></article><div class=header><h1>Site</h1></div>",
        f"<body><div class=post><div class='post-header'><h1>Title</h1></div>{BODY}</div><div class=sidebar><p>Aside, a text.</div>",
        f"<body>{ARTICLE}<div class=comments><article class=comment>{COMMENTS}</article></div>",
        f"<body><div class=all><h1>Title</h1>{BODY}</div><div id=comments><article class=comment-body>{COMMENTS}</article></div>",
        f"<body>{ARTICLE}<div class=related><article class=card><a href=/x>Other, a story.</a></article></div>",
    ],
)
def test_names_leave_out_no_content(page):
    assert html_text.extract(page).split("\n\n") == ["Title", *LONG]


def _shingles(text, size):
    said = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not said:
        return frozenset()
    return frozenset(tuple(said[i : i + size]) for i in range(max(1, len(said) - size + 1))) if len(said) >= size else frozenset([tuple(said)])


def _brute_components(texts, size, num, den):
    sets = [_shingles(t, size) for _, t in texts]
    home = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]) and home[i] != home[j]:
                a, b = home[i], home[j]
                home = [min(a, b) if h in (a, b) else h for h in home]
    ids = {}
    for h, (d, _) in zip(home, texts):
        ids.setdefault(h, []).append(d)
    return Counter(
        (d, len(s), min((x for x in ids[h] if x is not None), default=None) if s else d)
        for (d, _), s, h in zip(texts, sets, home)
    )


def test_jaccard_join_equals_brute_force(spark, docs, empty, monkeypatch):
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in range(120)]
    rows = [(100 + i, " ".join(b if rng.random() > p else f"e{rng.integers(9)}" for b in base)) for i, p in enumerate([0, 0.004, 0.01, 0.02] * 20)]
    many = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"))
    for leaf, partners in ((256, (1,)), (16, (1, 4)), (3, ())):  # small ones make regions recurse
        monkeypatch.setattr(jaccard_join, "LEAF", leaf)
        monkeypatch.setattr(jaccard_join, "PARTNERS", partners)
        got = jaccard_join.jaccard_join(many, size=3, num=90, den=100).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == _brute_components(_texts(many), 3, 90, 100)
    assert jaccard_join.jaccard_join(empty).count() == 0


def test_one_document_of_each_group_stays(docs):
    joined = jaccard_join.jaccard_join(docs).cache()
    kept = sketch.without(docs, jaccard_join.repeats(joined))
    assert kept.columns == docs.columns
    wordless = [x for x in ODD if not _shingles(x, 5)]
    groups = {r.group for r in joined.collect()} - {None}
    assert kept.count() == len(wordless) + len(groups)


def test_url_verdicts(spark):
    urls = [None, "no scheme", "http://A.Com/x?y", "https://www.example.com/en/1#a", "http://sub.example.com/en/2", "http://x.net/es/3", "http://x.net", "http://x.net/de/4"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(7, urls[7])], "page_id bigint, url string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_templates.judge(pages, queries.URL_RULES).collect() if r.page_id < 6)
    assert [x[1:] for x in got] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("a.com", "/x", "com/", "allow"),
        ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("sub.example.com", "/en/2", "example.com/en/", "block"),
        ("x.net", "/es/3", "net/es/", "block"),
    ]
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "page_id bigint, bad int")
    more = spark.createDataFrame([(i, f"http://h.org/{'ab'[i % 2]}/{i}") for i in range(120)], "page_id bigint, url string")
    judged = url_templates.judge(more, [], labels).collect()
    assert len(judged) == 120 and all(r.verdict == ("block" if r.page_id % 2 else "allow") for r in judged)
    assert url_templates.judge(pages.limit(0), queries.URL_RULES).count() == 0


BROKEN_PAGES = {
    "nested": lambda n: "<div>" * n + "<p>" + "Some text, more. " * 20 + "</p>",
    "unclosed": lambda n: "<div><p>Some text, and more of it. " * n,
    "cut off": lambda n: "<p>Some text.</p>" + "<a " * n,
    "menus": lambda n: "<div class=menu>Some text, more. " * n,
    "quotes": lambda n: "<p>Some text.</p>" + '<a "' * n + ">",
    "comments": lambda n: "<!--" * n,
    "scripts": lambda n: "<script>" + "</scrip>" * n,
    "declarations": lambda n: "<!a " * n,
    "lists": lambda n: "<ul><li>Some text, more. " * n,
}


@pytest.mark.parametrize("kind", BROKEN_PAGES)
def test_broken_pages_take_time_for_their_length(kind):
    import time

    def seconds(n):
        page = BROKEN_PAGES[kind](n)
        started = time.process_time()
        html_text.extract(page)
        return time.process_time() - started

    seconds(1000)
    short, long = min(seconds(6000) for _ in range(3)), min(seconds(48_000) for _ in range(2))
    # Eight times the length; a square would take 64 times as long.
    assert long < 24 * short + 0.05


def test_hidden_parts_and_attribute_values():
    body = "<p>" + "Words of the article, and more of them. " * 10 + "</p>"
    page = f"""<article>{body}<div hidden>secret one</div><div style="color:red; display: none">secret two</div>
    <div data-x="hidden">shown one</div><div title='class="menu"'>shown two</div><div class="a hidden-b">shown three</div>
    <p HIDDEN>secret three</p><section style='visibility:hidden'><p>secret four</p></section></article>"""
    got = html_text.extract(page)
    assert "secret" not in got and all(f"shown {n}" in got for n in ("one", "two", "three"))


def test_url_templates_of_any_depth(spark):
    """Labels that differ at the fifth segment, and at the fortieth."""
    deep = "/".join("abcdefghij" * 4)
    urls = [f"http://h.org/a/b/c/d/{'ab'[i % 2]}/x" for i in range(200)]
    urls += [f"http://k.org/{deep}/{'ab'[i % 2]}/x{i}" for i in range(200)] + ["http://k.org/" + "s/" * 400]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 400) if i % 10 < 6], "page_id bigint, bad int")
    got = {r.page_id: r.verdict for r in url_templates.judge(pages, [], labels).collect()}
    assert len(got) == 401
    assert all(got[i] == ("block" if i % 2 else "allow") for i in range(400))


def test_url_labels_reach_other_hosts(spark):
    """A host without labels is judged by its templates elsewhere, and one with labels by its own."""
    urls = [f"http://h{i % 7}.org/{'spam' if i % 2 else 'news'}/p{i}" for i in range(140)]
    urls += [f"http://fresh.net/{kind}/q{i}" for i in range(5) for kind in ("spam", "news")]
    urls += [f"http://own.net/spam/r{i}" for i in range(40)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    known = [(i, i % 2) for i in range(140)] + [(150 + i, 0) for i in range(40)]
    labels = spark.createDataFrame(known, "page_id bigint, bad int")
    rows = url_templates.judge(pages, [], labels).collect()
    got = {(r.host, r.path.split("/")[1]): r.verdict for r in rows}
    assert got["fresh.net", "spam"] == "block" and got["fresh.net", "news"] == "allow"
    assert got["own.net", "spam"] == "allow" and got["h3.org", "spam"] == "block"
    assert len(rows) == len(urls)
    assert {r.verdict for r in url_templates.judge(pages, [], labels.limit(0)).collect()} == {"allow"}


def _plain_templates(urls):
    """host, path -> template: level by level, with rare segments of crowded branches as wildcards."""
    paths = Counter(urls)
    made = {}
    for host, path in paths:
        cut = re.sub("^/", "", path).split("/")
        made[host, path] = tuple("*" if re.search(r"[0-9]|^[0-9A-Fa-f-]{16,}$", s) else s for s in cut)
    for level in range(max(map(len, made.values()), default=0)):
        held = Counter()
        for key, template in made.items():
            if len(template) > level:
                held[key[0], template[:level], template[level]] += paths[key]
        total, children = Counter(), Counter()
        for (host, branch, _), n in held.items():
            total[host, branch] += n
            children[host, branch] += 1
        for key, template in made.items():
            if len(template) > level:
                at = key[0], template[:level]
                if children[at] > 20 and held[*at, template[level]] < 0.05 * total[at]:
                    made[key] = (*template[:level], "*", *template[level + 1 :])
    return made


def test_url_templates_equal_a_plain_version(spark, sf_dir):
    rng = np.random.default_rng(4)
    words_ = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8)]
    urls = [(f"h{rng.integers(3)}.org", "/" + "/".join(rng.choice(words_[: [3, 64, 5, 40][k]]) for k in range(rng.integers(1, 5)))) for _ in range(1500)]
    given = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        url_templates.host_of(F.col("url")).alias("host"), url_templates.path_of(F.col("url")).alias("path")
    )
    for rows in (urls, [tuple(r) for r in given.collect()]):
        frame = spark.createDataFrame([(h, p, n) for (h, p), n in Counter(rows).items()], "host string, path string, n bigint")
        got = {(r.host, r.path): tuple(r.template) for r in url_templates.path_templates(frame).collect()}
        assert got == _plain_templates(rows)


def test_phrases_equal_brute_force():
    texts = {"aa": ["abababa cabab"], "bb": ["xyzzy zyx xy"]}
    model = language_id.fit_texts(texts)
    tried = ["abab", "xyzzy", "ba c xy", "q", "a", ""]
    phrases, sizes = language_id.parse(pa.array(tried), model)
    for row, kind in enumerate(model.languages):
        sample = " " + texts[kind][0]
        for i, text in enumerate(tried):
            n, at = 0, 0
            while at < len(text):
                size = 1
                while at + size <= len(text) and text[at : at + size] in sample:
                    size += 1
                at += max(1, size - 1)
                n += 1
            assert not sizes[i] or phrases[row, i] == n, (kind, text)


def _plain_phrases(sample, text):
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at : at + size] in sample:
            size += 1
        at += max(1, size - 1)
        n += 1
    return n


@pytest.mark.parametrize(("stretch", "kept"), [(512, 1 << 22), (7, 1 << 22), (7, 40), (1, 1), (16, 64)])
def test_phrases_go_on_over_stretches(monkeypatch, stretch, kept):
    monkeypatch.setattr(language_id, "STRETCH", stretch)
    monkeypatch.setattr(language_id, "KEPT_STATES", kept)
    rng = np.random.default_rng(stretch)
    said = lambda letters, n: "".join(rng.choice(list(letters), n)).strip() or "a"
    texts = {"aa": [said("ab ", 300)], "bb": [said("abc ", 300)], "zh": [said("一二三四五六七八九十", 300)]}
    texts = {k: [re.sub(" +", " ", t) for t in ts] for k, ts in texts.items()}
    model = language_id.fit_texts(texts)
    tried = [re.sub(" +", " ", said(a, n)) for a in ("ab ", "abc ", "一二三四", "ax") for n in (1, 6, 7, 8, 50, 400)] + ["", None]
    tried.append(texts["aa"][0] * 4)
    phrases, _ = language_id.parse(pa.array(tried), model)
    for row, kind in enumerate(model.languages):
        sample = " " + texts[kind][0]
        assert phrases[row].tolist() == [_plain_phrases(sample, t or "") for t in tried], kind


SCRIPTS = {
    "de": "abcdefghijklmnopqrstuvwxyzäöüß", "en": "abcdefghijklmnopqrstuvwxyz", "el": "αβγδεζηθικλμνξοπρστυφχψω",
    "ru": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "he": "אבגדהוזחטיכלמנסעפצקרשת", "ar": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "hi": "अआइईउऊएऐओऔकखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह", "ja": "".join(map(chr, range(0x3042, 0x3094))),
    "ko": "".join(map(chr, range(0xAC00, 0xAC00 + 3000, 5))), "zh": "".join(map(chr, range(0x4E00, 0x4E00 + 2500))),
}


def test_ten_scripts(spark):
    rng = np.random.default_rng(8)
    rows = []
    for kind, letters in SCRIPTS.items():
        lexicon = ["".join(rng.choice(list(letters), rng.integers(2, 7))) for _ in range(150)]
        rows += [(kind, " ".join(rng.choice(lexicon, 60))) for _ in range(50)]
    docs = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(rows)], "doc_id bigint, text string, lang string")
    # One text that takes a third of all rows must not be all that a language is learned from.
    docs = docs.unionByName(spark.createDataFrame([(0, "un mot", "de")], docs.schema).crossJoin(spark.range(250)).drop("id"))
    model = language_id.fit(docs)
    assert len(model.languages) == 10
    named = docs.where("text <> 'un mot'").select("lang", language_id.identify("text", model).alias("n"))
    right = named.groupBy("lang").agg(F.count_if(F.col("n.lang_pred") == F.col("lang")).alias("r")).collect()
    assert {r.lang: r.r for r in right} == dict.fromkeys(SCRIPTS, 50)


def test_bytes_that_are_no_text(spark):
    rows = spark.sql("SELECT cast(x'61FF62' AS string) AS text UNION ALL SELECT 'ab' UNION ALL SELECT cast(x'FFFE' AS string)")
    model = language_id.fit_texts({"aa": ["ab ab"]})
    got = rows.select(language_id.identify("text", model).alias("n")).collect()
    assert [r.n.lang_pred for r in got] == ["aa", "aa", "und"]


def test_languages_held_out(spark, docs, empty, sf_dir):
    rows = queries.op9_language_id(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id").where("held_out")
    assert rows.where("lang = lang_pred").count() >= 0.95 * rows.count()
    model = language_id.fit(docs)
    odd = docs.select("text", language_id.identify("text", model).alias("n")).collect()
    assert all((r.n.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in odd)
    assert language_id.fit(empty).languages == []


def test_decontamination_of_odd_rows(spark, docs, empty):
    items = spark.createDataFrame([(1, LOREM), (1, LOREM), (2, "a"), (3, None), (4, ""), (None, "again")], "item_id bigint, text string")
    got = {(r.doc_id, r.k): r for r in decontamination.contamination(docs, items).collect()}
    rows = decontamination.contamination(docs, items)
    assert rows.count() == docs.count()
    by_id = {r.doc_id: r for r in rows.where("doc_id in (4, 5, 9, 10)").collect()}
    assert (by_id[4].n_hit, by_id[4].item_ids) == (1, "2") and by_id[5].n_hit == 3
    assert (by_id[9].n_hit, by_id[9].n_words, by_id[9].item_ids) == (19, 19, "1,2")
    assert (by_id[10].n_hit, by_id[10].item_ids) == (20, "1,2")
    assert len(got) >= len(ODD)
    assert not decontamination.contamination(docs, items.limit(0)).where("contaminated").count()
    assert decontamination.contamination(empty, items).count() == 0


def test_words_and_hashes():
    column = pa.array(["Ab cd\tab", None, "ab", "", "longer-than-eight-bytes x"])
    (block,) = words.blocks(column, words.SPACED_LOWER)
    h = block.hashes()
    assert block.of.tolist() == [0, 3, 3, 4, 4, 6] and h[0] == h[2] == h[3] and len(set(h.tolist())) == 4
    assert hashlib.sha256(b"").hexdigest()  # digests of no items are those of the empty text


def test_sql_twins(spark, sf_dir):
    import compare

    for name, twin in queries.oracle_sql().items():
        assert compare.differences(queries.QUERIES[name](spark, sf_dir), compare.connect(sf_dir).execute(twin))[:3] == []


def test_pipeline_stages(spark, sf_dir, docs, empty):
    import corpus_pipeline

    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, rows, sf_dir)
        assert kept.columns == docs.columns and kept.exceptAll(rows).count() == 0, name
        rows = kept
        assert stage(spark, empty, sf_dir).count() == 0
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_language_stage_without_languages(spark, docs):
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)["language"]
    fold = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    lettered = Counter((d, t) for d, t in _texts(docs) if any(c.isalpha() for c in t or ""))
    for lang in (F.lit(None).cast("string"), F.when(fold, F.col("lang"))):
        given = docs.withColumn("lang", lang)
        kept = stage(spark, given, "")
        assert Counter(_texts(kept)) == lettered and kept.columns == docs.columns


def test_a_cluster_of_near_copies_takes_few_comparisons(spark, monkeypatch):
    """Pairs grow with the sets of a cluster and not with their square."""
    base = [f"w{x}" for x in range(120)]
    counts = {}
    staged = jaccard_join.session.stage

    def counting(rows, purpose, *by):
        made = staged(rows, purpose, *by)
        if purpose == "pairs":
            counts[n] = counts.get(n, 0) + made.count()
        return made

    monkeypatch.setattr(jaccard_join.session, "stage", counting)
    for n in (300, 1200):
        rows = [(i, " ".join(f"x{i}" if k == i % 110 + 3 else w for k, w in enumerate(base))) for i in range(n)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
        got = jaccard_join.jaccard_join(docs, size=3, num=90, den=100).collect()
        assert len(got) == n and {r.component_id for r in got} == {0}
    assert counts[1200] <= 6 * counts[300] and counts[1200] <= 20 * 1200


def test_sets_that_share_a_shingle_by_chance_leave_their_region(spark):
    """Of a region only sets stay that can link with another one for sizes and places."""
    rows = [(1, 7, 100, 0), (1, 8, 100, 1), (1, 9, 300, 0), (1, 10, 100, 30), (2, 7, 100, 0), (2, 8, 120, 0), (3, 7, 50, 0)]
    homes = spark.createDataFrame(rows, "region bigint, name bigint, n bigint, pos int")
    left = jaccard_join._regions(homes, 90, 100).collect()
    assert sorted((r.region, r.name) for r in left) == [(1, 7), (1, 8)]


def test_long_sets_are_compared_only_if_wide_parities_allow(spark):
    """512 buckets tell nothing of sets of 5000 shingles; sets without wide parities are compared as before."""
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64)) for _ in range(3)]
    sets.append(np.concatenate([sets[0][:4900], sets[1][:100]]))
    assert all(len(x) >= jaccard_join._wide_from(90, 100) for x in sets)
    for wide, pairs in ((True, [(0, 3)]), (False, [(i, k) for k in range(4) for i in range(k)])):
        rows = [
            (1, i, len(x), 0, i, *jaccard_join.parities(x).tolist(), jaccard_join.parities(x, 4096).tobytes() if wide else None)
            for i, x in enumerate(sets)
        ]
        odd = ", ".join(f"{c} bigint" for c in jaccard_join.PARITY_COLUMNS)
        given = spark.createDataFrame(rows, f"region bigint, name bigint, n bigint, pos int, c bigint, {odd}, wide binary")
        found = jaccard_join._stars(given, None, 90, 100).where("a <> b").collect()
        assert sorted((r.a, r.b) for r in found) == sorted(pairs)

"""Operator 9, language identification by cross-parsing.

For each language a suffix automaton is built over a bounded sample of its labelled text.
A text is parsed against it from left to right into phrases, each the longest stretch from
there on that the sample holds. The fewer phrases a language needs, the closer it is: the
number of phrases times the bits that point into the sample, per letter of the text, is
the cross-entropy, and the language with the least of it wins. Ties go to the language
that comes first by name.

Letters are lowered, all else is one mark between words. Every letter of any sample is a symbol of
its own, whatever the number of scripts; a letter that no sample of a language holds is a
phrase of its own there. Transitions of all automata lie in one array: a state is a place in
it, and its transition by a symbol is found so many places further, if it belongs to it.

Texts are cut into stretches of STRETCH letters that are parsed side by side, each as if a phrase
began with it. Then each is parsed again from where the one before has ended, until it
meets its first parse; from there on both are the same, so phrases are exact.

A language is learned from SAMPLE_LETTERS letters, whatever the number of languages, of at
most SAMPLE_ROWS different texts, and from no text more than a part in SAMPLE_SHARE of them. Equal
beginnings of texts count once, so no repeated row or id takes the place of others.

The score is the winner's share if every language counts 2 to the minus bits / SOFTEN.
A null text, or one without letters, is `und` with score 0. Texts are parsed whole. If no
language could be learned, every text is `und`. Bytes that are no UTF-8 are no letters. Rows with the same doc_id stay apart. An
empty table gives no rows, other columns are not read.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import words
from gaugeflow.llm.tables import bounded_sample, give_back

#: Letters that a language is learned from, texts that they come from, and the share of one text.
SAMPLE_LETTERS, SAMPLE_ROWS, SAMPLE_SHARE = 20_000, 200, 10
STRETCH = 512
#: States that are kept of a block at a time, over all languages.
KEPT_STATES = 1 << 22
SOFTEN = 16.0
UNKNOWN = "und"
GAP, OTHER = 0, 1
_TARGET = (1 << 32) - 1


@dataclass
class Model:
    """`moves[state + symbol]` holds the state that owns the transition, and where it leads.

    `start` is the state of each language after the first symbol of a phrase, `none` that before it.
    """

    languages: list[str]
    symbol_of: np.ndarray
    moves: np.ndarray
    start: np.ndarray
    none: np.ndarray
    bits: np.ndarray


def _suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in text:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in moves[p]:
            moves[p][symbol] = state
            p = link[p]
        if p >= 0:
            q = moves[p][symbol]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(symbol) == q:
                    moves[p][symbol] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return moves


class _Places:
    """One array for the transitions of many states, each at its own place plus the symbol."""

    def __init__(self, symbols: int):
        self.symbols, self.gap = symbols, 0
        self.taken, self.owned = bytearray(4 * symbols), bytearray(4 * symbols)

    def place(self, symbols: list[int]) -> int:
        """A place of no other state from which all symbols fall on free members."""
        first, taken, owned = symbols[0], self.taken, self.owned
        at, tries = max(self.gap, first), 0
        while True:
            at = taken.find(0, at)
            if at < 0 or at + 2 * self.symbols > len(taken):
                at = max(at, 0) or len(taken) - 2 * self.symbols
                taken.extend(bytes(len(taken)))
                owned.extend(bytes(len(owned)))
                continue
            base = at - first
            if not owned[base] and not any(taken[base + s] for s in symbols):
                break
            at += 1
            tries += 1
        if tries > 16:
            # What is left before here is too narrow for most.
            self.gap = max(self.gap, at - 16)
        for s in symbols:
            taken[base + s] = 1
        owned[base] = 1
        return base

    def beyond(self) -> int:
        """From here on nothing is taken, and no state of before has its place."""
        return len(self.taken.rstrip(b"\0")) + 2 * self.symbols


def _packed(automata: list[list[dict[int, int]]], symbols: int) -> tuple[np.ndarray, list[list[int]], list[int]]:
    """The transitions of all automata as one array, the places of their states, and one of no state each.

    States with several transitions are fitted into each other. Those with one follow, in the order
    of the symbol: each on the next member, and as many left out as the symbol has grown by.
    """
    places = _Places(symbols)
    bases = [[0] * len(moves) for moves in automata]
    single: list[tuple[int, int, int]] = []
    for a, moves in enumerate(automata):
        for state in sorted(range(len(moves)), key=lambda k: -len(moves[k])):
            if len(moves[state]) > 1:
                bases[a][state] = places.place(sorted(moves[state]))
            elif moves[state]:
                single.append((next(iter(moves[state])), a, state))
    at, before = places.beyond(), 0
    for symbol, a, state in sorted(single):
        at += symbol - before
        bases[a][state] = at - symbol
        at, before = at + 1, symbol
    nones = []
    at += symbols
    for a, moves in enumerate(automata):
        for state, to in enumerate(moves):
            if not to:
                bases[a][state] = at = at + 1
        at += 1
        nones.append(at)
    packed = np.full(at + symbols + 1, -1 << 32, np.int64)
    for moves, own in zip(automata, bases, strict=True):
        for state, to in enumerate(moves):
            base = own[state]
            for symbol, target in to.items():
                packed[base + symbol] = base << 32 | own[target]
    return packed, bases, nones


def letters_table(letters: list[str]) -> np.ndarray:
    """Symbol of each code point: the gap, another letter, or one of the letters, lowered."""
    table = np.zeros(sys.maxunicode + 1, np.int32)
    known = {x: k + 2 for k, x in enumerate(letters)}
    for point in range(len(table)):
        if unicodedata.category(chr(point))[0] == "L":
            table[point] = known.get(chr(point).lower(), OTHER)
    return table


def _symbols(block: words.Words, symbol_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, gaps run together and cut off at both ends, and offsets of the texts."""
    head = (block.raw & 0xC0) != 0x80
    points = np.frombuffer(block.raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    offsets = np.concatenate([[0], np.cumsum(head)])[block.offsets]
    if len(points) != offsets[-1]:
        raise ValueError("text is not valid UTF-8")
    symbol = symbol_of[points]
    first = np.zeros(len(symbol) + 1, bool)
    first[offsets] = True
    before = np.concatenate([[GAP], symbol[:-1]])
    keep = (symbol != GAP) | ((before != GAP) & ~first[:-1])
    counted = np.concatenate([[0], np.cumsum(keep)])
    return symbol[keep], counted[offsets]


def _stepped(model: Model, language: np.ndarray, state: np.ndarray, symbol: np.ndarray):
    """The next states, and where a phrase has ended before the symbol."""
    found = model.moves[state + symbol]
    ended = (found >> 32) != state
    return np.where(ended, model.start[language, symbol], found & _TARGET), ended


def _phrases_of(symbol: np.ndarray, size: np.ndarray, model: Model) -> np.ndarray:
    """Phrases of texts that lie one after the other, by language."""
    n_languages = len(model.languages)
    lanes = -(-size // STRETCH)
    first = np.concatenate([[0], np.cumsum(lanes)])
    offsets = np.concatenate([[0], np.cumsum(size)])
    text = np.repeat(np.arange(len(size)), lanes)
    rank = np.arange(first[-1]) - first[text]
    begin = offsets[text] + rank * STRETCH
    length = np.minimum(size[text] - rank * STRETCH, STRETCH)
    counts = np.zeros((n_languages, first[-1]), np.int64)
    language = np.arange(n_languages)[:, None]
    carried = model.none.copy()
    wide = max(1, KEPT_STATES // (STRETCH * max(1, n_languages)))
    for a in range(0, first[-1], wide):
        b = min(a + wide, first[-1])
        own, at, goes_on = length[a:b], begin[a:b], rank[a:b] > 0
        order = np.argsort(-own, kind="stable")
        longest = int(own.max())
        states = np.zeros((longest, n_languages, b - a), np.int32)
        ends = np.zeros((longest, n_languages, b - a), bool)
        state = np.repeat(model.none[:, None], b - a, axis=1)
        active = np.searchsorted(-own[order], -np.arange(longest), "left")
        for j in range(longest):
            now = order[: active[j]]
            state[:, now], ends[j][:, now] = _stepped(model, language, state[:, now], symbol[at[now] + j])
            states[j][:, now] = state[:, now]
        # Again from where the stretch before has ended, as long as that makes a difference.
        before = np.concatenate([carried[:, None], state[:, :-1]], axis=1)
        kind, lane = np.nonzero((before != model.none[:, None]) & goes_on)
        while len(lane):
            true = before[kind, lane].astype(np.int64)
            changed = np.zeros((n_languages, b - a), bool)
            for j in range(int(own[lane].max())):
                true, over = _stepped(model, kind, true, symbol[at[lane] + j])
                same = true == states[j, kind, lane]
                ends[j, kind, lane] = over
                states[j, kind, lane] = true
                last = ~same & (own[lane] == j + 1)
                state[kind[last], lane[last]] = true[last]
                changed[kind[last], lane[last]] = True
                more = ~same & ~last
                kind, lane, true = kind[more], lane[more], true[more]
                if not len(lane):
                    break
            before = np.concatenate([carried[:, None], state[:, :-1]], axis=1)
            follows = np.concatenate([np.zeros((n_languages, 1), bool), changed[:, :-1]], axis=1)
            kind, lane = np.nonzero(follows & goes_on)
        carried = state[:, -1].copy()
        counts[:, a:b] = ends.sum(axis=0)
    total = np.concatenate([np.zeros((n_languages, 1), np.int64), np.cumsum(counts, axis=1)], axis=1)
    return total[:, first[1:]] - total[:, first[:-1]]


def parse(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Phrases that each text needs in each language, and its number of symbols."""
    n = len(column)
    phrases, sizes = np.zeros((len(model.languages), n), np.int64), np.zeros(n, np.int64)
    for block in words.blocks(column, words.SPACED):
        try:
            symbol, offsets = _symbols(block, model.symbol_of)
        except ValueError:
            raw = column.cast(pa.binary()).to_pylist()
            return parse(pa.array([None if t is None else t.decode("utf-8", "replace") for t in raw], pa.string()), model)
        size = np.diff(offsets)
        at = slice(block.first, block.first + block.texts)
        # A text of gaps alone has no letter.
        letters = np.concatenate([[0], np.cumsum(symbol != GAP)])
        sizes[at] = np.where(np.diff(letters[offsets]) > 0, size, 0)
        if len(symbol) and model.languages:
            phrases[:, at] = _phrases_of(symbol, size, model)
    return phrases, sizes


def fit_texts(texts: dict[str, list[str]], sample_letters: int = SAMPLE_LETTERS) -> Model:
    """A model of these texts by language."""
    languages = sorted(texts)
    letters = sorted({c for kind in languages for text in texts[kind] for c in text.lower() if c.isalpha()})
    symbol_of, symbols = letters_table(letters), len(letters) + 2
    automata, bits = [], []
    for kind in languages:
        taken: list[int] = []
        for block in words.blocks(pa.array(texts[kind], pa.string()), words.SPACED):
            symbol, offsets = _symbols(block, symbol_of)
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                taken += [GAP, *symbol[a:b].tolist()]
        taken = taken[:sample_letters]
        automata.append(_suffix_automaton(taken))
        bits.append(np.log2(max(2, len(taken))))
    moves, bases, nones = _packed(automata, symbols)
    # A letter that the sample does not hold is a phrase of its own.
    start = np.repeat(np.array(nones, np.int64).reshape(-1, 1), symbols, axis=1)
    for row, (own, automaton) in enumerate(zip(bases, automata, strict=True)):
        for symbol, target in automaton[0].items():
            start[row, symbol] = own[target]
    return Model(languages, symbol_of, moves, start, np.array(nones, np.int64), np.array(bits))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_letters: int = SAMPLE_LETTERS) -> Model:
    """Learn from docs(doc_id, text, lang), at most sample_rows texts of a language."""
    most = max(1, sample_letters // SAMPLE_SHARE)
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", F.substring("text", 1, most).alias("text"))
    named = known.withColumn("k", F.xxhash64("text"))
    chosen = bounded_sample(named.select("lang", "k").distinct(), "lang", sample_rows, "k")
    # At most sample_rows names of each language, and one text for each, of at most `most` letters.
    rows = (
        named.join(F.broadcast(chosen), ["lang", "k"])
        .groupBy("lang", "k")
        .agg(F.min("text").alias("text"))
        .orderBy("lang", F.xxhash64("k"), "k")
        .collect()
    )
    texts: dict[str, list[str]] = {}
    for row in rows:
        texts.setdefault(row.lang, []).append(row.text)
    model = fit_texts(texts, sample_letters)
    give_back()
    return model


def identify(text: Column | str, model: Model) -> Column:
    """struct<lang_pred, score> of a text."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def named(column: pa.Array) -> pa.Array:
        model = shared.value
        n = len(column)
        lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
        if model.languages and n:
            phrases, sizes = parse(column, model)
            bits = phrases * model.bits[:, None]
            best = bits.argmin(axis=0)
            share = 1 / np.exp2(-(bits - bits.min(axis=0)) / SOFTEN).sum(axis=0)
            said = sizes > 0
            lang[said] = np.array(model.languages, object)[best[said]]
            score[said] = share[said]
        give_back()
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], ["lang_pred", "score"])

    return named(text)


def has_letter(text: Column | str, model: Model) -> Column:
    """Whether a text has a letter, as `identify` counts them; a model without languages will do."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def told(column: pa.Array) -> pa.Array:
        made = pa.array(parse(column, shared.value)[1] > 0)
        give_back()
        return made

    return told(text)

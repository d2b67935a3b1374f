"""Operator 11, BPE encoding and decoding as transducers with bounded lookahead.

A merge can change a token only if what stands right of it changes first, and merges run in
the order of the list. So the text whose tokens are still open after n symbols ends in a chain
of merges of rising rank, each of which takes a token on its left to one that begins with
the left part of the merge before. The heaviest such chain, found in one pass over the list,
is the lookahead that suffices: tokens that end before it are final, whatever follows.

`Encoder` reads a text in blocks. Stretches between spaces and line feeds are looked up by their
normal form in a bounded table, those of many short texts together and each different one once.
A stretch that is too long for it goes through `_Stretch`, which holds back
only what a control string, a composed character, an open word or the lookahead may need.
`Decoder` turns ids into text, block by block, with the bytes of a cut character as its state.

The result is that of the tokenizers library for files with byte symbols, word ends, control
strings and the word pattern below; other files are refused. Null texts are empty and have
no ids; bytes that are no UTF-8 count as replacement characters; text of any length takes memory for one block. Rows are independent of each other:
ties, repeated rows and empty tables need no rule, and other columns are not read.
"""

from __future__ import annotations

import array
import codecs
import gc
import hashlib
import heapq
import itertools
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from gaugeflow.llm.merging import ID_BITS as _BITS
from gaugeflow.llm.merging import LONGEST, PairTable
from gaugeflow.llm.merging import LOW as _LOW
from gaugeflow.llm.merging import NONE as _NONE
from gaugeflow.llm.tables import per_batch

# Fixed values of the file format: the pattern of words, the steps of the normalizer, and the
# bytes that stand for themselves among the byte symbols.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
LONGEST_CONTRACTION = 3
# Marks that are a word of their own behind letters, one or several of them.
MARKS = ".,;:!?*&%$#|<>()[]{}+-=/~^_@"

BLOCK = 1 << 16
LONG_STRETCH = 128
KEPT_STRETCHES, KEPT_WORDS = 500_000, 100_000
LEARNT_AT_ONCE = 50_000
# Characters of short texts that are looked up together.
TOGETHER = 1 << 21

# White space as the library reads it; the separators of information are none.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters, numbers and lower case (first, last, distance) that the library's
# Unicode has and the interpreter's may not have yet.
NEWER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
]
NEWER_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
NEWER_LOWER = [
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1),
    (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC),
    (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
]
_LOWER = {c: c + by for first, last, by in NEWER_LOWER for c in range(first, last + 1)}
_NEWER = re.compile(f"[{chr(min(_LOWER))}-{chr(max(_LOWER))}]")


def _char_class(kind: str, newer: list[tuple[int, int]]) -> str:
    """The members of a general category as ranges for a pattern."""
    runs = [list(x) for x in newer]
    for code in range(0x110000):
        if unicodedata.category(chr(code))[0] == kind:
            if runs and runs[-1][1] == code - 1:
                runs[-1][1] = code
            else:
                runs.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


def byte_symbols() -> list[str]:
    """The character that stands for each byte."""
    own = set(PRINTED)
    rest = itertools.count(0x100)
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def _lower(text: str) -> str:
    """Lower case character by character: a sigma at a word's end is like any other."""
    if text.isascii():
        return text.lower()
    text = text.replace("\u03a3", "\u03c3").lower()
    return text.translate(_LOWER) if _NEWER.search(text) else text


def _normal(text: str) -> str:
    """The normal form of text that ends where nothing can join it, as before a space."""
    return text.lower() if text.isascii() else _lower(unicodedata.normalize("NFC", text))


def _composes_with_left() -> frozenset[str]:
    """Characters without combining class that may still join the one before them."""
    found = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    for code in range(0x80, 0x110000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(chr(int(parts[1], 16)))
    return frozenset(found)


class Merges:
    """Symbols, merges and control strings of a tokenizer file."""

    def __init__(self, text: str):
        file = json.loads(text)
        model, before = file["model"], file["pre_tokenizer"]
        steps = before.get("pretokenizers", [before]) if before else []
        patterns = [s["pattern"].get("Regex") for s in steps if s["type"] == "Split"]
        normal = [n["type"] for n in (file["normalizer"] or {}).get("normalizers", [])]
        added = file["added_tokens"]
        known = (
            model["type"] == "BPE"
            and model["end_of_word_suffix"]
            and not (model["dropout"] or model["continuing_subword_prefix"] or model.get("ignore_merges"))
            and patterns == [WORDS]
            and normal == NORMALIZERS
            and not any(a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"] for a in added)
        )
        if not known:
            raise ValueError("the file is not of the kind that this encoder reads")
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.texts = [""] * (1 + max([*ids.values(), *(a["id"] for a in added)]))
        for token, number in [*ids.items(), *((a["content"], a["id"]) for a in added)]:
            self.texts[number] = token
        self.kind = "<u2" if len(self.texts) <= 1 << 16 else "<u4"
        self.inner = [ids[s] for s in byte_symbols()]
        self.final = [ids[s + end] for s in byte_symbols()]
        self.controls = {a["content"]: a["id"] for a in added}
        letters, numbers = _char_class("L", NEWER_LETTERS), _char_class("N", NEWER_NUMBERS)
        self.words = re.compile(
            WORDS.replace(r"\s", WHITE).replace(r"\p{L}", letters).replace(r"\p{N}", numbers)
        )
        self.letters = re.compile(f"[{letters}]+")
        self.symbols = re.compile(f"[^{WHITE}{letters}{numbers}]+")
        self.end, self.decoder = end, (file["decoder"] or {}).get("type")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.pairs: dict[int, int] = {}
        parts: dict[int, tuple[int, int]] = {}
        self.ordered = True
        made = {*self.inner, *self.final}
        for rank, (a, b) in enumerate(merges):
            left, right, whole = ids[a], ids[b], ids[a + b]
            # In a proper list parts come before the whole, and nothing is made in two ways.
            self.ordered &= left in made and right in made and whole not in made
            made.add(whole)
            parts[whole] = (left, right)
            self.pairs[left << _BITS | right] = rank << _BITS | whole
        self.table = PairTable(self.pairs)
        self.lookahead = self._lookahead([(ids[a], ids[b]) for a, b in merges], parts) if self.ordered else None

    def _lookahead(self, merges: list[tuple[int, int]], parts: dict[int, tuple[int, int]]) -> int:
        """Symbols whose tokens may still change when more text comes: the heaviest chain."""
        length = {x: 1 for x in (*self.inner, *self.final)}
        for whole, (a, b) in parts.items():
            length[whole] = length[a] + length[b]
        heaviest: dict[int, int] = {}
        for a, b in merges:
            before, at = heaviest.get(b, 0), b
            while at in parts:
                at = parts[at][0]
                before = max(before, heaviest.get(at, 0))
            heaviest[a] = max(heaviest.get(a, 0), length[a] + before)
        return max(heaviest.values(), default=0)

    def merge(self, ids: list[int]) -> list[int]:
        """Apply the merges to the symbols of a word or of its beginning; the lowest rank goes first."""
        if len(ids) > 64:
            return self._merge_long(ids)
        get = self.pairs.get
        ranks = [get(a << _BITS | b, _NONE) for a, b in itertools.pairwise(ids)]
        while ranks and (best := min(ranks)) != _NONE:
            k = ranks.index(best)
            ids[k : k + 2] = (best & _LOW,)
            del ranks[k]
            if k:
                ranks[k - 1] = get(ids[k - 1] << _BITS | ids[k], _NONE)
            if k < len(ranks):
                ranks[k] = get(ids[k] << _BITS | ids[k + 1], _NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of the pairs, by rank and place."""
        ids, pairs, n = list(ids), self.pairs, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k) for k in range(n - 1) if (r := pairs.get(ids[k] << _BITS | ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            right = after[k]
            if ids[k] < 0 or right >= n or pairs.get(ids[k] << _BITS | ids[right]) != rank:
                continue
            ids[k], ids[right] = rank & _LOW, -1
            after[k] = right = after[right]
            if right < n:
                before[right] = k
                if (r := pairs.get(ids[k] << _BITS | ids[right])) is not None:
                    heapq.heappush(heap, (r, k))
            left = before[k]
            if left >= 0 and (r := pairs.get(ids[left] << _BITS | ids[k])) is not None:
                heapq.heappush(heap, (r, left))
        return [x for x in ids if x >= 0]

    def word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "replace")
        return self.merge([*map(self.inner.__getitem__, raw[:-1]), self.final[raw[-1]]])


class _Word:
    """The symbols of one word as they come in; tokens go out once nothing can change them."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.held = b""

    def feed(self, raw: bytes) -> list[int]:
        self.held += raw
        most = self.merges.lookahead
        if most is None or len(self.held) <= 4 * most + 64:
            return []
        # The last byte may yet be the end of the word.
        known = self.merges.merge([*map(self.merges.inner.__getitem__, self.held[:-1])])
        sizes = np.cumsum([self._size(x) for x in known])
        stable = int(np.searchsorted(sizes, sizes[-1] - most, "right"))
        if stable:
            self.held = self.held[int(sizes[stable - 1]) :]
        return known[:stable]

    def _size(self, token: int) -> int:
        return len(self.merges.texts[token].removesuffix(self.merges.end))

    def finish(self) -> list[int]:
        raw, self.held = self.held, b""
        return self.merges.merge([*map(self.merges.inner.__getitem__, raw[:-1]), self.merges.final[raw[-1]]])


class _Stretch:
    """A long stretch without spaces, piece by piece."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.word = _Word(encoder.merges)
        self.raw = self.marked = self.words = ""
        self.open: re.Pattern | None = None

    def feed(self, text: str, last: bool = False) -> list[int]:
        out: list[int] = []
        *ended, tail = self.encoder.split(self.raw + text)
        for part in ended:
            control = self.encoder.merges.controls.get(part)
            out += self._normal(part, True) if control is None else [control]
        held = 0 if last else self.encoder.begins_control(tail)
        self.raw = tail[len(tail) - held :]
        return out + self._normal(tail[: len(tail) - held], last)

    def _normal(self, text: str, last: bool) -> list[int]:
        text = self.marked + text
        cut = len(text)
        if not last:
            joins = self.encoder.joins_left()
            cut -= 1
            while cut > 0 and (unicodedata.combining(text[cut]) or text[cut] in joins):
                cut -= 1
        cut = max(cut, 0)
        self.marked = text[cut:]
        return self._words(_lower(unicodedata.normalize("NFC", text[:cut])), last)

    def _words(self, text: str, last: bool) -> list[int]:
        text, at, out, merges = self.words + text, 0, [], self.encoder.merges
        while True:
            if self.open is not None:
                found = self.open.match(text, at)
                if found:
                    out += self.word.feed(found[0].encode("utf-8", "replace"))
                    at = found.end()
                if at == len(text) and not last:
                    break
                out += self.word.finish()
                self.open = None
            found = merges.words.search(text, at)
            if found is None:
                at = len(text)
                break
            at = found.start()
            if text[at] == "'" and len(text) - at < LONGEST_CONTRACTION and not last:
                break
            if merges.letters.match(found[0]):
                self.open = merges.letters
            elif merges.symbols.fullmatch(found[0]):
                self.open = merges.symbols
            else:
                # A number, or a mark with the letters that belong to it.
                out += merges.word(found[0])
                at = found.end()
        self.words = text[at:]
        return out


def _halved(table: dict, most: int) -> None:
    """Drop the later half of a full table: most of what is frequent was seen first."""
    if len(table) > most:
        for late in list(itertools.islice(table, most // 2, None)):
            del table[late]


class Encoder:
    """Text to ids, as bytes of `kind`. One encoder serves a worker; its table is bounded."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.table: dict[str, bytes] = {"": b""}
        self.seen: dict[str, bytes] = {}
        self.inner, self.final = np.array(merges.inner), np.array(merges.final)
        self.code = "H" if merges.kind == "<u2" else "I"
        longest_first = sorted(merges.controls, key=len, reverse=True)
        self.control = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if longest_first else None
        # What every control string begins with; a stretch without it holds none.
        signs = {c[0] for c in merges.controls}
        self.sign = signs.pop() if len(signs) == 1 else ""
        self._joins: frozenset[str] | None = None

    def joins_left(self) -> frozenset[str]:
        if self._joins is None:
            self._joins = _composes_with_left()
        return self._joins

    def split(self, text: str) -> list[str]:
        """Text cut at control strings, which are members of their own."""
        return self.control.split(text) if self.control else [text]

    def begins_control(self, text: str) -> int:
        """Length of the longest end of a text that a control string may go on from."""
        most = max(map(len, self.merges.controls), default=1) - 1
        for n in range(min(most, len(text)), 0, -1):
            if any(c.startswith(text[-n:]) for c in self.merges.controls):
                return n
        return 0

    def as_bytes(self, ids: list[int]) -> bytes:
        made = array.array(self.code, ids)
        if sys.byteorder == "big":
            made.byteswap()
        return made.tobytes()

    def keys(self, text: str) -> list[str]:
        """What the stretches between spaces are looked up by: their normal form, or, if they
        hold a control string, a space and themselves."""
        controls = self.merges.controls
        if self.sign not in text or not any(c in text for c in controls):
            return _normal(text).split(" ")
        return [" " + x if any(c in x for c in controls) else _normal(x) for x in text.split(" ")]

    def _word(self, word: str) -> bytes:
        made = self.seen[word] = self.as_bytes(self.merges.word(word))
        return made

    def _words(self, normal: str) -> bytes:
        seen = self.seen
        return b"".join([seen.get(x) or self._word(x) for x in self.merges.words.findall(normal)])

    def learn(self, keys: Iterable[str]) -> None:
        """Look up many stretches ahead; what is too long for the tables is left out."""
        # Before and not after: what is learnt now is needed next.
        _halved(self.table, KEPT_STRETCHES)
        _halved(self.seen, KEPT_WORDS)
        new = [x for x in keys if x not in self.table and len(x) <= LONG_STRETCH]
        table, seen, findall = self.table, self.seen, self.merges.words.findall
        collecting = gc.isenabled()
        gc.disable()  # many short lists live for a moment, and none of them in a cycle
        for k in range(0, len(new), LEARNT_AT_ONCE):
            alone, plans, missing = {}, [], {}
            for stretch in new[k : k + LEARNT_AT_ONCE]:
                if stretch.isalpha():
                    if len(raw := stretch.encode("utf-8", "replace")) <= LONGEST:
                        alone[raw] = stretch
                    continue
                if (stem := stretch.rstrip(MARKS)).isalpha():
                    words = (stem, stretch[len(stem) :])
                elif stretch[0] == " ":
                    continue
                else:
                    words = findall(stretch)
                plans.append((stretch, words))
                for word in words:
                    if word not in seen and len(raw := word.encode("utf-8", "replace")) <= LONGEST:
                        missing[raw] = word
            merged = self.merges.table.words
            made = merged(alone, self.inner, self.final, self.merges.kind)
            table.update((alone[raw], ids) for raw, ids in made.items())
            made = merged(missing, self.inner, self.final, self.merges.kind)
            seen.update((missing[raw], ids) for raw, ids in made.items())
            for stretch, words in plans:
                found = [seen.get(w) for w in words]
                if None not in found:
                    table[stretch] = b"".join(found)
        if collecting:
            gc.enable()

    def _learn(self, key: str) -> bytes | None:
        if len(key) > LONG_STRETCH:
            return None
        _halved(self.table, KEPT_STRETCHES)
        _halved(self.seen, KEPT_WORDS)
        controls = self.merges.controls
        if key[0] != " ":
            made = self._words(key)
        else:
            made = b"".join(
                self.as_bytes([controls[part]]) if part in controls else self._words(_normal(part))
                for part in self.split(key[1:])
            )
        self.table[key] = made
        return made

    def together(self, texts: list[str]) -> list[bytes | None]:
        """Ids of short texts, whose stretches are looked up once for all of them; None for a
        text with a long stretch."""
        if not texts:
            return []
        pieces, first, marks = [], [0], self.control
        cuts: dict[int, list[str]] = {}
        for k, text in enumerate(texts):
            text = text.replace("\n", " ")
            if marks and self.sign in text and len(parts := marks.split(text)) > 1:
                cuts[k] = parts[1::2]
                pieces += map(_normal, parts[::2])
            else:
                pieces.append(_normal(text))
            first.append(len(pieces))
        lists = pc.split_pattern(pa.array(pieces, pa.string()), " ")
        coded = lists.values.dictionary_encode()
        found, at, raw = self._found(coded.dictionary)
        ids = pa.Array.from_buffers(pa.binary(), len(coded.dictionary), [None, pa.py_buffer(at), raw])
        _, at, raw = ids.take(coded.indices).buffers()
        starts = lists.offsets.to_numpy()
        at = np.frombuffer(at, np.int32)[starts].tolist()
        raw = memoryview(raw or b"")
        out: list[bytes | None] = []
        for k, (a, b) in enumerate(itertools.pairwise(first)):
            made = [bytes(raw[at[p] : at[p + 1]]) for p in range(a, b)]
            for n, control in enumerate(cuts.get(k, ()), 1):
                made[n] = self.as_bytes([self.merges.controls[control]]) + made[n]
            out.append(b"".join(made))
        if not found.all():
            before = np.cumsum([0, *~found[coded.indices.to_numpy()]])[starts[first]]
            for k in np.flatnonzero(np.diff(before)).tolist():
                out[k] = None
        return out

    def _found(self, stretches: pa.StringArray) -> tuple[np.ndarray, np.ndarray, pa.Buffer]:
        """Which of some different normal forms are not too long; the ends and the bytes of their ids.

        Marks at the end of a stretch, behind a letter or number, are a word of their own and
        looked up by themselves.
        """
        bare = pc.utf8_rtrim(stretches, MARKS)
        cut = pc.or_(pc.match_substring_regex(bare, r"[\pL\pN]$"), pc.equal(bare, ""))
        sizes = pc.if_else(cut, pc.binary_length(bare), pc.binary_length(stretches)).to_numpy()
        _, at, raw = stretches.buffers()
        ends = np.frombuffer(at, np.int32)[: len(stretches) + 1]
        # Stem and marks of one stretch after the other, in the bytes as they are.
        both = np.empty(2 * len(stretches) + 1, np.int32)
        both[::2], both[1::2] = ends, ends[:-1] + sizes
        halves = pa.Array.from_buffers(pa.string(), 2 * len(stretches), [None, pa.py_buffer(both), raw])
        coded = halves.dictionary_encode()
        keys = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        made = list(map(self.table.get, keys))
        self.learn([x for x, ids in zip(keys, made, strict=True) if ids is None])
        for k in [k for k, ids in enumerate(made) if ids is None]:
            made[k] = self.table[keys[k]] if keys[k] in self.table else self._learn(keys[k])
        _, at, raw = pa.array([x or b"" for x in made], pa.binary()).take(coded.indices).buffers()
        there = np.array([x is not None for x in made])[coded.indices.to_numpy()]
        return there[::2] & there[1::2], np.frombuffer(at, np.int32)[: len(both)][::2].copy(), raw

    def encode(self, text: str | None) -> Iterator[bytes]:
        """Ids of a text, a block at a time."""
        text = text or ""
        table, held, long = self.table, "", None
        for start in range(0, len(text), BLOCK):
            block = held + text[start : start + BLOCK].replace("\n", " ")
            *whole, held = block.split(" ")
            out = []
            if long is not None and whole:
                # The first one ends the long stretch of the block before.
                out.append(self.as_bytes(long.feed(whole.pop(0), True)))
                long = None
            keys = self.keys(" ".join(whole)) if whole else []
            found = list(map(table.get, keys))
            if None in found:
                for k, made in enumerate(found):
                    if made is None:
                        found[k] = table.get(keys[k]) if keys[k] in table else self._learn(keys[k])
                        if found[k] is None:
                            found[k] = self.as_bytes(_Stretch(self).feed(whole[k], True))
            out += found
            if len(held) > LONG_STRETCH:
                long = long or _Stretch(self)
            if long is not None:
                out.append(self.as_bytes(long.feed(held)))
                held = ""
            yield b"".join(out)
        if long is not None:
            yield self.as_bytes(long.feed(held, True))
        elif held:
            (key,) = self.keys(held)
            made = table.get(key) or self._learn(key)
            yield self.as_bytes(_Stretch(self).feed(held, True)) if made is None else made


class Decoder:
    """Ids to text, a block at a time.

    `ByteLevel` files give the bytes that the symbols stand for, read as UTF-8; the bytes of a
    character that is not complete wait for the next block. Without a decoder in the file the
    tokens themselves are the text, with a space between each two.
    """

    def __init__(self, texts: list[str], kind: str | None):
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"cannot decode as {kind}")
        self.spaced = kind is None
        self.texts = texts
        if not self.spaced:
            byte_of = {s: b for b, s in enumerate(byte_symbols())}
            self.raw = [
                bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in texts
            ]
        self.reset()

    def reset(self) -> None:
        self.first = True
        self.bytes = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        if not self.spaced:
            return self.bytes.decode(b"".join(map(self.raw.__getitem__, ids)))
        made = " ".join(map(self.texts.__getitem__, ids))
        if not made:
            return ""
        lead, self.first = "" if self.first else " ", False
        return lead + made

    def finish(self) -> str:
        made = "" if self.spaced else self.bytes.decode(b"", True)
        self.reset()
        return made


class Codec:
    """Encoder and decoder of one file."""

    def __init__(self, text: str):
        self.merges = Merges(text)
        self.encoder = Encoder(self.merges)
        self.decoder = Decoder(self.merges.texts, self.merges.decoder)

    def __reduce__(self):
        return _codec_of, (self.merges,)

    def _ahead(self, text: str) -> None:
        """Learn the stretches of a text of many blocks before they are encoded one by one."""
        found: set[str] = set()
        for start in range(0, len(text), BLOCK):
            found.update(self.encoder.keys(text[start : start + BLOCK].replace("\n", " ")))
            if len(found) > 4 * LEARNT_AT_ONCE:
                self.encoder.learn(found)
                found = set()
        self.encoder.learn(found)

    def _streamed(self, text: str) -> Iterator[bytes]:
        self._ahead(text)
        yield from self.encoder.encode(text)

    def encode_each(self, texts: Iterable[str | None]) -> Iterator[Iterable[bytes]]:
        """The ids of each text in blocks; texts of one block are looked up together."""
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text or "")
            size += min(len(held[-1]), BLOCK)
            if size > TOGETHER:
                yield from self._encoded(held)
                held, size = [], 0
        yield from self._encoded(held)

    def _encoded(self, texts: list[str]) -> Iterator[Iterable[bytes]]:
        short = [k for k, text in enumerate(texts) if len(text) <= BLOCK]
        made = dict(zip(short, self.encoder.together([texts[k] for k in short]), strict=True))
        for k, text in enumerate(texts):
            raw = made.pop(k, None)
            yield self._streamed(text) if raw is None else (raw,)

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each of some texts, as bytes of the merges' kind."""
        return [b"".join(blocks) for blocks in self.encode_each(texts)]

    def passes(self, text: str | None) -> Iterator[tuple[np.ndarray, str]]:
        """Blocks of ids of a text, each with the text that it decodes to."""
        return self.decoded(self.encoder.encode(text))

    def decoded(self, blocks: Iterable[bytes]) -> Iterator[tuple[np.ndarray, str]]:
        """Blocks of ids, each with the text that it decodes to."""
        for raw in blocks:
            ids = np.frombuffer(raw, self.merges.kind)
            yield ids, self.decoder.feed(ids.tolist())
        yield np.zeros(0, self.merges.kind), self.decoder.finish()


def _codec_of(merges: Merges) -> Codec:
    made = object.__new__(Codec)
    made.merges = merges
    made.encoder = Encoder(merges)
    made.decoder = Decoder(merges.texts, merges.decoder)
    return made


def codec_of(path: str) -> Codec:
    with open(path, encoding="utf-8") as file:
        return Codec(file.read())


def shared_codec(docs: DataFrame, path: str):
    """The codec of a file for all tasks."""
    # As large as the tokenizer file, whatever the corpus. A worker unpacks it once and
    # its tasks go on with the table of those before.
    return docs.sparkSession.sparkContext.broadcast(codec_of(path))


def texts_of(column: pa.Array) -> list[str | None]:
    """Texts of a column; bytes that are no UTF-8 are read as replacement characters."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if t is None else t.decode("utf-8", "replace") for t in column.cast(pa.binary()).to_pylist()]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids of the whole text."""
    codec = shared_codec(docs, path)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        kind, texts = codec.value.merges.kind, texts_of(batch.column("text"))
        made = [np.frombuffer(raw, kind).astype(np.int32) for raw in codec.value.encode_batch(texts)]
        offsets = np.cumsum([0, *map(len, made)]).astype(np.int32)
        flat = pa.array(np.concatenate(made) if made else np.zeros(0, np.int32))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), flat)], ["doc_id", "ids"]
        )

    return per_batch(docs.select("doc_id", "text"), work, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of its ids."""
    codec = shared_codec(encoded, path)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        decoder, texts = codec.value.decoder, []
        for ids in batch.column("ids").to_pylist():
            blocks = (ids[k : k + BLOCK] for k in range(0, len(ids or ()), BLOCK))
            texts.append("".join([*map(decoder.feed, blocks), decoder.finish()]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return per_batch(encoded.select("doc_id", "ids"), work, "doc_id bigint, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Number and digest of the ids of each document, and digest of what they decode to."""
    codec = shared_codec(docs, path)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, ids_hex, text_hex = [], [], []
        for blocks in codec.value.encode_each(texts_of(batch.column("text"))):
            n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
            for ids, decoded in codec.value.decoded(blocks):
                n += len(ids)
                of_ids.update(ids.astype("<u4"))
                of_text.update(decoded.encode("utf-8"))
            counts.append(n)
            ids_hex.append(of_ids.hexdigest())
            text_hex.append(of_text.hexdigest())
        columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string())]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(text_hex, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        )

    return per_batch(
        docs.select("doc_id", "text"),
        work,
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )

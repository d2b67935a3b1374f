"""Token ids of whole texts from tokenizer files that work on bytes and keep white space.

A space belongs to the word behind it. Between single spaces and line feeds each stretch is
encoded by itself. Arrow cuts many texts at once, each different stretch is looked up once, and Arrow puts
the ids together. Words of letters that have not been seen are merged many at once, and all
else goes through the tokenizers library. Texts with other
white space next to a space or at a line's edge are cut only where two non-spaces meet one
space. Control strings are cut out first, as the library does, and are their ids.
"""

from __future__ import annotations

import functools
import gc
import itertools
import json
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gaugeflow.llm.bpe_stream import byte_symbols
from gaugeflow.llm.merging import ID_BITS, LONGEST, PairTable

CACHED_STRETCHES = 700_000
MARKS = ".,;:!?"
JOINED_STRETCHES = 2000
# Characters of texts whose stretches are looked up together; longer texts than ALONE do not fit Arrow's strings.
TOGETHER, ALONE = 1 << 21, 1 << 28
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class TextEncoder:
    """Ids of texts as little-endian bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        # Stretches behind a space, or behind the line feed that they begin with; without ids
        # if they are not encoded by themselves.
        self.seen: dict[str, bytes] = {}
        # Marks behind letters.
        self.tails: dict[str, bytes] = {"": b""}
        with open(path, encoding="utf-8") as text:
            file = json.load(text)
        model, ids = file["model"], file["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.table = PairTable(
            {ids[a] << ID_BITS | ids[b]: rank << ID_BITS | ids[a + b] for rank, (a, b) in enumerate(merges)}
        )
        self.symbols = np.array([ids[s] for s in byte_symbols()])
        added = sorted(((a["content"], a["id"]) for a in file["added_tokens"]), key=lambda a: -len(a[0]))
        self.controls = {content: np.array([number], self.kind).tobytes() for content, number in added}
        self.control = re.compile(f"({'|'.join(re.escape(c) for c in self.controls)})") if added else None
        # Many short stretches go through as one text, cut again at a line feed.
        self.mark = "\n"
        self.mark_ids = self._ids(self.mark)
        self.line = self.mark_ids.tobytes()

    def _ids(self, text: str) -> np.ndarray:
        made = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(made[0].ids, self.kind)

    def _each(self, stretches: list[str]) -> list[bytes]:
        return [self._ids(x).tobytes() for x in stretches]

    def _encode(self, stretches: Iterable[str]) -> list[bytes]:
        out: list[bytes] = []
        stretches = list(stretches)
        for k in range(0, len(stretches), JOINED_STRETCHES):
            some = stretches[k : k + JOINED_STRETCHES]
            ids = self._ids(self.mark.join(some))
            cuts = np.flatnonzero(ids == self.mark_ids[0])
            if len(self.mark_ids) != 1 or len(cuts) != len(some) - 1:
                out += self._each(some)  # a stretch holds the mark itself
                continue
            raw, width = ids.tobytes(), self.kind.itemsize
            starts = [0, *(int(x) + 1 for x in cuts)]
            ends = [*map(int, cuts), len(ids)]
            out += [raw[a * width : b * width] for a, b in zip(starts, ends, strict=True)]
        return out

    def _learned(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of stretches that have not been seen; none for those that cannot be encoded by themselves."""
        out: dict[str, bytes] = {}
        letters: dict[bytes, str] = {}
        plain: dict[str, str] = {}
        for piece in pieces:
            x = piece.removeprefix(self.mark)
            if not x or x.strip() != x:
                # White space at an edge belongs to a longer run, which is not cut here.
                out[piece] = b""
                continue
            text = x if x is not piece else " " + x
            if x.isalpha() and len(raw := text.encode()) <= LONGEST:
                letters[raw] = piece
            else:
                plain[piece] = text
        made = self.table.words(letters, self.symbols, self.symbols, self.kind.str)
        out.update((letters[raw], ids) for raw, ids in made.items())
        out.update(zip(plain, self._encode(plain.values()), strict=True))
        for piece, ids in out.items():
            if piece[:1] == self.mark and ids:
                out[piece] = self.line + ids
        return out

    def _whole(self, text: str) -> bytes:
        first, *rest = _SINGLE_SPACE.split(text)
        return b"".join(self._encode([first, *(" " + x for x in rest)]))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        for cache in (self.seen, self.tails):
            if len(cache) > CACHED_STRETCHES:
                # Most of the frequent stretches were seen first.
                for late in list(itertools.islice(cache, CACHED_STRETCHES // 2, None)):
                    del cache[late]
        if self.control is None or not any(c in (t or "") for t in texts for c in self.controls):
            return self._plain(texts)
        parts = [self.control.split(t or "") for t in texts]
        made = iter(self._plain([x for text in parts for x in text if x not in self.controls]))
        return [b"".join([self.controls[x] if x in self.controls else next(made) for x in text]) for text in parts]

    def _plain(self, texts: list[str | None]) -> list[bytes]:
        """Ids of texts without control strings."""
        out: list[bytes] = []
        held: list[str] = []
        size = 0
        for text in texts:
            if text and len(text) > ALONE:
                out += [*self._together(held), self._whole(text)]
                held, size = [], 0
                continue
            held.append(text or "")
            size += len(held[-1])
            if size > TOGETHER:
                out += self._together(held)
                held, size = [], 0
        return out + self._together(held)

    def _together(self, texts: list[str]) -> list[bytes]:
        """Ids of texts whose stretches are looked up once for all of them.

        Each line feed, and one more before the text, begins the stretch behind it.
        """
        if not texts:
            return []
        mark = self.mark
        lists = pc.split_pattern(pa.array([mark + x.replace(mark, " " + mark) for x in texts], pa.string()), " ")
        coded = lists.values.dictionary_encode()
        there, ids = self._found(coded.dictionary)
        _, at, raw = ids.take(coded.indices).buffers()
        starts = lists.offsets.to_numpy()
        ends = np.frombuffer(at, np.int32)[starts].tolist()
        raw, skipped = memoryview(raw or b""), len(self.line)
        out = [bytes(raw[a + skipped : b]) for a, b in itertools.pairwise(ends)]
        if not there.all():
            lacking = np.concatenate([[0], np.cumsum(~there[coded.indices.to_numpy()])])[starts]
            for k in np.flatnonzero(np.diff(lacking)).tolist():
                out[k] = self._whole(texts[k]) if texts[k] else b""
        return out

    def _found(self, stretches: pa.StringArray) -> tuple[np.ndarray, pa.BinaryArray]:
        """Which of some different stretches can be encoded by themselves, and their ids.

        Letters and the marks behind them are always apart, so each is encoded once.
        """
        stems = pc.utf8_rtrim(stretches, MARKS)
        cut = pc.match_substring_regex(stems, r"\pL$")
        sizes = pc.if_else(cut, pc.binary_length(stems), pc.binary_length(stretches)).to_numpy()
        _, at, raw = stretches.buffers()
        ends = np.frombuffer(at, np.int32)[: len(stretches) + 1]
        # Letters and marks of one stretch after the other, in the bytes as they are.
        both = np.empty(2 * len(stretches) + 1, np.int32)
        both[::2], both[1::2] = ends, ends[:-1] + sizes
        halves = pa.Array.from_buffers(pa.string(), 2 * len(stretches), [None, pa.py_buffer(both), raw])
        places = np.arange(0, 2 * len(stretches), 2)
        stems = halves.take(pa.array(places)).dictionary_encode()
        tails = halves.take(pa.array(places + 1)).dictionary_encode()
        pieces, ends_in = (x.dictionary.to_numpy(zero_copy_only=False).tolist() for x in (stems, tails))
        collecting = gc.isenabled()
        gc.disable()  # many short strings live for a moment, and none of them in a cycle
        made = list(map(self.seen.get, pieces))
        missing = [k for k, ids in enumerate(made) if ids is None]
        new = self._learned([pieces[k] for k in missing])
        self.seen.update(new)
        for k in missing:
            made[k] = new[pieces[k]]
        if collecting:
            gc.enable()
        new = [x for x in ends_in if x not in self.tails]
        self.tails.update(zip(new, self._encode(new), strict=True))
        first = pa.array(made, pa.binary()).take(stems.indices)
        there = pc.binary_length(first).to_numpy() > 0
        last = pa.array(list(map(self.tails.__getitem__, ends_in)), pa.binary()).take(tails.indices)
        return there, pc.binary_join_element_wise(first, last, pa.scalar(b"", pa.binary()))


@functools.lru_cache(maxsize=1)
def kept_encoder(path: str) -> TextEncoder:
    """The encoder of this Python worker: later tasks find what earlier ones have looked up."""
    return TextEncoder(path)


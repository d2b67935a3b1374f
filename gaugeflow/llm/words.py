"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A byte table says how each byte is read: 0x20 ends a word, anything else is part of it.
All separators are single ASCII bytes, so UTF-8 sequences stay whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20


def _byte_table(separators: bytes, lower: bool) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[ord("A") : ord("Z") + 1] += 32
    table[list(separators)] = 0x20
    return table


WHITE = bytes([0x20, *range(0x09, 0x0E)])
#: Words between white space, as written and with A-Z lowered.
SPACED = _byte_table(WHITE, lower=False)
SPACED_LOWER = _byte_table(WHITE, lower=True)
#: Words of digits, lowered letters and all bytes beyond ASCII.
ALNUM_LOWER = _byte_table(
    bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True
)

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    values = (values ^ (values >> _SHIFT)) * _MIX
    values = (values ^ (values >> _SHIFT)) * _MIX
    return values ^ (values >> _SHIFT)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 offsets of its texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if not len(column) or data is None or not data.size:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


@dataclass
class Words:
    """Words of a block of texts. `of` has n + 1 entries: text i has words of[i] to of[i + 1]."""

    first: int
    raw: np.ndarray
    read: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    of: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), np.diff(self.of))

    def hashes(self, most: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of its first `most` bytes."""
        padded = np.concatenate([self.read, np.zeros(8, np.uint8)])
        eights = np.ndarray((len(self.read) + 1,), "<u8", padded, strides=(1,))
        length = self.end - self.start
        if most is not None:
            length = np.minimum(length, most)
        out = mixed(length.astype(np.uint64) + _ODD)
        at, left, rest = self.start, length, np.arange(len(length))
        while len(rest):
            kept = np.minimum(left, 8).astype(np.uint64) * np.uint64(8)
            mask = np.where(kept == 64, ~np.uint64(0), (np.uint64(1) << (kept % np.uint64(64))) - np.uint64(1))
            out[rest] = mixed(out[rest] * _ODD ^ (eights[at] & mask))
            more = left > 8
            rest, at, left = rest[more], at[more] + 8, left[more] - 8
        return out

    def shingles(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the `size` words from each word on, and whether they are in one text."""
        n = len(hashes)
        if n < size:
            return np.zeros(n, np.uint64), np.zeros(n, bool)
        out = hashes[: n - size + 1].copy()
        for k in range(1, size):
            out = out * _ODD + hashes[k : n - size + 1 + k]
        out = mixed(out + np.uint64(size))
        whole = np.zeros(n, bool)
        last = np.repeat(self.of[1:], np.diff(self.of))
        whole[: n - size + 1] = np.arange(n - size + 1) + size <= last[: n - size + 1]
        return np.concatenate([out, np.zeros(size - 1, np.uint64)]), whole


def blocks(column: pa.Array, table: np.ndarray) -> Iterator[Words]:
    """The texts of a column in blocks of about a megabyte; a longer text is a block of its own."""
    raw, offsets = text_bytes(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = min(max(last, first + 1), n)
        part = raw[offsets[first] : offsets[last]]
        own = offsets[first : last + 1] - offsets[first]
        read = table[part]
        inside = read != 0x20
        before = np.zeros(len(part) + 1, bool)
        before[1:] = inside
        # A text begins and ends words, whatever its neighbours hold.
        edge = np.zeros(len(part) + 1, bool)
        edge[own] = True
        start = np.flatnonzero(inside & (~before[:-1] | edge[:-1]))
        after = np.zeros(len(part) + 1, bool)
        after[:-1] = inside
        end = np.flatnonzero(inside & (~after[1:] | edge[1:])) + 1
        yield Words(first, part, read, own, start, end, np.searchsorted(start, own, "left"))
        first = last

"""Merges of byte pairs for many words at once.

Words of the same number of symbols are the rows of a matrix. In each step the pair with the lowest
rank of every row becomes one symbol, the first such pair if there are several, and rows
without a pair are done. Pairs are found in an open hash table of numpy arrays.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

ID_BITS = 20
LOW = (1 << ID_BITS) - 1
NONE = 1 << 62
LONGEST = 64
_ODD = 0x9E3779B97F4A7C15
_EMPTY = -1


class PairTable:
    """Ranks and results of pairs, from a dictionary (a << ID_BITS | b) -> (rank << ID_BITS | whole)."""

    def __init__(self, pairs: dict[int, int]):
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, _EMPTY, np.int64)
        self.values = np.full(1 << bits, NONE, np.int64)
        for key, value in pairs.items():
            at = (key * _ODD % (1 << 64)) >> (64 - bits)
            while self.keys[at] != _EMPTY:
                at = (at + 1) & self.mask
            self.keys[at], self.values[at] = key, value

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << ID_BITS | right
        at = ((key.view(np.uint64) * np.uint64(_ODD)) >> self.shift).view(np.int64)
        there = self.keys[at]
        out = np.where(there == key, self.values[at], NONE)
        rest = np.flatnonzero((there != key) & (there != _EMPTY))
        flat, keys, places = out.reshape(-1), key.reshape(-1), at.reshape(-1)
        while len(rest):
            place = (places[rest] + 1) & self.mask
            places[rest] = place
            there = self.keys[place]
            met = there == keys[rest]
            flat[rest[met]] = self.values[place[met]]
            rest = rest[~met & (there != _EMPTY)]
        return out

    def merge(self, symbols: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows of symbols to groups (rows, their ids), each with one number of ids."""
        rows, done = np.arange(len(symbols)), []
        while len(rows):
            width = symbols.shape[1]
            if width == 1:
                done.append((rows, symbols))
                break
            ranks = self.ranks(symbols[:, :-1].copy(), symbols[:, 1:].copy())
            first = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), first]
            more = best != NONE
            if not more.all():
                done.append((rows[~more], symbols[~more]))
                rows, symbols, first, best = rows[more], symbols[more], first[more], best[more]
            joined = np.where(np.arange(width - 1) < first[:, None], symbols[:, :-1], symbols[:, 1:])
            joined[np.arange(len(rows)), first] = best & LOW
            symbols = joined
        return done

    def words(self, words: Iterable[bytes], inner: np.ndarray, final: np.ndarray, kind: str) -> dict[bytes, bytes]:
        """Ids, as bytes of a kind, of words of up to LONGEST bytes; the last byte has symbols of its own."""
        by_size: dict[int, list[bytes]] = {}
        for word in words:
            by_size.setdefault(len(word), []).append(word)
        out: dict[bytes, bytes] = {}
        size_of = np.dtype(kind).itemsize
        for size, some in by_size.items():
            raw = np.frombuffer(b"".join(some), np.uint8).reshape(len(some), size)
            symbols = inner[raw]
            symbols[:, -1] = final[raw[:, -1]]
            for rows, ids in self.merge(symbols):
                packed, step = ids.astype(kind).tobytes(), ids.shape[1] * size_of
                for k, row in enumerate(rows.tolist()):
                    out[some[row]] = packed[k * step : (k + 1) * step]
        return out

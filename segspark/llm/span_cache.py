"""Ids of byte spans, found by hash in flat arrays: no Python object per word of a text.

Spans are looked up by a 64-bit hash in an open-addressing table and compared byte by byte; only spans
never seen before become strings and are encoded. An entry takes some 60 bytes, so a worker can hold
most words of its texts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from segspark.llm.piece_cache import gather
from segspark.llm.text_arrays import mix


class _Pool:
    """A growing flat array with the start and length of each entry."""

    def __init__(self, dtype: type):
        self.flat, self.used = np.zeros(1 << 16, dtype), 0
        self.start, self.length, self.entries = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0

    def add(self, flat: np.ndarray, lengths: np.ndarray):
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.entries + len(lengths) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        self.flat[self.used : self.used + len(flat)] = flat
        here = slice(self.entries, self.entries + len(lengths))
        self.start[here], self.length[here] = self.used + np.cumsum(lengths) - lengths, lengths
        self.used, self.entries = self.used + len(flat), self.entries + len(lengths)

    def keep(self, entries: int):
        self.entries, self.used = entries, int(self.length[:entries].sum())

    def take(self, entries: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.start[entries], self.length[entries])


class SpanCache:
    """(bytes, spans) -> ids. Beyond `most` entries or `most_bytes` only the first half stays: frequent spans come early."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 300_000, most_bytes: int = 16 << 20):
        self.encode, self.most, self.most_bytes = encode, most, most_bytes
        self.ids_of, self.bytes_of = _Pool(np.int32), _Pool(np.uint8)
        self.hashes = np.zeros(0, np.uint64)
        self.bits = (2 * most).bit_length()
        self._empty()

    def _empty(self):
        self.table = np.full(1 << self.bits, -1, np.int32)

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def _enter(self, hashes: np.ndarray, numbers: np.ndarray):
        """Put new entries into the table; equal hashes keep the first."""
        while 2 * (numbers[-1] + 1) > len(self.table) if len(numbers) else False:
            self.bits += 1
            self._empty()
            hashes, numbers = self.hashes, np.arange(len(self.hashes))
        slots = self._slots(hashes)
        while len(numbers):
            free = self.table[slots] < 0
            self.table[slots[free]] = numbers[free]
            left = self.table[slots] != numbers
            slots, numbers = (slots[left] + 1) & (len(self.table) - 1), numbers[left]

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        if not len(self.hashes):
            return out
        slots, open_ = self._slots(hashes), np.arange(len(hashes))
        while len(open_):
            entry = self.table[slots]
            hit = (entry >= 0) & (self.hashes[entry] == hashes[open_])
            out[open_[hit]] = entry[hit]
            go_on = (entry >= 0) & ~hit
            slots, open_ = (slots[go_on] + 1) & (len(self.table) - 1), open_[go_on]
        return out

    def _forget(self):
        kept = self.ids_of.entries // 2
        self.ids_of.keep(kept)
        self.bytes_of.keep(kept)
        self.hashes = self.hashes[:kept]
        self._empty()
        # Spans of equal hash but other bytes have entries outside the table, so equal hashes may be among these.
        first = np.unique(self.hashes, return_index=True)[1]
        first.sort()
        self._enter(self.hashes[first], first)

    def _add(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """New entries, in this order."""
        raw = data.tobytes()
        ids, lengths = self.encode([raw[a:b].decode("utf-8") for a, b in zip(start.tolist(), end.tolist())])
        first = self.ids_of.entries
        self.ids_of.add(ids, lengths)
        self.bytes_of.add(gather(data, start, end - start), end - start)
        self.hashes = np.concatenate([self.hashes, hashes])
        return np.arange(first, first + len(start))

    def numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Entries of the spans data[start:end]; `hashes` are equal for equal spans. They hold until the next call."""
        if self.ids_of.entries > self.most or max(self.bytes_of.used, 4 * self.ids_of.used) > self.most_bytes:
            self._forget()
        length = end - start
        hashes = mix(hashes ^ length.astype(np.uint64))
        found = self._find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            distinct, first, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            at = new[first]
            entries = self._add(data, start[at], end[at], distinct)
            self._enter(distinct, entries)
            found[new] = entries[back]
        # Equal hashes are almost always equal bytes; where not, the span gets an entry of its own.
        wrong = self.bytes_of.length[found] != length
        same = np.flatnonzero(~wrong)
        differ = self.bytes_of.take(found[same]) != gather(data, start[same], length[same])
        if differ.any():
            wrong[same[np.searchsorted(np.cumsum(length[same]), np.flatnonzero(differ), "right")]] = True
        other = np.flatnonzero(wrong)
        if len(other):
            found[other] = self._add(data, start[other], end[other], hashes[other])
        return found

    def ids(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each span has."""
        found = self.numbers(data, start, end, hashes)
        return self.ids_of.take(found), self.ids_of.length[found]

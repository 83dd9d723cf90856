"""Ids of text pieces, looked up once per worker and gathered for whole batches.

Most pieces of a text (words with their space or punctuation) have been seen before. Their ids lie
one after another in a flat array; a batch becomes an array of piece numbers, and its ids one gather.
"""

from __future__ import annotations

import contextlib
import ctypes
import itertools
import sys
import types
from collections.abc import Callable

import numpy as np
import pyarrow as pa


def worker_state() -> dict:
    """A dict that lives as long as the Python worker; task code itself is sent anew with each task."""
    return sys.modules.setdefault("_segspark_worker_state", types.ModuleType("_segspark_worker_state")).__dict__


def give_back():
    """Return freed memory to the system; allocators would keep it while the worker idles beside the JVM."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[start[0]:start[0]+length[0]], flat[start[1]:...], ... as one array."""
    ends = np.cumsum(length)
    if not len(ends):
        return flat[:0]
    return flat[np.repeat(start - (ends - length), length) + np.arange(ends[-1])]


class PieceCache:
    """piece -> ids. Between batches, once it holds `most` pieces, only the first half stays.

    Frequent pieces come early, so most of them stay. Results never depend on what is held.
    """

    def __init__(self, encode: Callable[[list], list], most: int = 300_000):
        self.encode, self.most = encode, most
        self.number: dict = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.used = 0

    def forget(self):
        half = self.most // 2
        if self.used > 16 * self.most:  # a few very long pieces
            half = int(np.searchsorted(np.cumsum(self.length[: len(self.number)]), 8 * self.most))
        half = min(half, len(self.number))
        self.number = dict(itertools.islice(self.number.items(), half))
        self.used = int(self.length[:half].sum())

    def _add(self, pieces: list, ids: list):
        known = len(self.number)
        while known + len(pieces) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(lengths.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + total] = np.fromiter((i for x in ids for i in x), np.int32, total)
        self.start[known : known + len(ids)] = self.used + np.cumsum(lengths) - lengths
        self.length[known : known + len(ids)] = lengths
        self.number.update(zip(pieces, range(known, known + len(pieces)), strict=True))
        self.used += total

    def ids(self, texts: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, each given as its pieces: all ids, and where each text begins (and the end)."""
        if len(self.number) > self.most or self.used > 16 * self.most:
            self.forget()
        pieces = [p for t in texts for p in t]
        missing = sorted(set(pieces).difference(self.number))
        if missing:
            self._add(missing, self.encode(missing))
        numbers = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        length = self.length[numbers]
        ends = np.concatenate([[0], np.cumsum(length)])
        bounds = np.cumsum([0, *map(len, texts)])
        return gather(self.flat, self.start[numbers], length), ends[bounds]

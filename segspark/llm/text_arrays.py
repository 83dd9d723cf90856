"""Texts as flat byte arrays, so that numpy works on many documents at once.

Texts of an Arrow batch lie in one buffer. They are taken in slices of about `SLICE_BYTES`
(always whole documents), which bounds the memory of a task by that and its longest text.
Words are runs of bytes other than 0x20 and 0x09-0x0D; lines are split at 0x0A.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64))


class Rolling:
    """Hashes of any number of spans of a sequence of 64-bit numbers, in constant time each.

    A span's hash is its polynomial modulo 2^64 with its first number at power 0, so equal
    spans have equal hashes wherever they lie.
    """

    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, numbers: np.ndarray):
        n = len(numbers)
        if len(Rolling._powers) <= n:
            with np.errstate(over="ignore"):
                Rolling._powers, Rolling._inverse = (
                    np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n + n // 4 + 1, base, np.uint64))])
                    for base in (_PRIME, _INVERSE)
                )
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(numbers * Rolling._powers[:n], out=self.prefix[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * Rolling._inverse[start]


@dataclass
class Slice:
    """Consecutive documents: their bytes, where each begins (one more offset than documents)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def per_document(self, positions: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """How many of the sorted byte positions (or how much of their weights) lie in each document."""
        at = np.searchsorted(positions, self.offsets)
        if weights is None:
            return np.diff(at)
        return np.diff(np.concatenate([[0], np.cumsum(weights, dtype=np.int64)])[at])


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The whole texts of a string array; null counts as empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield Slice(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    start: np.ndarray  # byte positions
    end: np.ndarray
    bounds: np.ndarray  # first word of each document, and the number of words


def words(part: Slice) -> Words:
    space = SPACE[part.data]
    n = len(space)
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    filled = part.offsets[:-1][np.diff(part.offsets) > 0]
    before[filled] = True
    after[filled - 1] = True  # the last byte of the document before; -1 is the last of all
    inside = ~space
    start, end = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    return Words(start, end, np.searchsorted(start, part.offsets))


def lines(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each line; an empty document has one empty line."""
    breaks = np.flatnonzero(part.data == 10)
    owner = np.searchsorted(part.offsets, breaks, "right") - 1
    start = np.concatenate([part.offsets[:-1], breaks + 1])
    doc = np.concatenate([np.arange(len(part)), owner])
    order = np.lexsort((start, doc))
    start, doc = start[order], doc[order]
    last = np.ones(len(start), bool)
    last[:-1] = doc[1:] != doc[:-1]
    end = np.empty_like(start)
    end[:-1] = start[1:] - 1
    end[last] = part.offsets[1:][doc[last]]
    return start, end, doc


def byte_hashes(part: Slice) -> Rolling:
    return Rolling(BYTE_HASH[part.data])


def code_points(part: Slice) -> np.ndarray:
    """True at the first byte of every character."""
    return (part.data & 0xC0) != 0x80


def repeated(keys: np.ndarray) -> np.ndarray:
    """True for every key that occurs more than once."""
    out = np.zeros(len(keys), bool)
    if len(keys) > 1:
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        out[order[1:][same]] = True
        out[order[:-1][same]] = True
    return out

"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece, exactly one vocabulary entry can be the last token of the prefix's
encoding: the one that ends there and forms a valid pair with the last token of the prefix it
leaves. Two tokens are a valid pair when merging their joined bytes gives the same two tokens
back. The table of these last tokens is filled from left to right; the encoding is read off it
backwards. Appending bytes extends the table without touching it, and after an edit only the entries
from the edit to where old and new table agree again are filled anew. Cost is linear in the
length, also for pieces of many thousand bytes.

Results for odd cases: a null or empty text has no tokens and decodes to no bytes. Texts are
encoded whole, in any length. Repeated rows give repeated results; an empty table an empty one. A
null id stays null. Only id and text are read, so other columns cannot clash. Strings that look like
special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segspark.llm.piece_cache import PieceCache, gather, give_back, worker_state

SLICE_CHARS = 1 << 18


class Vocabulary:
    """Ranks of byte strings, the pair test they imply, and the bytes of each id."""

    def __init__(self, lines: bytes, most_pairs: int = 400_000):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.most_pairs = most_pairs
        self._pairs: dict[tuple[int, int], bool] = {}
        # Every prefix of a token, with the token that it is itself (or -1).
        self.prefixes: dict[bytes, int] = {}
        # token -> the two tokens of its last merge; only tokens whose own bytes encode to them take part.
        self.halves: dict[int, tuple[int, int]] = {}
        self.whole: set[int] = set()
        for i, t in sorted(self.tokens.items()):
            halves = self.merge(t, i)
            if len(halves) == 2 and all(h < i and h in self.whole for h in halves):
                self.halves[i] = (halves[0], halves[1])
            if len(t) == 1 or i in self.halves:
                self.whole.add(i)
        for i in sorted(self.whole):
            t = self.tokens[i]
            for n in range(1, len(t)):
                self.prefixes.setdefault(t[:n], -1)
            self.prefixes[t] = i
        size = max(self.tokens) + 1
        self.lengths = np.zeros(size, np.int64)
        for i, t in self.tokens.items():
            self.lengths[i] = len(t)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(size)), np.uint8)
        decimal = [b"%d," % i for i in range(size)]
        self.digit_lengths = np.array([len(x) for x in decimal])
        self.digit_starts = np.cumsum(self.digit_lengths) - self.digit_lengths
        self.digits = np.frombuffer(b"".join(decimal), np.uint8)

    def merge(self, data: bytes, below: int = 1 << 60) -> list[int]:
        """Plain BPE of a few bytes: join the adjacent pair of lowest rank until none is left below `below`."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def is_pair(self, left: int, right: int) -> bool:
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= self.most_pairs:
                self._pairs.clear()
            known = self._pairs[left, right] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        """Go back through the merges on both sides of the border, latest first.

        At any time one part of `left` and one of `right` touch the border. A merge across it happens if
        its rank comes before the merges by which either part ends (at equal rank, the leftmost is first).
        """
        end_left = end_right = 1 << 60
        while True:
            across = self.ranks.get(self.tokens[left] + self.tokens[right])
            if across is not None and across < end_left and across <= end_right:
                return False
            if left > right and left in self.halves:
                end_left, left = left, self.halves[left][1]
            elif right in self.halves:
                end_right, right = right, self.halves[right][0]
            else:
                return True

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, as an array of uint8."""
        return gather(self.bytes, self.starts[ids], self.lengths[ids])


class PrefixTable:
    """The last token of every prefix of a piece, its bytes, and what may be done with them."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data = vocabulary, b""
        self.last: list[int] = []  # last[i]: last token of the first i + 1 bytes
        self.append(data)

    def _last(self, data: bytes, last: list[int], end: int) -> int:
        vocabulary = self.vocabulary
        for start in range(max(0, end - vocabulary.longest), end):
            token = vocabulary.prefixes.get(data[start:end], -1)
            if token >= 0 and (start == 0 or vocabulary.is_pair(last[start - 1], token)):
                return token
        raise ValueError("the vocabulary lacks a single byte")

    def append(self, more: bytes):
        begin = len(self.data)
        self.data += more
        data, last, prefixes, is_pair = self.data, self.last, self.vocabulary.prefixes, self.vocabulary.is_pair
        last += [-1] * len(more)
        for start in range(max(0, begin - self.vocabulary.longest), len(data)):
            for end in range(start + 1, len(data) + 1):
                token = prefixes.get(data[start:end])
                if token is None:
                    break
                if token >= 0 and end > begin and (start == 0 or is_pair(last[start - 1], token)):
                    last[end - 1] = token

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put `new` in place of bytes start to end; returns how many entries were filled anew."""
        data, old = self.data[:start] + new + self.data[end:], self.last
        last, shift, same = self.last[:start], len(new) - (end - start), 0
        for at in range(start + 1, len(data) + 1):
            last.append(self._last(data, last, at))
            in_tail = at > start + len(new)
            same = same + 1 if in_tail and last[-1] == old[at - 1 - shift] else 0
            if same >= self.vocabulary.longest:  # whatever follows sees the same bytes and entries
                filled = at - start
                self.data, self.last = data, last + old[at - shift :]
                return filled
        self.data, self.last = data, last
        return len(data) - start

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at - 1])
            at -= len(self.vocabulary.tokens[out[-1]])
        return out[::-1]


class Encoder:
    """Texts to ids, each match of the pattern by itself."""

    def __init__(self, lines: bytes, pattern: str):
        self.vocabulary = Vocabulary(lines)
        self.pattern = regex.compile(pattern)
        self.cache = PieceCache(lambda pieces: [self.piece(p) for p in pieces])

    def piece(self, piece: str) -> list[int]:
        data = piece.encode()
        token = self.vocabulary.ranks.get(data)
        if token is not None and token in self.vocabulary.whole:
            return [token]
        return PrefixTable(self.vocabulary, data).ids()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids begin (and the end)."""
        return self.cache.ids([self.pattern.findall(t) for t in texts])


class EditableText:
    """A text with its pieces and their tables; edits re-split and re-encode only near themselves.

    A match of the pattern depends on the text from its beginning to at most one character after
    the run it is cut from. So matching starts anew at the first piece that ends at most one
    character before the edit, and stops at a boundary that the old text has too, after the edit.
    """

    def __init__(self, encoder: Encoder, text: str):
        self.encoder, self.text = encoder, text
        self.pieces = encoder.pattern.findall(text)
        self.ids_of = [encoder.piece(p) for p in self.pieces]

    def ids(self) -> list[int]:
        return [i for x in self.ids_of for i in x]

    def replace(self, start: int, end: int, new: str) -> int:
        """Put `new` in place of characters start to end; returns how many pieces were matched anew."""
        ends = np.cumsum([len(p) for p in self.pieces])
        keep = int(np.searchsorted(ends, start - 1)) if start else 0
        at = int(ends[keep - 1]) if keep else 0
        text, shift = self.text[:start] + new + self.text[end:], len(new) - (end - start)
        old_ends = {int(e) + shift: i + 1 for i, e in enumerate(ends) if e >= end}
        fresh: list[str] = []
        tail = len(self.pieces)
        while at < len(text):
            if at >= start + len(new) and at in old_ends:
                tail = old_ends[at]
                break
            found = self.encoder.pattern.match(text, at)
            fresh.append(found[0])
            at = found.end()
        self.pieces = self.pieces[:keep] + fresh + self.pieces[tail:]
        self.ids_of = self.ids_of[:keep] + [self.encoder.piece(p) for p in fresh] + self.ids_of[tail:]
        self.text = text
        return len(fresh)


def worker_encoder(lines: bytes, pattern: str) -> Encoder:
    """One encoder per Python worker and vocabulary, with its caches."""
    state, key = worker_state(), ("bpe", hashlib.sha256(lines + pattern.encode()).digest())
    if key not in state:
        state[key] = Encoder(lines, pattern)
    return state[key]


OUTPUTS = {
    "ids": "array<int>", "decoded": "binary", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string",
}


def encode(df: DataFrame, vocabulary_path: str, pattern: str, outputs: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and the asked `outputs` (see OUTPUTS). What is called decoded is decoded from the ids.

    The vocabulary file is read by the driver and sent to the workers (under 2 MB, whatever the data).
    """
    with open(vocabulary_path, "rb") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())
    source = df.select(F.col(id_col).alias("row_key"), F.col(text_col).cast("string").alias("body"))
    kind = source.schema["row_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(sent.value, pattern)
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                ids, bounds = encoder.encode(texts)
                columns = [_output(name, encoder.vocabulary, ids, bounds) for name in outputs]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *columns], names=["row_key", *outputs])
            give_back()

    schema = ", ".join([f"row_key {kind}", *(f"{name} {OUTPUTS[name]}" for name in outputs)])
    return source.mapInArrow(run, schema).withColumnRenamed("row_key", id_col)


def text_slices(column: pa.Array, limit: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Whole texts, about `limit` characters at a time; null counts as empty."""
    held, size, first = [], 0, 0
    for i, text in enumerate(column):
        text = text.as_py() or ""
        if held and size + len(text) > limit:
            yield first, held
            held, size, first = [], 0, i
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def _output(name: str, vocabulary: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    if name == "ids":
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
    if name == "n_tokens":
        return pa.array(np.diff(bounds), pa.int64())
    if name == "ids_sha256":
        flat, starts, lengths, cut = vocabulary.digits, vocabulary.digit_starts, vocabulary.digit_lengths, 1
    else:
        flat, starts, lengths, cut = vocabulary.bytes, vocabulary.starts, vocabulary.lengths, 0
    data = gather(flat, starts[ids], lengths[ids])
    at = np.concatenate([[0], np.cumsum(lengths[ids])])[bounds]
    view = memoryview(np.ascontiguousarray(data))
    spans = [(a, max(a, b - cut)) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    if name == "decoded":
        return pa.array([bytes(view[a:b]) for a, b in spans], pa.binary())
    return pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in spans])

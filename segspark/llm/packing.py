"""Harmonic packing of tokenized documents into sequences of bounded length.

Piece lengths fall into reciprocal classes: class k holds lengths up to capacity / k, and a bin of
class k is full with exactly k pieces, whichever they are. So a bin is filled by counting, and every
task fills its own bins without talking to another: there is no shuffle.

To leave little padding, documents are cut where classes are tight. A document gives whole
sequences (class 1), then at most one piece each of capacity / 2, / 4, / 8 and / 16 (these fill their
bins exactly), then one rest shorter than capacity / 16, whose class has k > 16 and whose bins are
therefore at least k / (k + 1) full. At the end of a task the open bins hold less than one sequence
per class; their pieces are joined in order and cut anew at the capacity, and the very last, partial
sequence is cut into powers of two, which need no padding. A task keeps at most one sequence per
class in memory.

Sequence ids hold the number of the partition, so they are unique, and equal if a task is repeated
on the same partition. Results for odd cases: a null or empty text is one token, the end id. Texts are
tokenized whole, in any length. Repeated rows are packed one by one; a null id stays null; an empty
table gives no pieces. Only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segspark.llm.piece_cache import give_back, worker_state
from segspark.llm.span_cache import SpanCache
from segspark.llm.text_arrays import BYTE_HASH, SLICE_BYTES, SPACE, Rolling, Slice, slices, words

CAPACITY = 2048
#: Sequences of one partition have ids from partition * SEQUENCES on.
SEQUENCES = 1 << 40
#: Bytes of text taken at a time; arrays over them take some 70 bytes for each.
SLICE = SLICE_BYTES // 4
#: Plain words given to the tokenizer in one text.
TOGETHER = 1000

# Of bytes: letters of Latin words (A-Z, a-z and, after 0xC3, all but the signs 0x97 and 0xB7), and signs that may follow them.
_LETTER, _SIGN = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN[list(b".,;:!?#*$%&|")] = True


def _after(x: np.ndarray, value: int) -> np.ndarray:
    """True at every byte that follows one of this value."""
    out = np.zeros(len(x), bool)
    out[1:] = x[:-1] == value
    return out


def pieces(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, start and end of the spans that are encoded one by one, and the first span of each document.

    Spans are runs without white space: the tokenizer drops white space and never joins across it. A run that is a
    word of Latin letters with signs after it is two spans, as to the tokenizer, which also lower-cases.
    """
    data, found = part.data, words(part)
    latin = _after(data, 0xC3) & (data >= 0x80) & (data < 0xC0) & (data != 0x97) & (data != 0xB7)
    letter = _LETTER[data] | latin
    letter[:-1] |= latin[1:]
    lower = data.copy()
    lower[((data >= 65) & (data <= 90)) | (latin & (data < 0x9F))] += 32
    others = np.concatenate([[0], np.cumsum(~letter)])
    last = np.maximum.accumulate(np.where(_SIGN[data], -1, np.arange(len(data)))) + 1 if len(data) else np.zeros(0, np.int64)
    word_end = np.maximum(last[found.end - 1], found.start) if len(found.end) else found.end
    two = (word_end > found.start) & (word_end < found.end) & (others[word_end] == others[found.start])
    times = 1 + two
    place = np.cumsum(times) - times
    start, end = np.repeat(found.start, times), np.repeat(found.end, times)
    end[place[two]] = word_end[two]
    start[place[two] + 1] = word_end[two]
    return lower, start, end, np.concatenate([place, [len(start)]])[found.bounds]


_PLAIN = re.compile("[a-zà-öø-ÿß]+")


class WordEncoder:
    """Ids of spans. Plain words are encoded many in a text, where the tokenizer tells which ids are whose."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def __call__(self, spans: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.zeros(len(spans), np.int64)
        ids = [None] * len(spans)
        plain = [i for i, s in enumerate(spans) if _PLAIN.fullmatch(s)]
        for first in range(0, len(plain), TOGETHER):
            some = plain[first : first + TOGETHER]
            encoded = self.tokenizer.encode(" ".join([spans[i] for i in some]), add_special_tokens=False)
            owner = np.array(encoded.word_ids, np.int64)
            bounds = np.searchsorted(owner, np.arange(len(some) + 1)).tolist()
            if len(owner) == 0 or owner[-1] != len(some) - 1:
                raise ValueError("the tokenizer does not keep words apart")
            found = encoded.ids
            for k, i in enumerate(some):
                ids[i] = found[bounds[k] : bounds[k + 1]]
        rest = [i for i in range(len(spans)) if ids[i] is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([spans[i] for i in rest], add_special_tokens=False)):
            ids[i] = e.ids
        lengths[:] = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((x for found in ids for x in found), np.int32, int(lengths.sum())), lengths


def worker_tokens(definition: str) -> SpanCache:
    """The tokenizer of this worker with the spans it has seen."""
    state, key = worker_state(), ("tokenizer", hashlib.sha256(definition.encode()).digest())
    if key not in state:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        state[key] = SpanCache(WordEncoder(Tokenizer.from_str(definition)))
    return state[key]


def cut_at_space(part: Slice, limit: int) -> list[Slice]:
    """A long document in pieces of about `limit` bytes, cut where white space is; other slices as they are."""
    if len(part) != 1 or len(part.data) <= 2 * limit:
        return [part]
    out, data = [], part.data
    while len(data) > 2 * limit:
        at, gap = limit, np.zeros(0, np.int64)
        while at < len(data) and not len(gap):
            gap = np.flatnonzero(SPACE[data[at : at + limit]])
            at += int(gap[0]) if len(gap) else limit
        if at >= len(data):
            break
        out.append(Slice(part.first, data[:at], np.array([0, at])))
        data = data[at:]
    return [*out, Slice(part.first, data, np.array([0, len(data)]))]


def token_ids(cache: SpanCache, part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the slice's documents, and where each document's begin (one more than documents)."""
    cut = cut_at_space(part, SLICE)
    if len(cut) > 1:
        ids = np.concatenate([token_ids(cache, x)[0] for x in cut])
        return ids, np.array([0, len(ids)])
    lower, start, end, bounds = pieces(part)
    ids, counts = cache.ids(lower, start, end, Rolling(BYTE_HASH[lower]).spans(start, end))
    return ids, np.concatenate([[0], np.cumsum(counts)])[bounds]


def cuts(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Piece lengths of a document: whole sequences, exact classes from large to small, the rest."""
    out = [capacity] * (tokens // capacity)
    left, size = tokens % capacity, capacity // 2
    while left and size >= max(1, capacity // 16):
        if left >= size:
            out.append(size)
            left -= size
        size //= 2
    return out + [left] if left else out


class Bins:
    """The bins of one task. Pieces are (document, start, ids, tokens of the document)."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next = capacity, first_sequence
        self.open: dict[int, list[tuple]] = {}

    def add(self, piece: tuple) -> list[tuple]:
        """Rows of the bin that this piece fills, if any."""
        k = self.capacity // len(piece[2])
        held = self.open.setdefault(k, [])
        held.append(piece)
        return self._close(self.open.pop(k)) if len(held) == k else []

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        rows, offset = [], 0
        for document, start, ids, tokens in pieces:
            rows.append((document, start, ids, tokens, self.next, offset))
            offset += len(ids)
        self.next += 1
        return rows

    def rest(self) -> list[tuple]:
        """All open pieces, one after another, cut at the capacity and at last at powers of two."""
        pieces = [p for k in sorted(self.open) for p in self.open[k]]
        left, rows, held = sum(len(p[2]) for p in pieces), [], []
        room = self._room(left)
        for document, start, ids, tokens in pieces:
            while len(ids):
                part, ids = ids[:room], ids[room:]
                held.append((document, start, part, tokens))
                start, room, left = start + len(part), room - len(part), left - len(part)
                if not room:
                    rows += self._close(held)
                    held, room = [], self._room(left)
        self.open = {}
        return rows

    def _room(self, left: int) -> int:
        return self.capacity if left >= self.capacity else 1 << max(0, left.bit_length() - 1)


def pack(
    df: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and its ids if asked for).

    `capacity` is a power of two from 16 on. The tokenizer's definition is read by the driver and sent
    to the workers (a few MB, whatever the data).
    """
    if capacity < 16 or capacity & (capacity - 1):
        raise ValueError("capacity: a power of two from 16 on")
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())
    source = df.select(F.col(id_col).alias("row_key"), F.col(text_col).cast("string").alias("body"))
    kind = source.schema["row_key"].dataType.simpleString()
    names = ["row_key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]

    def table(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
        columns = [
            pa.array([r[0] for r in rows], key_type),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([len(r[2]) for r in rows], pa.int64()),
            pa.array([zlib.crc32(r[2].astype("<u4").tobytes()) for r in rows], pa.int64()),
            *(pa.array([r[i] for r in rows], pa.int64()) for i in (3, 4, 5)),
        ]
        if with_ids:
            columns.append(pa.array([r[2] for r in rows], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_tokens(sent.value)
        bins = Bins(capacity, TaskContext.get().partitionId() * SEQUENCES)
        for batch in batches:
            kind_of_key = batch.column(0).type
            keys = batch.column(0).to_pylist()
            for part in slices(batch.column(1), SLICE):
                ids, bounds = token_ids(cache, part)
                first, rows = part.first, []
                for i in range(len(part)):
                    tokens = np.append(ids[bounds[i] : bounds[i + 1]], np.int32(end_id))
                    start = 0
                    for length in cuts(len(tokens), capacity):
                        rows += bins.add((keys[first + i], start, tokens[start : start + length].copy(), len(tokens)))
                        start += length
                if rows:
                    yield table(rows, kind_of_key)
            give_back()
        if bins.open:
            yield table(bins.rest(), kind_of_key)

    schema = f"row_key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return source.mapInArrow(run, schema).withColumnRenamed("row_key", id_col)

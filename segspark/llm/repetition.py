"""Quality rules by repetition: how much of a text lies inside duplicated n-grams and lines.

For every document, rolling 64-bit hashes of words, of word n-grams of several lengths and of
lines are compared within the document, with numpy over many documents at once. An n-gram of the
next length can repeat only where its two shorter n-grams do, so lengths after the first look at
few places. Nothing leaves a row's task: there is no shuffle, at any size of the input.

Results for odd cases: a null text counts as empty; an empty text has no words, fails the base
rule and is not kept. Very long texts are whole in one slice. Repeated rows and ties give one
row each. An empty table gives an empty result. Columns other than id and text are not read, so
their names cannot clash; a null id stays null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segspark.llm.piece_cache import give_back
from segspark.llm.text_arrays import Rolling, Slice, byte_hashes, code_points, lines, mix, repeated, slices, words

# Per length in words, the percentage of a text's word characters that may lie in
# duplicated n-grams of that length, and the same for lines. Every copy counts, the first included, so
# a header that comes again as a footer counts twice; the limits leave room for that in short texts.
NGRAM_PERCENT = {5: 40, 6: 38, 7: 36, 8: 34, 9: 32, 10: 30}
LINE_PERCENT, LINE_CHAR_PERCENT = 50, 30


@dataclass(frozen=True)
class RepetitionRules:
    """A text fails a rule when its share is above the percentage."""

    ngram_percent: dict[int, int] = field(default_factory=lambda: dict(NGRAM_PERCENT))
    line_percent: int = LINE_PERCENT
    line_char_percent: int = LINE_CHAR_PERCENT
    window: int = 8
    window_percent: int = 30
    least_words: int = 20
    symbols: str = "#*$%&|<>"


def repetition_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: RepetitionRules | None = None) -> DataFrame:
    """Per row: the counts, `dup_chars_N` for every length N, the base rule and the verdict."""
    rules = rules or RepetitionRules()
    source = df.select(F.col(id_col).alias("row_key"), F.col(text_col).cast("string").alias("body"))
    lengths = sorted(rules.ngram_percent)
    names = [
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "dup_line_chars", "n_repeat_words",
        *(f"dup_chars_{n}" for n in lengths),
    ]
    kind = source.schema["row_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [measure(part, rules) for part in slices(batch.column(1))]
            columns = {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in names}
            base, kept = judge(columns, rules)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(columns[k], pa.int64()) for k in names), pa.array(base), pa.array(kept)],
                names=["row_key", *names, "base_failed", "kept"],
            )
            give_back()

    schema = f"row_key {kind}, {', '.join(f'{k} long' for k in names)}, base_failed boolean, kept boolean"
    out = source.mapInArrow(run, schema)
    return out.withColumnRenamed("row_key", id_col)


def measure(part: Slice, rules: RepetitionRules) -> dict[str, np.ndarray]:
    found, hashes = words(part), byte_hashes(part)
    first = code_points(part)
    at = np.concatenate([[0], np.cumsum(first)])
    chars = at[found.end] - at[found.start]
    symbol = np.zeros(256, bool)
    symbol[list(rules.symbols.encode())] = True
    before = np.concatenate([[0], np.cumsum(chars)])  # word characters before each word
    bounds = found.bounds
    out = {
        "n_words": np.diff(bounds),
        "word_chars": np.diff(before[bounds]),
        "n_symbols": part.per_document(np.flatnonzero(symbol[part.data])),
    }

    start, end, doc = lines(part)
    low, high = np.searchsorted(found.start, start), np.searchsorted(found.start, end)
    start, end, doc, low, high = (x[high > low] for x in (start, end, doc, low, high))
    key = mix(hashes.spans(start, end) + np.uint64(0x5851F42D4C957F2D) * (end - start).astype(np.uint64)) + mix(doc.astype(np.uint64))
    again = np.ones(len(key), bool)
    again[np.unique(key, return_index=True)[1]] = False  # all but the first of equal lines
    per_doc = lambda x: np.bincount(doc, x, len(part)).astype(np.int64)
    out |= {"n_lines": per_doc(np.ones(len(doc))), "n_dup_lines": per_doc(again), "dup_line_chars": per_doc(again * (before[high] - before[low]))}

    grams = Rolling(mix(hashes.spans(found.start, found.end)))
    owner = np.repeat(np.arange(len(part)), np.diff(bounds))
    left = bounds[1:][owner] - np.arange(len(owner))  # words from here to the document's end
    salt = mix(owner.astype(np.uint64))
    places, length = None, 0
    for n in sorted({*rules.ngram_percent, rules.window}):
        if places is None:
            places = np.flatnonzero(left >= n)
        else:  # the shorter n-grams at both ends repeat
            dup = np.zeros(len(owner) + n, bool)
            dup[places] = True
            places = places[(left[places] >= n) & dup[places + n - length]]
        places = places[repeated(mix(grams.spans(places, places + n)) + salt[places])]
        length = n
        edge = np.zeros(len(owner) + 1, np.int64)
        np.add.at(edge, places, 1)
        np.add.at(edge, places + n, -1)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
        if n == rules.window:
            out["n_repeat_words"] = np.diff(covered[bounds])
        if n in rules.ngram_percent:
            inside = np.diff(covered).astype(bool)
            out[f"dup_chars_{n}"] = np.diff(np.concatenate([[0], np.cumsum(chars * inside)])[bounds])
    return out


def judge(c: dict[str, np.ndarray], rules: RepetitionRules) -> tuple[np.ndarray, np.ndarray]:
    base = (c["n_words"] < rules.least_words) | (100 * c["n_repeat_words"] > rules.window_percent * c["n_words"])
    bad = base | (100 * c["n_dup_lines"] > rules.line_percent * c["n_lines"])
    bad |= 100 * c["dup_line_chars"] > rules.line_char_percent * c["word_chars"]
    for n, percent in rules.ngram_percent.items():
        bad |= 100 * c[f"dup_chars_{n}"] > percent * c["word_chars"]
    return base, ~bad


def repetition_filter(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: RepetitionRules | None = None) -> DataFrame:
    """The rows of `df`, all columns, that the rules keep. Judged row by row: no join back is needed."""
    rules = rules or RepetitionRules()
    schema, at = df.schema, df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [judge(measure(part, rules), rules)[1] for part in slices(batch.column(at))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))
            give_back()

    return df.mapInArrow(run, schema)

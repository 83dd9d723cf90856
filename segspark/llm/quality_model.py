"""Quality scores by histogram gradient-boosted trees over document statistics.

Statistics of a document (shares of kinds of characters, word and line shapes, repetition) come from
numpy over many documents at once. Trees are fitted on the statistics of at most `sample` labelled
rows, the ones with the smallest hash of their id (a few MB on the driver, whatever the data): values are
put into quantile bins, and each level of a tree is found from histograms of gradients. The fitted
forest is five flat arrays; scoring walks all trees for all documents of a batch together, one gather per
level.

Results for odd cases: a null or empty text has all statistics 0 and gets that row's score. Texts are
read whole. Rows without a label are not learnt from; with one class only the score is 0 or 1, without
labels 0.5. Repeated rows get equal scores; an empty table an empty result; a null id stays null. Only
the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segspark.llm.repetition import RepetitionRules, measure
from segspark.llm.text_arrays import Slice, byte_hashes, code_points, lines, mix, slices, words

SAMPLE = 20_000
TREES, DEPTH, RATE, BINS, PENALTY, LEAST_WEIGHT = 80, 4, 0.15, 64, 1.0, 1.0

# Kinds of bytes whose share of a text is a statistic.
_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "space": b" \t\n\x0b\x0c\r", "newline": b"\n", "stop": b".?!", "exclamation": b"!", "comma": b",;:", "quote": b"'\"`",
    "bracket": b"()[]{}<>", "symbol": b"#*$%&|<>", "bar": b"|", "slash": b"/\\_-=+@~^",
}
STATISTICS = [
    "log_chars", "log_words", "log_lines", *(f"share_{k}" for k in _KINDS), "share_other", "byte_entropy",
    "word_mean", "word_spread", "word_longest", "short_words", "shouted_words", "plain_words", "odd_ended_words", "new_words", "top_word", "same_as_last",
    "words_per_line", "ended_lines", "dup_lines", "dup_line_chars", "repeat_words", "dup_chars_3", "dup_chars_5",
]
_RULES = RepetitionRules(ngram_percent={3: 100, 5: 100})


def statistics(part: Slice) -> np.ndarray:
    """(documents, STATISTICS) of a slice."""
    n, data = len(part), part.data
    size = np.diff(part.offsets)
    doc = np.repeat(np.arange(n), size)
    chars = part.per_document(np.flatnonzero(code_points(part)))
    share = lambda count, of: np.where(of > 0, count / np.maximum(of, 1), 0.0)
    kinds = np.bincount(doc * 256 + data, minlength=256 * n).reshape(n, 256) if n else np.zeros((0, 256))
    found = words(part)
    start, end, bounds = found.start, found.end, found.bounds
    counts = measure(part, _RULES)
    n_words, owner = np.diff(bounds), np.repeat(np.arange(n), np.diff(bounds))
    per_doc = lambda x: np.bincount(owner, x, n)

    at = np.concatenate([[0], np.cumsum(code_points(part))])
    length = (at[end] - at[start]).astype(float)
    member = {k: np.concatenate([[0], np.cumsum(np.isin(data, list(_KINDS[k])))]) for k in ("upper", "lower")}
    high = np.concatenate([[0], np.cumsum(data >= 128)])
    inside = lambda x: x[end] - x[start]
    upper, lower, other = inside(member["upper"]), inside(member["lower"]), inside(high)
    letters = upper + lower + other
    last = data[end - 1] if len(end) else data[:0]
    mean = share(per_doc(length), n_words)

    key = mix(byte_hashes(part).spans(start, end)) + mix(owner.astype(np.uint64))
    _, first, times = np.unique(key, return_index=True, return_counts=True)
    top = np.zeros(n)
    np.maximum.at(top, owner[first], times)
    same = np.zeros(len(key))
    same[1:] = key[1:] == key[:-1]

    line_start, line_end, line_doc = lines(part)
    filled = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    ended = filled & np.isin(data[np.maximum(line_end - 1, 0)] if len(data) else np.zeros(len(line_end), np.uint8), list(b".?!\"'"))
    frequency = share(kinds, size[:, None])
    entropy = -(frequency * np.log2(np.where(frequency > 0, frequency, 1))).sum(axis=1)
    columns = [
        np.log1p(chars), np.log1p(n_words), np.log1p(counts["n_lines"]),
        *(share(kinds[:, list(own)].sum(axis=1), size) for own in _KINDS.values()),
        share(kinds[:, 128:].sum(axis=1), size), entropy,
        mean, np.sqrt(np.maximum(share(per_doc(length**2), n_words) - mean**2, 0)), _longest(owner, length, n),
        share(per_doc(length <= 3), n_words), share(per_doc((upper > 1) & (lower == 0)), n_words),
        share(per_doc(letters >= inside(np.arange(len(data) + 1)) - 1), n_words),
        share(per_doc(np.isin(last, list(b"!#*$%&|<>"))), n_words),
        share(np.bincount(owner[first], minlength=n), n_words), share(top, n_words), share(per_doc(same), n_words),
        share(n_words, counts["n_lines"]), share(np.bincount(line_doc, ended, n), counts["n_lines"]),
        share(counts["n_dup_lines"], counts["n_lines"]), share(counts["dup_line_chars"], counts["word_chars"]),
        share(counts["n_repeat_words"], n_words), share(counts["dup_chars_3"], counts["word_chars"]), share(counts["dup_chars_5"], counts["word_chars"]),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def _longest(owner: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n)
    np.maximum.at(out, owner, length)
    return out


@dataclass
class Forest:
    """Trees in flat arrays. Node i sends values <= threshold[i] to left[i], others to right[i]; a leaf leads to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    intercept: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        if not len(self.roots):
            return np.full(len(x), self.intercept)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.intercept + self.value[at].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Forest:
    """Boosting with logistic loss. `x`: (rows, features); `y`: 0 or 1, both present."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], axis=1)
    share = y.mean()
    intercept = float(np.log(share / (1 - share)))
    raw = np.full(n, intercept)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(g: float, h: float) -> int:
        feature.append(0)
        threshold.append(np.float32(0))
        value.append(-rate * g / (h + PENALTY))
        left.append(len(left))
        right.append(len(right))
        return len(value) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        roots.append(leaf(g.sum(), h.sum()))
        node = np.zeros(n, np.int64)  # place in the level's list
        level, place = [roots[-1]], np.full(n, roots[-1])
        for _ in range(depth):
            live = np.flatnonzero(node >= 0)
            flat = ((node[live, None] * width + np.arange(width)) * bins + binned[live]).ravel()
            size = len(level) * width * bins
            shape = (len(level), width, bins)
            hist_g = np.bincount(flat, np.repeat(g[live], width), size).reshape(shape)
            hist_h = np.bincount(flat, np.repeat(h[live], width), size).reshape(shape)
            gl, hl = hist_g.cumsum(axis=2), hist_h.cumsum(axis=2)
            total_g, total_h = gl[:, :1, -1:], hl[:, :1, -1:]
            gr, hr = total_g - gl, total_h - hl
            gain = gl**2 / (hl + PENALTY) + gr**2 / (hr + PENALTY) - total_g**2 / (total_h + PENALTY)
            gain[(hl < LEAST_WEIGHT) | (hr < LEAST_WEIGHT)] = -1
            best = gain.reshape(len(level), -1).argmax(axis=1)
            children, moved = [], np.full(n, -1)
            for i, at in enumerate(level):
                f, b = divmod(int(best[i]), bins)
                if gain[i, f, b] <= 1e-6 or b >= len(edges[f]):
                    continue
                mine = live[node[live] == i]
                low = binned[mine, f] <= b
                feature[at], threshold[at] = f, np.float32(edges[f][b])
                for part, (gs, hs), side in ((mine[low], (gl[i, f, b], hl[i, f, b]), left), (mine[~low], (gr[i, f, b], hr[i, f, b]), right)):
                    side[at] = leaf(gs, hs)
                    moved[part] = len(children)
                    place[part] = side[at]
                    children.append(side[at])
            node, level = moved, children
            if not level:
                break
        raw += np.array(value)[place]
    ints = lambda v: np.array(v, np.int32)
    return Forest(ints(feature), np.array(threshold, np.float32), ints(left), ints(right), np.array(value), ints(roots), depth, intercept)


def _table_of_statistics(df: DataFrame) -> DataFrame:
    """(y, statistics) of rows (y, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                x = statistics(part)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, len(part)), lists], names=["y", "x"])

    return df.mapInArrow(run, "y int, x array<float>")


def fit(df: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Forest:
    """Learn from the rows of `df` that `labels` (`id_col`, `label_col` 0 or 1) covers, at most `sample` of them."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("key")).agg(F.max(label_col).cast("int").alias("y"))
    # Ids are drawn from the labels alone; the texts of those that are drawn follow by a broadcast join.
    keys = known.orderBy(F.xxhash64("key"), "key").limit(sample)
    texts = df.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    rows = texts.join(F.broadcast(keys), "key").groupBy("key", "y").agg(F.min("body").alias("body")).select("y", "body")
    learnt = _table_of_statistics(rows).toArrow()
    y = learnt["y"].to_numpy().astype(float)
    x = np.array(learnt["x"].to_pylist(), np.float32).reshape(len(y), len(STATISTICS))
    if not len(y) or y.min() == y.max():
        none = np.zeros(0, np.int32)
        return Forest(none, none.astype(np.float32), none, none, none.astype(float), none, 0, 0.0 if not len(y) else (40.0 if y[0] else -40.0))
    order = np.lexsort((*x.T, y))  # the same forest whatever the order in which rows arrive
    return grow(x[order], y[order])


def score(df: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score."""
    sent = df.sparkSession.sparkContext.broadcast(vars(forest))  # plain values: workers need not import this package
    source = df.select(F.col(id_col).alias("row_key"), F.col(text_col).cast("string").alias("body"))
    kind = source.schema["row_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest(**sent.value)
        for batch in batches:
            for part in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, len(part)), pa.array(forest.probability(statistics(part)))], names=["row_key", "score"]
                )

    return source.mapInArrow(run, f"row_key {kind}, score double").withColumnRenamed("row_key", id_col)

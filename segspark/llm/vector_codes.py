"""Short codes for vectors: product quantization whose nearest entries come from equal-average search.

Components become integers (floor of `scale` times the component), so sums, distances and codebooks are
exact and a repeated task gives the same result. A vector is cut into equal consecutive parts, each
with a codebook of its own, refined by rounds of assigning and averaging.

Equal-average search: for two parts of d components, (difference of sums)^2 / d is never above their
squared distance. A codebook's entries are sorted by component sum; the search begins at the part's own sum and
expands outward in both directions until the squared gap of sums over d strictly exceeds the best distance so
far. Strictly, so that an equally near entry of lower index is still met. Parts of similar sum are searched together in
numpy, the entries a block at a time; a block's distances are one matrix product.

At scale: a round is one pass over the table; each task sends one row per used entry and component (sums
and counts), whatever its number of rows, and only the codebooks (parts x entries x width) are
on the driver. Nothing else is shuffled but one (label, error) row per vector for the sums by label, reduced before
the shuffle; the label's sum comes back by an equi-join that adaptive execution may split.

Results for odd cases: rows with a null vector, or a null or non-finite component, are dropped. The width is that
of the longest kept vector, rounded up to a whole number per part; shorter vectors count as if filled up with
zeros. Integers beyond +-2^53 are taken as that bound, and errors beyond a long as the largest long. The
starting entries are the rows of smallest id (null ids last; among equal ids the smaller vector); with fewer rows
there are fewer entries. Repeated rows are coded one by one; a null id stays null. An empty table gives
no rows. Only id, vector and label are read into names of our own, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LARGEST = 1 << 53
MOST_ERROR = (1 << 63) - 1
#: Parts searched together, and entries met at a time on each side.
GROUP, BLOCK = 256, 32


def integers(vectors: pa.Array, width: int, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """The kept rows' numbers and their integer components as float64 (whole numbers, at most 2^53)."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    flat = vectors.flatten()  # without what null rows may hide
    lengths = pc.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = flat.to_numpy(zero_copy_only=False)  # nulls become NaN
    row = np.repeat(np.arange(len(vectors)), lengths)
    keep = vectors.is_valid().to_numpy(zero_copy_only=False).copy()
    keep[row[~np.isfinite(values)]] = False
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.clip(np.floor(values * scale), -LARGEST, LARGEST)
    out = np.zeros((len(vectors), width))
    position = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = keep[row]
    out[row[inside], position[inside]] = whole[inside]
    return np.flatnonzero(keep), out[keep]


class Codebook:
    """Entries of one part position, in the order of their component sums."""

    def __init__(self, entries: list[list[int]]):
        exact = np.array(entries, dtype=object)
        self.width = exact.shape[1]
        totals = exact.sum(axis=1)
        order = sorted(range(len(entries)), key=lambda i: (totals[i], i))
        self.index = np.array(order, np.int64)
        self.entries, self.sums = exact[order], totals[order]
        self.largest = max((abs(x) for e in entries for x in e), default=0)
        self.spare = 1 << max(1, (len(entries) - 1).bit_length())

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lower of equally near ones) and its squared distance, for each row."""
        n = len(parts)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Distances, with the index beneath them, are exact in float64 up to 2^53; beyond, Python's integers are used.
        reach = int(max(np.abs(parts).max(initial=0), self.largest)) * 2 + 1
        small = self.width * reach * reach * self.spare < 1 << 53
        rows = parts.astype(np.float64) if small else np.vectorize(int, otypes=[object])(parts)
        entries, sums = (self.entries.astype(np.float64), self.sums.astype(np.float64)) if small else (self.entries, self.sums)
        own = rows.sum(axis=1)
        order = np.argsort(own, kind="stable")
        code, error = np.empty(n, np.int64), np.empty(n, np.int64 if small else object)
        for first in range(0, n, GROUP):
            at = order[first : first + GROUP]
            best = self._expand(rows[at], own[at], entries, sums)
            code[at] = (best % self.spare).astype(np.int64)
            error[at] = best // self.spare
        return code, error

    def _expand(self, rows: np.ndarray, own: np.ndarray, entries: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Smallest distance * spare + index of each row; rows lie in the order of their sums."""
        norms, entry_norms = (rows * rows).sum(axis=1), (entries * entries).sum(axis=1)

        def meet(active: np.ndarray, low: int, high: int):
            near = norms[active][:, None] - 2 * (rows[active] @ entries[low:high].T) + entry_norms[low:high]
            ranked = (near * self.spare + self.index[low:high]).min(axis=1)
            best[active] = ranked if best[active[0]] is None else np.minimum(best[active], ranked)

        best = np.full(len(rows), None, object) if rows.dtype == object else np.full(len(rows), np.inf)
        low = max(0, int(np.searchsorted(sums, own[0])) - BLOCK // 2)
        high = min(len(sums), max(int(np.searchsorted(sums, own[-1], "right")) + BLOCK // 2, low + 1))
        low = min(low, high - 1)
        meet(np.arange(len(rows)), low, high)
        while low > 0 or high < len(sums):
            reach = (best // self.spare) * self.width  # the search of a row goes on while the gap squared is not above this
            if low > 0:
                gap = np.maximum(own - sums[low - 1], 0)
                active = np.flatnonzero(gap * gap <= reach)
                down = max(0, low - BLOCK) if len(active) else 0
                if len(active):
                    meet(active, down, low)
                low = down
            if high < len(sums):
                gap = np.maximum(sums[high] - own, 0)
                active = np.flatnonzero(gap * gap <= reach)
                up = min(len(sums), high + BLOCK) if len(active) else len(sums)
                if len(active):
                    meet(active, high, up)
                high = up
        return best


def _cut(rows: np.ndarray, part: int, width: int) -> np.ndarray:
    return rows[:, part * width : (part + 1) * width]


class VectorCodec:
    """Fitted codebooks: `codebooks[part][entry]` is a list of whole numbers."""

    def __init__(self, codebooks: list[list[list[int]]], width: int, scale: int = SCALE):
        self.codebooks, self.width, self.scale = codebooks, width, scale

    def sha256(self) -> str:
        """Of all entries' decimal components by part, entry and position, joined by commas; hex."""
        return hashlib.sha256(",".join(str(x) for book in self.codebooks for e in book for x in e).encode()).hexdigest()

    def encode(self, df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: list[str] = ()) -> DataFrame:
        """Id, the columns to keep, code (two hex digits a part, in order) and error of every kept row."""
        books, width, scale, parts = [Codebook(b) for b in self.codebooks if b], self.width, self.scale, len(self.codebooks)
        source = df.select(F.col(vector_col).alias("x"), F.col(id_col).alias("key"), *(F.col(c).alias(f"keep{i}") for i, c in enumerate(keep)))
        kinds = [source.schema[c].dataType.simpleString() for c in source.columns[1:]]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept, rows = integers(batch.column(0), width * parts, scale)
                if not len(kept):
                    continue
                found = [book.nearest(_cut(rows, p, width)) for p, book in enumerate(books)]
                errors = sum(error.astype(object) for _, error in found)
                marks = [f"{i:02x}" for i in range(ENTRIES)]
                codes = ["".join(marks[c] for c in row) for row in zip(*(code.tolist() for code, _ in found))]
                others = [c.take(pa.array(kept)) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays(
                    [*others, pa.array(codes, pa.string()), pa.array([min(int(e), MOST_ERROR) for e in errors], pa.int64())],
                    names=[*batch.schema.names[1:], "code", "error"],
                )

        schema = ", ".join(f"{n} {k}" for n, k in zip(source.columns[1:], kinds)) + ", code string, error long"
        out = source.mapInArrow(run, schema).withColumnRenamed("key", id_col)
        return out.withColumnsRenamed({f"keep{i}": c for i, c in enumerate(keep)})


def _sums(df: DataFrame, vector_col: str, codec: VectorCodec) -> dict[tuple[int, int], list[int]]:
    """Of every used entry the floor of its parts' mean: at most parts x entries rows of `width` numbers."""
    books, width, scale, parts = [Codebook(b) for b in codec.codebooks], codec.width, codec.scale, len(codec.codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b.index), np.int64) for b in books]
        totals = [np.zeros((len(b.index), width), object) for b in books]
        for batch in batches:
            kept, rows = integers(batch.column(0), width * parts, scale)
            if not len(kept):
                continue
            safe = int(np.abs(rows).max(initial=0)) * len(rows) < 1 << 53
            for p, book in enumerate(books):
                mine = _cut(rows, p, width)
                code, _ = book.nearest(mine)
                counts[p] += np.bincount(code, minlength=len(book.index))
                if safe:
                    for j in range(width):
                        totals[p][:, j] += np.bincount(code, mine[:, j], len(book.index)).astype(np.int64).astype(object)
                else:
                    for c, row in zip(code.tolist(), mine.tolist()):
                        totals[p][c] += np.array([int(x) for x in row], object)
        used = [(p, e) for p in range(len(books)) for e in np.flatnonzero(counts[p]).tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in used for _ in range(width)], pa.int32()),
                pa.array([e for _, e in used for _ in range(width)], pa.int32()),
                pa.array([j for _ in used for j in range(width)], pa.int32()),
                pa.array([Decimal(int(x)) for p, e in used for x in totals[p][e]], pa.decimal128(38, 0)),
                pa.array([int(counts[p][e]) for p, e in used for _ in range(width)], pa.int64()),
            ],
            names=["part", "entry", "place", "total", "n"],
        )

    summed = (
        df.select(vector_col).mapInArrow(run, "part int, entry int, place int, total decimal(38,0), n long")
        .groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    means: dict = {}
    for r in summed.collect():
        means.setdefault((r["part"], r["entry"]), [0] * width)[r["place"]] = int(r["total"]) // r["n"]
    return means


def fit(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> VectorCodec:
    """Codebooks from the `entries` rows of smallest id (at most 256), refined over all rows."""
    if not 0 < entries <= ENTRIES:
        raise ValueError(f"entries: 1 to {ENTRIES}, two hex digits a part")
    x = F.col("x")
    whole = df.select(F.col(id_col).alias("key"), F.col(vector_col).cast("array<double>").alias("x")).where(
        x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    )
    longest = whole.agg(F.max(F.size("x"))).first()[0] or 0
    width = -(-longest // parts)
    first = whole.orderBy(F.col("key").asc_nulls_last(), "x").limit(entries)
    vectors = pa.array([r["x"] for r in first.collect()], pa.list_(pa.float64()))
    start = integers(vectors, width * parts, scale)[1]
    books = [[[int(v) for v in row] for row in _cut(start, p, width)] for p in range(parts)]
    codec = VectorCodec(books, width, scale)
    for _ in range(rounds if len(start) and width else 0):
        means = _sums(df, vector_col, codec)
        codec = VectorCodec([[means.get((p, e), old) for e, old in enumerate(book)] for p, book in enumerate(codec.codebooks)], width, scale)
    return codec


def with_label_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """Adds the sum of `error` over rows of equal label, nulls together. `coded` should be a written table."""
    summed = coded.groupBy(F.col(label_col).alias("~label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("~sum"))
    bounded = F.least("~sum", F.lit(MOST_ERROR).cast("decimal(38,0)")).cast("long")
    return coded.join(summed, F.col(label_col).eqNullSafe(F.col("~label"))).withColumn("label_error", bounded).drop("~label", "~sum")

"""All-pairs work in blocks.

Rows are cut into blocks of bounded size; each pair of blocks meets in one task,
which sees two blocks and emits aggregates or a spanning forest, never the pairs.
Blocks travel as a few rows of packed columns. A task works on tiles of both blocks, so
its memory is that of two blocks and a few tiles, and blocks can be large: a row is
shuffled once per block, and there are few blocks.
With a ``reach``, rows are cut along the axis of largest variance and only block
pairs that can hold rows within reach meet: |a.u - b.u| is at most the euclidean,
hence also the manhattan, distance. Copies of one vector are collapsed first, so
a vector that fills a third of the table is a single weighted row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segspark.session import materialize

# Bounds of a block, in rows and in bytes of its vectors: a task holds two blocks.
MOST_ROWS = 65_536
LEAST_ROWS = 128
BLOCK_BYTES = 16 * 1024 * 1024
# A task works on tiles of at most TILE_ROWS x TILE_ROWS distances (8 MB a matrix).
TILE_ROWS = 1024
# Rows that travel together.
PACK_ROWS = 2048


@dataclass(frozen=True)
class Tiles:
    """Blocked rows and, per block, the contiguous range of blocks it must meet."""

    rows: DataFrame
    directory: DataFrame
    blocks: int


def collapse_copies(rows: DataFrame, key: str, x: str, also: Sequence[str] = ()) -> DataFrame:
    """One row per distinct vector (and label): smallest key, number of copies."""
    return rows.groupBy(x, *also).agg(F.min(key).alias(key), F.count("*").cast("double").alias("copies"))


def with_pid(rows: DataFrame) -> DataFrame:
    """Written table with a 64-bit row number, stable because it is stored."""
    return materialize(rows.withColumn("pid", F.monotonically_increasing_id()))


def block_rows(n: int, parallelism: int, most: int) -> int:
    """Rows per block: enough block pairs for every core, never above the bound."""
    return max(min(LEAST_ROWS, most), min(most, math.ceil(n / math.sqrt(4 * parallelism))))


def cut(
    rows: DataFrame, x: str = "x", reach: float | None = None, most: int | None = None, order: Sequence[str] = ()
) -> Tiles:
    """Cut rows (with a ``pid``) into blocks of at most ``most`` rows, fewer where vectors are long.

    With an ``order``, blocks are ranges of these columns.
    """
    spark = rows.sparkSession
    n, width = rows.agg(F.count("*"), F.max(F.size(x))).first()
    most = max(1, min(MOST_ROWS if most is None else most, BLOCK_BYTES // (8 * max(1, width or 1))))
    blocks = max(1, math.ceil(n / block_rows(n, spark.sparkContext.defaultParallelism, most)))
    if order and blocks > 1:
        blocked = materialize(
            rows.repartitionByRange(blocks, *order, "pid").withColumn("_block", F.spark_partition_id())
        )
        used = sorted(r["_block"] for r in blocked.select("_block").distinct().collect())
        ranges = [(b, used[0], used[-1]) for b in used]
    elif reach is None or blocks == 1:
        blocked = rows.withColumn("_block", F.pmod(F.xxhash64("pid"), F.lit(blocks)).cast("int"))
        ranges = [(b, 0, blocks - 1) for b in range(blocks)]
    else:
        blocked = materialize(
            rows.withColumn("_t", _along_main_axis(rows, x))
            .repartitionByRange(blocks, "_t", "pid")
            .withColumn("_block", F.spark_partition_id())
        )
        ranges = _reachable(blocked, reach)
    directory = spark.createDataFrame(ranges, "_block int, _first int, _last int")
    return Tiles(blocked, directory, blocks)


def _along_main_axis(rows: DataFrame, x: str):
    vectors = rows.select(array_to_vector(F.col(x)).alias("v"))
    axis = PCA(k=1, inputCol="v", outputCol="p").fit(vectors).pc.toArray()[:, 0]
    weights = F.array(*[F.lit(float(w)) for w in axis])
    return F.aggregate(F.zip_with(x, weights, lambda a, w: a * w), F.lit(0.0), lambda s, v: s + v)


def _reachable(blocked: DataFrame, reach: float) -> list[tuple[int, int, int]]:
    """Per block the range of blocks within reach along the axis (one small row per block)."""
    spans = {
        r["_block"]: (r["lo"], r["hi"])
        for r in blocked.groupBy("_block").agg(F.min("_t").alias("lo"), F.max("_t").alias("hi")).collect()
    }
    order = sorted(spans)
    slack = reach * (1 + 1e-6) + 1e-9
    lows = np.array([spans[b][0] for b in order])
    highs = np.array([spans[b][1] for b in order])
    first = np.searchsorted(highs, lows - slack, side="left")
    last = np.searchsorted(lows, highs + slack, side="right") - 1
    return [(b, order[int(first[i])], order[int(last[i])]) for i, b in enumerate(order)]


Block = dict[str, np.ndarray]
Kernel = Callable[[Block, Block, bool], pd.DataFrame]


def meet(tiles: Tiles, kernel: Kernel, schema: str, columns: Sequence[str], pairs: str = "all") -> DataFrame:
    """Apply the kernel to every pair of blocks within reach, each unordered pair once.

    The kernel gets the columns of both blocks as arrays (vectors as one matrix) and whether they are the same block.
    ``pairs`` may leave it at blocks with themselves (``own``) or at different blocks (``cross``).
    """
    packs = _packed(tiles.rows, columns).join(tiles.directory, "_block")
    empty = {f.name: pd.Series(dtype="object") for f in T.StructType.fromDDL(schema)}

    def alone(packed: pd.DataFrame) -> pd.DataFrame:
        block = _unpacked(packed["pack"])
        return kernel(block, block, True)

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if key[0] == key[1]:
            return alone(a)
        if a.empty or b.empty:
            return pd.DataFrame(empty)
        return kernel(_unpacked(a["pack"]), _unpacked(b["pack"]), False)

    if pairs == "own":
        return packs.select("_block", "pack").groupBy("_block").applyInPandas(alone, schema)
    left = packs.select(F.col("_block").alias("bi"), F.explode(F.sequence("_block", "_last")).alias("bj"), "pack")
    right = packs.select(
        F.explode(F.sequence("_first", "_block")).alias("bi"), F.col("_block").alias("bj"), F.col("pack").alias("pack")
    ).where("bi < bj")
    left = left.where("bi < bj") if pairs == "cross" else left
    # Pairs are few and long: more partitions than the session's keep two of them from one task.
    spark = tiles.rows.sparkSession
    parts = min(tiles.blocks * (tiles.blocks + 1), 16 * spark.sparkContext.defaultParallelism)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        left, right = left.repartition(parts, "bi", "bj"), right.repartition(parts, "bi", "bj")
    return left.groupBy("bi", "bj").cogroup(right.groupBy("bi", "bj")).applyInPandas(run, schema)


def _packed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(_block, pack): the given columns of up to PACK_ROWS rows of a block as one binary value."""
    columns, most = list(columns), PACK_ROWS

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(0).to_numpy()
            order = np.argsort(block, kind="stable")
            blocks, packs = [], []
            for same in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                for start in range(0, len(same), most):
                    part = same[start : start + most]
                    piece = batch.select(columns).take(pa.array(part))
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, piece.schema) as stream:
                        stream.write_batch(piece)
                    blocks.append(block[part[0]])
                    packs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int32()), pa.array(packs, pa.binary())], ["_block", "pack"]
            )

    return rows.select("_block", *columns).mapInArrow(pack, "_block int, pack binary")


def _unpacked(packs: pd.Series) -> Block:
    table = pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in packs])
    return {
        name: _dense(table.column(name)) if pa.types.is_list(table.schema.field(name).type) else table.column(name).to_numpy()
        for name in table.column_names
    }


def _dense(column: pa.ChunkedArray) -> np.ndarray:
    parts = []
    for chunk in column.chunks:
        widths = np.unique(np.diff(chunk.offsets.to_numpy()))
        if chunk.null_count or len(widths) > 1:
            raise ValueError("all vectors must be of one length, none of them null")
        if len(chunk):
            parts.append(chunk.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(chunk), int(widths[0])))
    return np.concatenate(parts)


def strips(n: int) -> list[slice]:
    return [slice(start, min(n, start + TILE_ROWS)) for start in range(0, n, TILE_ROWS)]


def tile_pairs(rows: int, others: int, same: bool) -> Iterator[tuple[slice, slice]]:
    """The tiles of two blocks; of one block with itself, those on and above the diagonal."""
    for p in strips(rows):
        for q in strips(others):
            if not same or p.start <= q.start:
                yield p, q


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float, copy=False)


def as_rows(df: DataFrame, key: str, features: str, *also: str) -> DataFrame:
    """Key, the feature array (or ML vector) as ``x`` in double, and further columns."""
    kind = df.schema[features].dataType
    x = F.col(features) if isinstance(kind, T.ArrayType) else vector_to_array(features)
    return df.select(F.col(key).alias("key"), x.cast("array<double>").alias("x"), *also)

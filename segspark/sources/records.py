"""Delimited files whose records span lines, read in splits.

A line feed ends a record only outside quotes, and whether a line starts outside quotes depends on
all lines before it. Every split of the scan therefore counts quotes from its own start; a running
sum over one small row per split then tells how each split really began, and so which record every
line belongs to. Lines are brought together by record in one range shuffle. A record can begin and
end in any split, or fill several.
"""

from __future__ import annotations

import csv
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segspark.session import materialize

BOM = "﻿"
# Encodings in which the bytes of a line feed and of a quote mean nothing else.
SPLITTABLE = ("utf-8", "us-ascii", "iso-8859-1")

_LINES = "file string, split long, no long, odd boolean, inside boolean, outer long, inner long, value binary"


def _counted(batches):
    """Per line of a split: its number, whether it holds an odd number of quotes, whether it starts inside quotes
    if the split starts outside them, and how many records have begun up to it if the split starts
    outside (``outer``) or inside (``inner``) quotes."""
    current, no, inside, outer, inner = None, 0, 0, 0, 0
    for batch in batches:
        value, files = batch.column("value"), batch.column("file")
        splits = batch.column("split").to_numpy(zero_copy_only=False)
        odd = pc.count_substring(value, b'"').to_numpy(zero_copy_only=False).astype("int64") & 1
        named = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(splits) != 0) | (np.diff(named) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(odd)]):
            if a == b:
                continue
            split = (files[int(a)].as_py(), int(splits[a]))
            if split != current:
                current, no, inside, outer, inner = split, 0, 0, 0, 0
            part = odd[a:b]
            ends = (inside + np.cumsum(part)) & 1
            starts = np.concatenate([[inside], ends[:-1]])
            outers, inners = outer + np.cumsum(starts == 0), inner + np.cumsum(starts == 1)
            yield pa.RecordBatch.from_arrays(
                [
                    files.slice(a, b - a), pa.array(splits[a:b]), pa.array(np.arange(no, no + b - a)),
                    pa.array(part == 1), pa.array(starts == 1), pa.array(outers), pa.array(inners),
                    value.slice(a, b - a),
                ],
                names=["file", "split", "no", "odd", "inside", "outer", "inner", "value"],
            )
            no, inside, outer, inner = no + b - a, int(ends[-1]), int(outers[-1]), int(inners[-1])


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: whether it starts inside quotes, and the record open at its start."""
    ends_inside = F.max_by(F.col("inside") != F.col("odd"), "no")
    ends = lines.groupBy("file", "split").agg(
        ends_inside.cast("int").alias("flips"), F.max("outer").alias("outer"), F.max("inner").alias("inner")
    )
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.withColumn("carried", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2 == 1)
    begun = carried.withColumn("begun", F.when(F.col("carried"), F.col("inner")).otherwise(F.col("outer")))
    last = F.when(F.col("begun") > 0, F.struct(F.col("split").alias("at"), F.col("begun").alias("number")))
    return begun.select("file", "split", "carried", F.last(last, ignorenulls=True).over(before).alias("open"))


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Every line with the split and number (``at``, ``number``) of the record it belongs to."""
    scan = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("value"),
    )
    lines = materialize(scan.mapInArrow(_counted, _LINES))
    own = F.when(F.col("carried"), F.col("inner")).otherwise(F.col("outer"))
    first = F.when(own > 0, F.struct(F.col("split").alias("at"), own.alias("number"))).otherwise(F.col("open"))
    # Written, so that its size is known before the join is planned.
    splits = materialize(_splits(lines))
    placed = lines.join(splits, ["file", "split"]).withColumn("first", first)
    return placed.select("file", "first.at", "first.number", "split", "no", "value")


def _gathered(placed: DataFrame, encoding: str) -> DataFrame:
    """(file, at, number, record) in file order, blank ones left out.

    The range partitioning that orders the records also brings the lines of each together, so lines
    are shuffled once.
    """
    key = ["file", "at", "number"]
    parts = F.array_sort(F.collect_list(F.struct("split", "no", "value")))
    gathered = placed.repartitionByRange(*key).groupBy(*key).agg(parts.alias("parts")).sortWithinPartitions(*key)
    value = F.expr("aggregate(slice(parts, 2, size(parts)), parts[0].value, (text, part) -> concat(text, X'0A', part.value))")
    text = value.cast("string") if encoding.lower() == "utf-8" else F.decode(value, encoding.upper())
    return gathered.select(*key, F.regexp_replace(text, r"\r\z", "").alias("record")).where(_filled("record"))


def _filled(text) -> Column:
    return (F.col(text) if isinstance(text, str) else text).rlike(r"[^\x00-\x20]")


def _headers(placed: DataFrame) -> DataFrame:
    """(file, place): the record of each file's first line that is not blank."""
    filled = placed.where(_filled(F.col("value").cast("string")))
    return filled.groupBy("file").agg(F.min(F.struct("at", "number")).alias("place"))


def records(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """(file, at, number, record): every record that is not blank, header records included, in file order.

    ``at`` and ``number`` (split and place in it of the record's first line) order a file's records.
    Records end at a line feed; a carriage return before it goes. A quote that is never closed makes
    the rest of its file one record. An empty file has no records.
    """
    return _gathered(_placed(spark, path), encoding)


def _split_header(record: str, sep: str) -> list[str]:
    """Column names as the delimited reader makes them: a place for empty ones, a number after repeated ones."""
    names = next(csv.reader([record.removeprefix(BOM)], delimiter=sep))
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


# Narrowest first; what fits none is text.
_TYPES = {
    "int": lambda c: c.try_cast("int").isNotNull() & c.rlike(r"^[+-]?\d+$"),
    "bigint": lambda c: c.try_cast("bigint").isNotNull() & c.rlike(r"^[+-]?\d+$"),
    "double": lambda c: c.try_cast("double").isNotNull(),
    "date": lambda c: c.try_cast("date").isNotNull() & c.rlike(r"^\d{4}-\d{2}-\d{2}$"),
    "timestamp": lambda c: c.try_cast("timestamp").isNotNull() & c.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?$"),
    "boolean": lambda c: c.rlike("^(?i)(true|false)$"),
}


def _inferred(body: DataFrame, names: list[str], options: dict) -> T.StructType:
    """The narrowest type that holds all values of a column; one aggregate over all records."""
    texts = ", ".join(f"c{i} string" for i in range(len(names)))
    cells = body.select(F.from_csv("record", texts, options).alias("r"))
    misfits = [
        F.count_if(F.col(f"r.c{i}").isNotNull() & ~fits(F.col(f"r.c{i}"))).alias(f"{kind}{i}")
        for i in range(len(names)) for kind, fits in _TYPES.items()
    ]
    filled = [F.count(f"r.c{i}").alias(f"n{i}") for i in range(len(names))]
    seen = cells.agg(*misfits, *filled).first()
    kinds = [next((k for k in _TYPES if seen[f"n{i}"] and not seen[f"{k}{i}"]), "string") for i in range(len(names))]
    return T.StructType([T.StructField(n, T.StructType.fromDDL(f"x {k}")["x"].dataType) for n, k in zip(names, kinds)])


def read_records(
    spark: SparkSession, path: str, sep: str, schema=None, encoding: str = "utf-8",
    surplus: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The table in a delimited file or folder with a header record per file, rows in file order.

    Types not given are found from all values; whole numbers beyond 64 bits count as double.
    Short records are filled with nulls, surplus fields are cut off. ``surplus``, a function from the
    record's text to its number of fields, drops records with more fields than the header instead.
    A file that holds only a header gives no rows, one that holds nothing is an error.
    """
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n"}
    placed = _placed(spark, path)
    headers, place = materialize(_headers(placed)), F.struct("at", "number")
    marked = placed.join(headers, "file")
    header = _gathered(marked.where(place == F.col("place")), encoding).orderBy("file").first()
    if header is None:
        raise ValueError(f"{path} is empty")
    names = _split_header(header["record"], sep)
    body = _gathered(marked.where(place != F.col("place")), encoding)
    if surplus is not None:
        body = body.where(surplus(F.col("record")) <= len(names))
    if schema is None:
        schema = _inferred(body, names, options)
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    ddl = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(schema.fields))
    parsed = body.select(F.from_csv("record", ddl, options).alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(f.name) for i, f in enumerate(schema.fields)])

"""Exact deduplication with a heavy-hitter split.

Texts are equal when identical after deleting every character of [\\x20\\x09-\\x0D]; their SHA-256
stands for them. Of equal texts the row with the most code points in the original text stays,
then the smallest id.

* Every partition summarises its digests with `counters` Misra-Gries counters. A summary counts a
  digest too low by at most rows / (counters + 1), so a digest with a share above `share` of all rows
  keeps a counter sum of at least (share - 1 / (counters + 1)) * rows. At most
  1 / (share - 1 / (counters + 1)) digests can reach that sum (512 by default): a bound on what is
  broadcast that does not grow with the data.
* The candidates' true sizes and winners are then aggregated from the rows (with map-side
  reduction) and broadcast; rows of frequent digests are settled where they lie, without a shuffle.
* All other digests go through an ordinary aggregate and an equi-join on the digest, which
  adaptive execution may split.

Results for odd cases: a null text counts as empty, empty texts are equal to each other. A null id
sorts after every other id. Rows that are repeated, id included, count one by one; one of them stays
(`exact_duplicates` marks it by a row number of its own). An empty table gives an empty result.
Only id and text are read into names of our own, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segspark.llm.id_filter import split_by_bitmap
from segspark.session import materialize

SHARE = 1 / 256
COUNTERS = 511


def text_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text without white space."""
    return F.sha2(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[ \\t-\\r]+", ""), 256)


def misra_gries(digests: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """At most `counters` rows (`column`, counter) per partition; a counter is too low by rows / (counters + 1) at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for pair in pc.value_counts(batch.column(0)).to_pylist():
                if pair["values"] is not None:
                    held[pair["values"]] = held.get(pair["values"], 0) + pair["counts"]
            if len(held) > counters:
                sizes = np.fromiter(held.values(), np.int64, len(held))
                cut = int(np.partition(sizes, len(sizes) - counters - 1)[len(sizes) - counters - 1])
                held = {k: v - cut for k, v in held.items() if v > cut}
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=[column, "counter"])

    return digests.select(column).mapInArrow(run, f"{column} string, counter long")


def heavy_candidates(digests: DataFrame, column: str, rows: int, share: float = SHARE, counters: int = COUNTERS) -> DataFrame:
    """A superset of the values with more than `share` of the rows; at most 1 / (share - 1 / (counters + 1)) rows."""
    least = max(1.0, (share - 1 / (counters + 1)) * rows)
    summed = misra_gries(digests, column, counters).groupBy(column).agg(F.sum("counter").alias("counter"))
    return summed.filter(F.col("counter") >= F.lit(least)).select(column)


def _winner() -> list[Column]:
    best = F.min(F.struct((-F.col("chars")).alias("c"), F.col("row_id").isNull().alias("n"), F.col("row_id").alias("i"), F.col("row_nr").alias("r")))
    return [F.count(F.lit(1)).alias("group_size"), best.alias("best")]


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, counters: int = COUNTERS) -> DataFrame:
    """One row per row of `df`: id, keep_id, group_size, kept, text_sha256."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = materialize(
        df.select(
            F.col(id_col).alias("row_id"), text_digest(F.col(text_col)).alias("digest"),
            F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row_nr"),
        )
    )
    candidates = heavy_candidates(rows, "digest", rows.count(), share, counters)
    heavy = materialize(
        rows.join(F.broadcast(candidates), "digest", "left_semi").groupBy("digest").agg(*_winner()).filter("group_size > 1")
    )
    frequent = rows.join(F.broadcast(heavy), "digest")
    rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    groups = rest.groupBy("digest").agg(*_winner()).filter("group_size > 1")
    settled = frequent.unionByName(rest.join(groups, "digest", "left"))
    alone = F.col("best").isNull()
    return settled.select(
        F.col("row_id").alias(id_col),
        F.when(alone, F.col("row_id")).otherwise(F.col("best.i")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row_nr") == F.col("best.r"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, counters: int = COUNTERS) -> DataFrame:
    """The rows of `df`, all columns, that stay. Only rows whose id a bitmap finds among those that go are shuffled."""
    marked = materialize(exact_duplicates(df, id_col, text_col, share, counters))
    keys = [F.col(id_col).alias("gone_id"), F.col("text_sha256").alias("gone_digest")]
    kept = marked.filter("kept")
    # A key may both stay and go only where whole rows are repeated; those are settled below.
    gone = materialize(marked.filter("not kept").select(*keys).distinct())
    twice = gone.join(kept.select(F.col(id_col).alias("k"), F.col("text_sha256").alias("d")),
                      F.col("gone_id").eqNullSafe(F.col("k")) & (F.col("gone_digest") == F.col("d")), "left_semi")
    twice = materialize(twice)

    rows = df.select(F.struct("*").alias("row"), F.col(id_col).alias("row_id"))
    sure, unsure = split_by_bitmap(rows, "row_id", gone.select("gone_id"))
    keyed = unsure.withColumn("digest", text_digest(F.col("row").getField(text_col)))

    def matches(other: DataFrame) -> Column:
        return keyed["row_id"].eqNullSafe(other["gone_id"]) & (keyed["digest"] == other["gone_digest"])

    stay = sure.select("row").unionByName(keyed.join(gone, matches(gone), "left_anti").select("row"))
    if not twice.isEmpty():
        again = keyed.join(twice, matches(twice), "left_semi")
        longest = again.groupBy("row_id", "digest").agg(F.max_by("row", F.coalesce(F.length(F.col("row").getField(text_col).cast("string")), F.lit(-1))).alias("row"))
        stay = stay.unionByName(longest.select("row"))
    return stay.select("row.*")

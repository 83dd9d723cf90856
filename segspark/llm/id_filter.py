"""Telling cheaply which rows cannot be among some ids, before a join that would shuffle their texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segspark.session import materialize

BITS = 1 << 23


def split_by_bitmap(rows: DataFrame, id_col: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose id is certainly not in `ids`, rows whose id may be). `ids` has one column.

    The ids' hashes set bits of a bitmap of fixed size, at most BITS / 64 rows of two numbers, which is
    broadcast whatever the data. A null id hashes like any other. The more ids, the more rows may be
    among them; the join that follows decides.
    """
    slot = F.pmod(F.xxhash64(ids.columns[0]), F.lit(BITS))
    bits = F.bit_or(F.expr("shiftleft(1L, CAST(slot % 64 AS INT))")).alias("bitmap word")
    words = materialize(ids.select(slot.alias("slot")).groupBy(F.expr("slot div 64").alias("bitmap place")).agg(bits))
    own = rows.withColumn("bitmap slot", F.pmod(F.xxhash64(id_col), F.lit(BITS))).withColumn("bitmap place", F.expr("`bitmap slot` div 64"))
    marked = own.join(F.broadcast(words), "bitmap place", "left")
    may = F.coalesce(F.expr("getbit(`bitmap word`, CAST(`bitmap slot` % 64 AS INT)) = 1"), F.lit(False))
    return marked.filter(~may).select(*rows.columns), marked.filter(may).select(*rows.columns)

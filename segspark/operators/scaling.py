"""Column transforms that depend on statistics of the whole column.

The statistics are one-row scalar subqueries: the plan stays one lazy job and
nothing is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segspark.functions.columns import clipped
from segspark.operators.quantiles import exact_quantiles


def row_scalar(one_row: DataFrame) -> Column:
    """A one-row table as a struct value usable in expressions over another table."""
    return one_row.select(F.struct(*one_row.columns)).scalar()


def winsorize(
    df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99
) -> DataFrame:
    """Clip each column to its own quantiles; nulls untouched, column types widen to double."""
    bounds = row_scalar(exact_quantiles(df, columns, [low, high]))
    clippings = {
        c: clipped(F.col(c).cast("double"), F.col("_bounds")[c][0], F.col("_bounds")[c][1])
        for c in columns
    }
    return df.withColumn("_bounds", bounds).withColumns(clippings).drop("_bounds")


def standardized(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    stats = df.agg(
        *[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]
    )
    out = {
        c: (F.col(c) - F.col("_stats")[c]["m"])
        / F.when(F.col("_stats")[c]["s"] == 0, 1.0).otherwise(F.col("_stats")[c]["s"])
        for c in columns
    }
    return df.withColumn("_stats", row_scalar(stats)).withColumns(out).drop("_stats")

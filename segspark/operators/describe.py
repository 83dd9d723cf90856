"""Descriptive statistics. Results are small long tables; inputs are scanned once or twice."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segspark.functions import fixed
from segspark.functions.columns import any_of, holds, log1p_clamped
from segspark.operators.quantiles import exact_quantiles
from segspark.operators.scaling import row_scalar
from segspark.operators.tables import melted
from segspark.session import materialize


def _structs_to_rows(one_row: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One struct per column in one row -> one row per column."""
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("s")) for c in columns])
    return one_row.select(F.explode(entries).alias("e")).select("e.feature", "e.s.*")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max per column."""
    basic = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    quartiles = row_scalar(exact_quantiles(df, columns, [0.25, 0.5, 0.75]))
    long = _structs_to_rows(basic, columns).withColumn("_q", quartiles)
    at = F.coalesce(*[F.when(F.col("feature") == c, F.col("_q")[c]) for c in columns])
    return long.select(
        "feature", "count", "mean", "std", "min",
        at[0].alias("p25"), at[1].alias("p50"), at[2].alias("p75"), "max",
    )


def percentiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Long form (feature, prob, value)."""
    wide = exact_quantiles(df, columns, probs)
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.lit(float(p)).alias("prob"), F.col(c)[i].alias("value"))
            for c in columns
            for i, p in enumerate(probs)
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def null_distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    one_row = df.agg(
        *[
            F.struct(
                F.count_if(F.col(c).isNull()).alias("null_count"),
                F.count_distinct(c).alias("distinct_count"),
            ).alias(c)
            for c in columns
        ]
    )
    return _structs_to_rows(one_row, columns)


def value_counts(df: DataFrame, columns: Sequence[str], with_null: bool = True) -> DataFrame:
    """Counts of every value of every column, most frequent first."""
    long = melted(df, columns)
    if not with_null:
        long = long.where(F.col("value").isNotNull())
    counted = long.groupBy("feature", "value").agg(F.count("*").alias("n"))
    return counted.orderBy("feature", F.desc("n"), "value")


def count_above_quantile(df: DataFrame, columns: Sequence[str], prob: float = 0.99) -> DataFrame:
    """Rows above the quantile of their own column."""
    bounds = row_scalar(exact_quantiles(df, columns, [prob]))
    one_row = df.select(*columns).withColumn("_b", bounds).agg(
        *[
            F.struct(
                F.first(F.col("_b")[c][0]).alias("threshold"),
                F.count_if(F.col(c) > F.col("_b")[c][0]).alias("n_above"),
            ).alias(c)
            for c in columns
        ]
    )
    return _structs_to_rows(one_row, columns)


def correlation_matrix(df: DataFrame, columns: Sequence[str], log: bool = False) -> DataFrame:
    """Pearson correlation of every column pair over rows where both are known."""
    values = df.select(
        *[(log1p_clamped(c) if log else F.col(c).cast("double")).alias(c) for c in columns]
    )
    pairs = list(itertools.combinations_with_replacement(columns, 2))
    wide = values.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
        for x, y in {(a, b), (b, a)}
    ]
    return wide.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def cramers_v(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cramer's V of every column pair, with the continuity correction on 2 x 2 tables.

    All pairs are counted in one pass over the table, and the counts are written:
    the margins read those. Empty cells need no rows because
    sum (O - E)^2 / E = sum O^2 / E - n.
    """
    pairs = list(itertools.combinations_with_replacement(columns, 2))
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("a"), F.lit(b).alias("b"),
                        F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y"),
                    )
                    for a, b in pairs
                ]
            )
        ).alias("p")
    ).select("p.*").where(F.col("x").isNotNull() & F.col("y").isNotNull())
    cells = materialize(long.groupBy("a", "b", "x", "y").agg(F.count("*").cast("double").alias("o")))
    rows = cells.groupBy("a", "b", "x").agg(F.sum("o").alias("row_n"))
    cols = cells.groupBy("a", "b", "y").agg(F.sum("o").alias("col_n"))
    row_side = rows.groupBy("a", "b").agg(
        F.count("*").alias("r"), F.sum("row_n").alias("n"), F.sum(1 / F.col("row_n")).alias("inv_r")
    )
    col_side = cols.groupBy("a", "b").agg(
        F.count("*").alias("k"), F.sum(1 / F.col("col_n")).alias("inv_k")
    )
    expected = F.col("row_n") * F.col("col_n")
    chi = (
        cells.join(rows, ["a", "b", "x"]).join(cols, ["a", "b", "y"]).join(row_side, ["a", "b"])
        .groupBy("a", "b")
        .agg(
            F.sum(F.col("o") * F.col("o") / expected).alias("share"),
            F.max(F.abs(F.col("o") - expected / F.col("n"))).alias("gap"),
        )
    )
    n, smaller = F.col("n"), F.least(F.col("r"), F.col("k")) - 1
    corrected = F.pow(F.col("gap") - F.least(F.lit(0.5), F.col("gap")), 2) * n * F.col("inv_r") * F.col("inv_k")
    chi2 = F.when((F.col("r") == 2) & (F.col("k") == 2), corrected).otherwise(
        F.greatest(F.col("share") * n - n, F.lit(0.0))
    )
    v = F.when(smaller == 0, 0.0).otherwise(F.sqrt(F.try_divide(chi2 / n, smaller)))
    pair = F.struct(F.col("a"), F.col("b"))
    mirror = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = F.when(F.col("a") == F.col("b"), F.array(pair)).otherwise(F.array(pair, mirror))
    return chi.join(row_side, ["a", "b"]).join(col_side, ["a", "b"]).select(
        F.explode(both).alias("p"), v.alias("v")
    ).select("p.*", "v")


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin includes the maximum."""
    c = F.col(column).cast("double")
    stats = row_scalar(df.agg(F.min(c).alias("lo"), F.max(c).alias("hi")))
    lo, hi = F.col("_s.lo"), F.col("_s.hi")
    width = (hi - lo) / bins
    place = F.when(hi == lo, 0).otherwise(F.least(F.floor((c - lo) / width), F.lit(bins - 1)))
    counted = (
        df.where(c.isNotNull()).withColumn("_s", stats)
        .select(place.cast("int").alias("bin"))
        .groupBy("bin").agg(F.count("*").alias("n"))
    )
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("_s", stats)
    return edges.join(counted, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("lower"),
        (lo + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (farthest values within ``reach`` quartile ranges) and outliers."""
    quartiles = row_scalar(exact_quantiles(df, columns, [0.25, 0.5, 0.75]))
    parts = []
    for c in columns:
        x, q = F.col(c).cast("double"), F.col("_q")[c]
        span = (q[2] - q[0]) * reach
        near = (x >= q[0] - span) & (x <= q[2] + span)
        parts.append(
            F.struct(
                F.first(q[0]).alias("q1"), F.first(q[1]).alias("median"), F.first(q[2]).alias("q3"),
                F.min(F.when(near, x)).alias("whisker_low"),
                F.max(F.when(near, x)).alias("whisker_high"),
                F.count_if(~near).alias("n_outliers"),
            ).alias(c)
        )
    one_row = df.select(*columns).withColumn("_q", quartiles).agg(*parts)
    return _structs_to_rows(one_row, columns)


def frequency_box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Box statistics of how often each category of a column occurs."""
    counts = value_counts(df, columns, with_null=False)
    wide = counts.select(*[F.when(F.col("feature") == c, F.col("n")).alias(c) for c in columns])
    return box_stats(wide, columns)


def kde_curve(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian density estimate, Scott's bandwidth, on an even grid from minimum to maximum.

    One aggregate per grid point in a single pass: rows are never multiplied by the grid.
    """
    x = F.col(column).cast("double")
    one_row = df.agg(
        F.min(x).alias("lo"), F.max(x).alias("hi"), F.stddev_samp(x).alias("sd"), F.count(x).alias("n")
    )
    h = F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))
    stats = row_scalar(one_row.select("lo", ((F.col("hi") - F.col("lo")) / (points - 1)).alias("step"), h.alias("h")))
    # In units of the bandwidth the grid needs one subtraction per row and point.
    scaled = df.select(x.alias("x")).withColumn("_s", stats).select(
        ((F.col("x") - F.col("_s.lo")) / F.col("_s.h")).alias("u"), (F.col("_s.step") / F.col("_s.h")).alias("du")
    )
    z = [F.col("u") - F.col("du") * i for i in range(points)]
    sums = scaled.agg(*[F.avg(F.exp(v * v * -0.5)).alias(str(i)) for i, v in enumerate(z)])
    rows = F.array(*[F.struct(F.lit(i).alias("point"), F.col(str(i)).alias("k")) for i in range(points)])
    return sums.select(F.explode(rows).alias("e")).select("e.*").withColumn("_s", stats).select(
        "point", (F.col("_s.lo") + F.col("_s.step") * F.col("point")).alias("x"),
        (F.col("k") / (F.col("_s.h") * math.sqrt(2 * math.pi))).alias("density"),
    )


def normal_fit(df: DataFrame, columns: Sequence[str], points: int = 100, log: bool = True) -> DataFrame:
    """Mean and population deviation of each (logged) column, and the fitted density on a grid."""
    values = df.select(*[(log1p_clamped(c) if log else F.col(c).cast("double")).alias(c) for c in columns])
    one_row = values.agg(
        *[
            F.struct(
                F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"),
                F.min(c).alias("lo"), F.max(c).alias("hi"),
            ).alias(c)
            for c in columns
        ]
    )
    fit = _structs_to_rows(one_row, columns)
    step = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    at = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("point") / (points - 1)
    density = F.try_divide(
        F.exp(-0.5 * F.pow(F.try_divide(F.col("x") - F.col("mean"), F.col("std")), 2)),
        F.col("std") * math.sqrt(2 * math.pi),
    )
    return fit.select("*", step).withColumn("x", at).select(
        "feature", "point", "mean", "std", "x", density.alias("density")
    )


def segment_rule_mismatches(
    df: DataFrame, segment: str = "Segmentation", ratio: str = "PPA",
    bounds: tuple[float, float, float] = (25, 60, 100),
) -> DataFrame:
    """Rows whose segment label disagrees with the band of their ratio."""
    label, x = F.col(segment), F.col(ratio)
    low, mid, high = bounds
    wrong = [
        (label == fixed.SEGMENT_MASS) & (x >= low),
        (label == fixed.SEGMENT_MASS_ASPIRING) & ((x < low) | (x >= mid)),
        (label == fixed.SEGMENT_PREMIUM) & ((x < mid) | (x >= high)),
        (label == fixed.SEGMENT_SUPER_PREMIUM) & (x < high),
    ]
    return df.where(any_of(holds(w) for w in wrong))


def table_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and the number of rows of the table."""
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("feature"),
                     F.lit(f.dataType.simpleString()).alias("type"))
            for i, f in enumerate(df.schema)
        ]
    )
    counted = df.agg(F.count("*").alias("n_rows"))
    return counted.select(F.explode(entries).alias("e"), "n_rows").select("e.*", "n_rows")

"""Cluster profiles: sizes, means, modes and what sets a cluster apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segspark.operators.scaling import row_scalar
from segspark.operators.tables import melted


def cluster_means(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in columns])


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Size and share in percent, two decimals."""
    total = df.agg(F.count("*").alias("n")).scalar()
    return (
        df.groupBy(cluster).agg(F.count("*").alias("size"))
        .withColumn("percentage", F.round(F.col("size") / total * 100, 2))
    )


def cluster_against_overall(
    df: DataFrame, columns: Sequence[str], cluster: str = "cluster", band: float = 10.0
) -> DataFrame:
    """Cluster mean against overall mean, difference in percent and its direction."""
    overall = row_scalar(df.agg(*[F.avg(c).alias(c) for c in columns]))
    means = cluster_means(df, columns, cluster).withColumn("_all", overall)
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(c).alias("cluster_mean"), F.col("_all")[c].alias("overall_mean"))
            for c in columns
        ]
    )
    diff = F.when(F.col("overall_mean") == 0, 0.0).otherwise(
        (F.col("cluster_mean") - F.col("overall_mean")) / F.col("overall_mean") * 100
    )
    return (
        means.select(cluster, F.explode(rows).alias("r")).select(cluster, "r.*")
        .withColumn("diff_pct", diff)
        .withColumn(
            "direction",
            F.when(F.col("diff_pct") > band, "up").when(F.col("diff_pct") < -band, "down").otherwise("flat"),
        )
    )


def cluster_modes(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Most frequent value per cluster and column, smallest value on a tie.

    Values are counted first, so no task ever holds the values of a whole cluster.
    """
    counts = melted(df, columns, keep=[cluster]).groupBy(cluster, "feature", "value").agg(F.count("*").alias("n"))
    rank = F.struct((-F.col("n")).alias("neg"), F.col("value"))
    best = counts.groupBy(cluster, "feature").agg(
        F.min(F.when(F.col("value").isNotNull(), rank)).alias("best"), F.sum("n").alias("size")
    )
    return best.where(F.col("best").isNotNull()).select(
        cluster, "feature", F.col("best.value").alias("mode"),
        (-F.col("best.neg")).alias("mode_n"),
        (-F.col("best.neg") / F.col("size") * 100).alias("mode_pct"),
    )


def profile_table(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], cluster: str = "cluster"
) -> DataFrame:
    """One row per cluster: size, means and modes."""
    wide = df.groupBy(cluster).agg(F.count("*").alias("size"), *[F.avg(c).alias(f"{c}_mean") for c in numeric])
    if not categorical:
        return wide
    modes = cluster_modes(df, categorical, cluster).groupBy(cluster).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("mode"))).alias(f"{c}_mode") for c in categorical]
    )
    return wide.join(modes, cluster, "left")


def distinctive_features(
    df: DataFrame, columns: Sequence[str], cluster: str = "cluster", top: int = 5
) -> DataFrame:
    """The features whose cluster mean is farthest from the overall mean."""
    gaps = cluster_against_overall(df, columns, cluster).withColumn(
        "diff", F.col("cluster_mean") - F.col("overall_mean")
    )
    order = W.partitionBy(cluster).orderBy(F.desc(F.abs("diff")), "feature")
    return (
        gaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        .select(cluster, "rank", "feature", "diff")
    )


def variance_ranking(df: DataFrame, columns: Sequence[str], top: int = 10) -> DataFrame:
    """Features with the largest sample variance."""
    wide = df.agg(*[F.var_samp(c).alias(c) for c in columns])
    return melted(wide, columns, "double").withColumnRenamed("value", "variance").orderBy(
        F.desc("variance"), "feature"
    ).limit(top)

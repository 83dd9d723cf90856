"""Behaviour features of a respondent, derived from brand answers."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segspark.functions.columns import flag, kept_or_others, mentions

FUNNEL = ("Awareness", "Spontaneous", "Trial", "P3M", "P1M", "Weekly", "Daily")
GROUPED = ("TOM", "BUMO", "BUMO_Previous", "MostFavourite")


@dataclass(frozen=True)
class BrandSpec:
    """The brand of interest and the brands that keep their own group."""

    focal: str
    keep: Sequence[str]
    funnel: Sequence[str] = field(default=FUNNEL)
    grouped: Sequence[str] = field(default=GROUPED)


def add_brand_groups(df: DataFrame, spec: BrandSpec) -> DataFrame:
    return df.withColumns({f"{c}_Group": kept_or_others(c, spec.keep) for c in spec.grouped})


def add_brand_flags(df: DataFrame, spec: BrandSpec) -> DataFrame:
    return df.withColumns({f"{c}_flag": flag(F.col(c) == spec.focal) for c in spec.funnel})


def add_loyalty(df: DataFrame) -> DataFrame:
    """0 to 4 agreements; two of them compare a group with the raw favourite."""
    agreements = [
        ("TOM_Group", "BUMO_Group"),
        ("BUMO_Group", "MostFavourite"),
        ("BUMO_Group", "BUMO_Previous_Group"),
        ("MostFavourite_Group", "MostFavourite"),
    ]
    score = functools.reduce(operator.add, [flag(F.col(a) == F.col(b)) for a, b in agreements])
    return df.withColumn("Brand_Loyalty", score)


def add_switcher(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "Brand_Switcher", (~F.col("BUMO_Group").eqNullSafe(F.col("BUMO_Previous_Group"))).cast("int")
    )


def add_funnel_depth(df: DataFrame, spec: BrandSpec) -> DataFrame:
    return df.withColumn(
        "Funnel_Depth", functools.reduce(operator.add, [F.col(f"{c}_flag") for c in spec.funnel])
    )


def add_awareness_gap(df: DataFrame) -> DataFrame:
    return df.withColumn("Awareness_Usage_Gap", F.col("Awareness_flag") - F.col("Trial_flag"))


def add_need_is_drinking(df: DataFrame, column: str = "Needstates", text: str = "drinking") -> DataFrame:
    return df.withColumn("Need_is_Drinking", mentions(column, text))


def build_features(df: DataFrame, spec: BrandSpec, need_text: str = "drinking") -> DataFrame:
    return (
        df.transform(add_brand_groups, spec)
        .transform(add_brand_flags, spec)
        .transform(add_loyalty)
        .transform(add_switcher)
        .transform(add_funnel_depth, spec)
        .transform(add_awareness_gap)
        .transform(add_need_is_drinking, text=need_text)
    )

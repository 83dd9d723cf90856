"""Integration of the cleaned tables into one row per respondent, as one lazy plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from segspark.functions import fixed
from segspark.operators import tables as t

KEY = ["ID", "City", "Year"]
TEXT_TO_FILL = (
    "Spontaneous", "Trial", "P3M", "P1M", "Comprehension", "Brand_Likability", "Weekly", "Daily",
    "Awareness", "Attribute", "BrandImage", "NPS_P3M_Group", "Segmentation", "Needstates",
    "Daypart", "NeedstateGroup", "Brand", "IncomeBand",
)
NUMBERS_TO_FILL = ("Visit", "Spending", "PPA", "NPS_P3M", "Group_size", "Age")


def integrate(
    parts: Mapping[str, DataFrame],
    year: int,
    order: Mapping[str, Sequence],
    dedup_segmentation: bool = True,
) -> DataFrame:
    """Left-join need states, brand health, brand image and spending onto the demographics.

    ``order`` names, per table, the columns that decide which row of a key is the
    first. Every right side is reduced to one row per key before its join, so the
    row count of the demographics is kept.
    """
    base = parts["sa_var"]
    for name in ("sa_var", "needstate", "brandhealth", "brand_image"):
        t.require_columns(parts[name], KEY, name)
    base = t.cast_key(t.only_year(base, year))
    for name, suffix, unwanted in (
        ("needstate", "_ns", ()),
        ("brandhealth", "_bh", ("PPA", "Spending")),
        ("brand_image", "_bi", ()),
    ):
        side = t.cast_key(t.only_year(parts[name], year))
        side = t.keep_first(side, KEY, order[name]).drop(*unwanted, *_order_only(order[name], side))
        base = t.left_join_suffixed(base, side, KEY, suffix)
    spending = t.cast_key(parts["segmentation"])
    t.require_columns(spending, ["ID", "Visit", "Spending", "PPA"], "segmentation")
    if dedup_segmentation:
        spending = t.keep_first(spending, ["ID"], order["segmentation"])
    base = t.left_join_suffixed(base, spending.select("ID", "Visit", "Spending", "PPA"), ["ID"], "_seg")
    base = base.drop("Awareness", "Frequency_Visit") if "Awareness_bi" in base.columns else base.drop("Frequency_Visit")
    base = t.rename_present(
        base, {"Visit_seg": "Visit", "Spending_seg": "Spending", "PPA_seg": "PPA", "Awareness_bi": "Awareness"}
    )
    base = t.fill_present(base.drop("IncomeBand"), TEXT_TO_FILL, fixed.UNKNOWN)
    return t.fill_present(base, NUMBERS_TO_FILL, fixed.MISSING_NUMBER)


def _order_only(order: Sequence, df: DataFrame) -> list[str]:
    """Columns that exist only to order rows (leading underscore) do not reach the result."""
    return [o for o in order if isinstance(o, str) and o.startswith("_") and o in df.columns]

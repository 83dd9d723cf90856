"""Whole-table cleaners, one per survey table. Each is one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segspark.functions import columns as c
from segspark.functions import fixed
from segspark.operators import tables as t
from segspark.operators.quantiles import median
from segspark.operators.scaling import winsorize
from segspark.session import materialize, materialize_bucketed


def _strip_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = [x for x in columns if x in df.columns]
    return df.withColumns({x: c.strip(x) for x in present}) if present else df


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def clean_segmentation(df: DataFrame, order: Sequence) -> DataFrame:
    """One row per ID (first by ``order``), tidy text, repaired brand names."""
    df = t.cast_key(t.keep_first(df, ["ID"], order))
    df = _strip_columns(df, ["Brand", "Segmentation"])
    return df.withColumn("Brand", c.fix_brand_spelling("Brand")) if "Brand" in df.columns else df


def clean_brand_image(df: DataFrame, focal: str) -> DataFrame:
    df = t.cast_key(t.drop_duplicate_rows(df))
    return t.fill_present(_strip_columns(df, _text_columns(df)), ["Awareness"], focal)


def clean_demographics(df: DataFrame) -> DataFrame:
    """Tidy names and text, drop rows without group size, derive the income band."""
    df = t.normalise_names(df)
    df = t.drop_null_in(df, "Group_size").drop("Age_group", "Col", "MPI", "MPI_2", "MPI_Mean_Use")
    # The key is text in every other table; casting here keeps the joins typed alike.
    df = t.cast_key(df)
    brands = [x for x in ("TOM", "BUMO", "MostFavourite") if x in df.columns]
    df = _strip_columns(df, ["City", "Occupation", "Occupation_group", *brands])
    df = df.withColumns({x: c.fix_brand_spelling(x) for x in brands}) if brands else df
    if {"MPI_detail", "MPI_Mean"} <= set(df.columns):
        band = F.coalesce("MPI_detail", c.income_band("MPI_Mean"), F.lit(fixed.UNKNOWN))
        df = df.withColumn("IncomeBand", band).drop("MPI_Mean", "MPI_detail")
    df = t.rename_present(df, {"Occupation_group": "Occupation_Group"})
    return t.fill_present(df, ["BUMO_Previous"], fixed.UNKNOWN)


def clean_needstates(df: DataFrame) -> DataFrame:
    df = t.drop_duplicate_rows(t.short_keys_only(t.cast_key(df)))
    df = t.rename_present(df, {"Day#Daypart": "Daypart"})
    df = _strip_columns(df, _text_columns(df))
    repairs = {"Needstates": fixed.NEEDSTATE_SPELLING, "NeedstateGroup": fixed.NEEDSTATE_GROUP_SPELLING}
    present = {x: c.replace_values(x, m) for x, m in repairs.items() if x in df.columns}
    return df.withColumns(present) if present else df


def fill_funnel(df: DataFrame, focal: str) -> DataFrame:
    """Gaps in the funnel answers, filled from later stages; all sides read the answers as given.
    Answers a table does not have are left out."""
    unknown = fixed.UNKNOWN

    def present(*names):
        return [n for n in names if n in df.columns]

    filled = {}
    evidence = present("P3M", "P1M", "Brand_Likability", "Weekly", "Daily")
    spontaneous = present("Spontaneous")
    if len(present("Spontaneous", "Awareness")) == 2:
        filled["Spontaneous"] = t.first_known("Spontaneous", "Awareness", default=unknown)
        spontaneous = ["Spontaneous", "Awareness"]
    if spontaneous:  # evidence whenever the answer is there; filled first where it can be
        evidence.append(t.first_known(*spontaneous))
    if present("Trial"):
        filled["Trial"] = t.fill_if_all("Trial", evidence, focal, unknown)
    for stage, sources in (("P3M", ("P1M", "Daily", "Weekly")), ("P1M", ("Daily", "Weekly"))):
        if present(stage):
            filled[stage] = t.first_known(stage, *present(*sources), default=unknown)
    if len(present("Comprehension", "Awareness")) == 2:
        knows = F.when(c.holds(F.col("Awareness") == focal), "Know a little").otherwise(unknown)
        filled["Comprehension"] = F.coalesce("Comprehension", knows)
    return df.withColumns(filled) if filled else df


def fill_visits(df: DataFrame, focal: str) -> DataFrame:
    """Gaps in visit frequency: the median where any answer names the focal brand, else zero.
    Call on a table whose funnel answers are filled."""
    if "Frequency_Visit" not in df.columns:
        return df
    answers = ("Trial", "P3M", "P1M", "Brand_Likability", "Weekly", "Daily")
    middle: Column = median(df, "Frequency_Visit").scalar()
    return df.withColumn(
        "Frequency_Visit",
        t.fill_median_or_zero(
            F.col("Frequency_Visit").cast("double"), [x for x in answers if x in df.columns], focal, middle
        ),
    )


def fill_likability(df: DataFrame, image: DataFrame | None, order: Sequence | None, often: float = 3) -> DataFrame:
    """Gaps in likability: own brand for frequent visitors, then the last brand image per ID.
    Nothing to do in a table without likability or visits."""
    if not {"Brand_Likability", "Frequency_Visit"} <= set(df.columns):
        return df
    own = F.when(F.col("Frequency_Visit") > often, F.col("Brand")) if "Brand" in df.columns else F.lit(None)
    parts = [F.col("Brand_Likability"), own]
    if image is not None and "BrandImage" in image.columns:
        if not order:
            raise ValueError("give the order columns that say which brand image is the last")
        df = t.lookup_last(df, t.cast_key(image), "ID", "BrandImage", order, "_image")
        parts.append(F.col("_image"))
    return df.withColumn("Brand_Likability", F.coalesce(*parts, F.lit(fixed.UNKNOWN))).drop("_image")


def settle_spending(df: DataFrame, focal: str, strict: bool = False) -> DataFrame:
    """No spending without trial of the focal brand; ratio, segment and scores follow from it.
    Each step is left out where its columns are absent."""
    numbers = [x for x in ("Spending", "PPA") if x in df.columns]
    df = df.withColumns({x: F.col(x).cast("double") for x in numbers}) if numbers else df
    if {"Trial", "Spending"} <= set(df.columns):
        untried = ~F.col("Trial").eqNullSafe(F.lit(focal))
        none = {"Spending": 0.0, "PPA": float(fixed.MISSING_NUMBER)}
        df = df.withColumns({x: F.when(untried, none[x]).otherwise(F.col(x)) for x in numbers})
    if {"PPA", "Spending", "Frequency_Visit"} <= set(df.columns):
        df = df.withColumn("PPA", c.ratio_refreshed("PPA", "Spending", "Frequency_Visit"))
    if "Spending" in df.columns:
        df = df.withColumn("Segmentation", c.spend_segment("Spending", strict=strict))
    nps = F.col("NPS_P3M").cast("double") if "NPS_P3M" in df.columns else F.lit(None).cast("double")
    if {"Brand_Likability", "Segmentation"} <= set(df.columns):
        nps = c.nps_filled(nps, "Brand_Likability", "Segmentation", focal)
    df = df.withColumn("NPS_P3M", nps)
    return df.withColumn("NPS_P3M_Group", c.nps_group("NPS_P3M"))


def clean_brandhealth(
    df: DataFrame,
    focal: str,
    image: DataFrame | None = None,
    image_order: Sequence | None = None,
    strict: bool = False,
) -> DataFrame:
    """The brand-health cleaner; ``image`` is the brand-image table used for likability gaps."""
    names = {"Fre#visit": "Frequency_Visit", "NPS#P3M": "NPS_P3M", "NPS#P3M#Group": "NPS_P3M_Group"}
    df = t.drop_null_in(t.cast_key(t.drop_duplicate_rows(df)), "Awareness")
    # Median and quantiles need whole passes of their own: each reads a written table. The first one
    # meets the brand images by ID as well.
    df = t.rename_present(df, names)
    df = materialize(df) if image is None else materialize_bucketed(df, "ID")
    df = fill_visits(fill_funnel(df, focal), focal)
    df = fill_likability(df, image, image_order)
    df = t.fill_present(df, ["Weekly", "Daily"], fixed.UNKNOWN)
    df = t.drop_copy_column(df, "Spending", "Spending_use")
    settled = materialize(settle_spending(df, focal, strict))
    return winsorize(settled, [x for x in ("Frequency_Visit", "Spending", "NPS_P3M") if x in settled.columns])


def clean_all(
    raw: dict[str, DataFrame], focal: str, segment_order: Sequence, image_order: Sequence | None = None
) -> dict[str, DataFrame]:
    """Clean the five survey tables; brand health reads the cleaned brand image."""
    image = clean_brand_image(raw["brand_image"], focal)
    return {
        "segmentation": clean_segmentation(raw["segmentation"], segment_order),
        "brand_image": image,
        "brandhealth": clean_brandhealth(raw["brandhealth"], focal, image, image_order),
        "sa_var": clean_demographics(raw["sa_var"]),
        "needstate": clean_needstates(raw["needstate"]),
    }

"""Column expressions: everything here stays a built-in Spark expression."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from segspark.functions import fixed


# Unicode's White_Space. Trimming a set of characters takes a fraction of a regular expression's time.
WHITE_SPACE = "\t\n\v\f\r \u0085\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def holds(condition: Column) -> Column:
    """A condition that counts as false when it is null."""
    return F.coalesce(condition, F.lit(False))


def flag(condition: Column) -> Column:
    return holds(condition).cast("int")


def all_of(conditions: Iterable[Column]) -> Column:
    return functools.reduce(operator.and_, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    return functools.reduce(operator.or_, conditions, F.lit(False))


def strip(c) -> Column:
    """Trim every kind of white space (``trim`` alone removes blanks only); null stays null."""
    return F.trim(as_column(c), F.lit(WHITE_SPACE))


def replace_values(c, mapping: Mapping[str, str]) -> Column:
    c = as_column(c)
    if not mapping:
        return c
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)


def fix_brand_spelling(c) -> Column:
    return replace_values(c, fixed.BRAND_SPELLING)


def banded(c, bands: Sequence[tuple[float, str]]) -> Column:
    """Label of the half-open band that holds the value; null below the first band."""
    c = as_column(c)
    label = F.lit(None).cast("string")
    for lower, name in bands:
        label = F.when(c >= lower, name).otherwise(label)
    return F.when(c.isNotNull(), label)


def income_band(c, bands: Sequence[tuple[float, str]] = tuple(fixed.INCOME_BANDS)) -> Column:
    return banded(c, bands)


def spend_segment(
    c,
    mass_below: float = 25000,
    aspiring: tuple[float, float] = (25000, 59000),
    premium: tuple[float, float] = (60000, 99000),
    strict: bool = False,
) -> Column:
    """Spending segment. Gaps between bands and nulls land in the top segment
    unless ``strict``, which closes the gaps and sends null to the unknown segment."""
    c = as_column(c)
    if strict:
        return (
            F.when(c.isNull() | (c == fixed.MISSING_NUMBER), fixed.SEGMENT_UNKNOWN)
            .when(c < mass_below, fixed.SEGMENT_MASS)
            .when(c < premium[0], fixed.SEGMENT_MASS_ASPIRING)
            .when(c <= premium[1], fixed.SEGMENT_PREMIUM)
            .otherwise(fixed.SEGMENT_SUPER_PREMIUM)
        )
    return (
        F.when(c == fixed.MISSING_NUMBER, fixed.SEGMENT_UNKNOWN)
        .when(c < mass_below, fixed.SEGMENT_MASS)
        .when(c.between(*aspiring), fixed.SEGMENT_MASS_ASPIRING)
        .when(c.between(*premium), fixed.SEGMENT_PREMIUM)
        .otherwise(fixed.SEGMENT_SUPER_PREMIUM)
    )


def nps_filled(nps, likability, segment, focal: str) -> Column:
    """Recommendation score with gaps filled from likability and segment."""
    segment = as_column(segment)
    likes = holds(as_column(likability) == focal)
    high = segment.isin(fixed.SEGMENT_SUPER_PREMIUM, fixed.SEGMENT_PREMIUM)
    guess = (
        F.when(likes | high, 9.0)
        .when(segment == fixed.SEGMENT_MASS_ASPIRING, 8.0)
        .otherwise(float(fixed.MISSING_NUMBER))
    )
    return F.coalesce(as_column(nps), guess)


def nps_group(nps) -> Column:
    nps = as_column(nps)
    return F.when(nps >= 9, "Promoter").when(nps >= 8, "Passive").otherwise("Detractive")


def ratio_refreshed(ratio, amount, visits) -> Column:
    """Amount per visit where the ratio is known to apply and there were visits."""
    ratio, visits = as_column(ratio), as_column(visits)
    applies = ~ratio.eqNullSafe(F.lit(float(fixed.MISSING_NUMBER))) & holds(visits > 0)
    return F.when(applies, F.try_divide(as_column(amount), visits)).otherwise(ratio)


def clipped(c, low: Column, high: Column) -> Column:
    """Clip to bounds; null stays null (``least``/``greatest`` would return a bound)."""
    c = as_column(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, low), high))


def log1p_clamped(c) -> Column:
    """log(1 + x) with negative values (missing markers) taken as zero."""
    c = as_column(c).cast("double")
    return F.log1p(F.when(c < 0, 0.0).otherwise(c))


def log1p_inverse(c) -> Column:
    return F.expm1(as_column(c))


def kept_or_others(c, keep: Sequence[str], others: str = "Others") -> Column:
    c = as_column(c)
    return F.when(c.isin(*keep), c).otherwise(others)


def mentions(c, text: str) -> Column:
    """1 when the text occurs in any letter case, 0 otherwise and for null."""
    return flag(F.contains(F.lower(as_column(c)), F.lit(text.lower())))


def vector_distance(a, b, metric: str = "euclidean") -> Column:
    """Distance of two array columns."""
    a, b = as_column(a), as_column(b)
    if metric == "manhattan":
        return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(squared_distance(a, b))


def squared_distance(a, b) -> Column:
    a, b = as_column(a), as_column(b)
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x
    )

"""Row and column shaping: projections, fills, deduplication, lookups, left joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segspark.functions.columns import all_of, any_of, as_column, holds


def require_columns(df: DataFrame, columns: Sequence[str], table: str = "table") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{table} is missing columns: {missing}")


def only_year(df: DataFrame, year: int, column: str = "Year") -> DataFrame:
    return df.where(F.col(column) == year) if column in df.columns else df


def select_columns(df: DataFrame, columns: Sequence[str], table: str = "table") -> DataFrame:
    require_columns(df, columns, table)
    return df.select(*columns)


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def normalise_names(df: DataFrame, old: str = "#", new: str = "_") -> DataFrame:
    return df.toDF(*[c.replace(old, new) for c in df.columns])


def fill_present(df: DataFrame, columns: Sequence[str], value) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.fillna({c: value for c in present}) if present else df


def drop_null_in(df: DataFrame, column: str) -> DataFrame:
    return df.dropna(subset=[column]) if column in df.columns else df


def cast_key(df: DataFrame, key: str = "ID") -> DataFrame:
    return df.withColumn(key, F.col(key).cast("string"))


def short_keys_only(df: DataFrame, key: str = "ID", longest: int = 20) -> DataFrame:
    return df.where(F.length(key) <= longest)


def nan_to_null(df: DataFrame) -> DataFrame:
    """A parsed NaN sorts above every number and is not null; make it null once."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def first_known(*columns, default: str | None = None) -> Column:
    parts = [as_column(c) for c in columns]
    return F.coalesce(*parts, F.lit(default)) if default is not None else F.coalesce(*parts)


def fill_if_all(target, evidence: Sequence, value: str, default: str) -> Column:
    """Null becomes ``value`` when every piece of evidence names it, else ``default``."""
    agrees = all_of(holds(as_column(e) == value) for e in evidence)
    return F.coalesce(as_column(target), F.when(agrees, value).otherwise(default))


def fill_median_or_zero(target, evidence: Sequence, value: str, median: Column) -> Column:
    """Null becomes the column median when any evidence names ``value``, else zero."""
    seen = any_of(holds(as_column(e) == value) for e in evidence)
    return F.coalesce(as_column(target), F.when(seen, median).otherwise(0.0))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key: the first in the given order, ties settled by the other columns.

    An aggregate, not a window: each map task already reduces its rows to one
    per key, so a key that holds a third of the table costs one row per task.
    """
    return _one_per_key(df, keys, F.min, order)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    return _one_per_key(df, keys, F.max, order)


def _one_per_key(df, keys, pick, order):
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    # Structs compare field by field: the order columns lead, the others follow.
    named = [o for o in order if isinstance(o, str) and o in rest]
    by = [o if o in named else as_column(o).alias(f"_by{i}") for i, o in enumerate(order)]
    row = pick(F.struct(*by, *[c for c in rest if c not in named])).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_copy_column(df: DataFrame, original: str, copy: str) -> DataFrame:
    """Drop ``copy`` if it equals ``original`` in every row (nulls equal)."""
    if original not in df.columns or copy not in df.columns:
        return df
    differs = F.max((~F.col(original).eqNullSafe(F.col(copy))).cast("int")).alias("d")
    return df if df.agg(differs).first()["d"] == 1 else df.drop(copy)


def left_join_suffixed(left: DataFrame, right: DataFrame, on: Sequence[str], suffix: str) -> DataFrame:
    """Left equi-join; right columns already on the left get the suffix."""
    clash = [c for c in right.columns if c in left.columns and c not in on]
    return left.join(right.withColumnsRenamed({c: c + suffix for c in clash}), list(on), "left")


def lookup_last(
    df: DataFrame, lookup: DataFrame, key: str, value: str, order: Sequence, name: str
) -> DataFrame:
    """Add ``name`` = the lookup's last value per key (null without a match)."""
    last = lookup.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(name))
    return df.join(last, key, "left")


def mapping_mismatches(df: DataFrame, value: str, recorded: str, mapping: Mapping[str, str]) -> DataFrame:
    """Rows whose recorded group is not the one the mapping gives (unmapped counts)."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    mapped = F.try_element_at(F.create_map(*pairs), F.col(value))
    return df.withColumn("MappedGroup", mapped).where(
        ~F.coalesce(F.col("MappedGroup") == F.col(recorded), F.lit(False))
    )


def attach_labels(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Join cluster labels by key; refuse when either side has rows the other lacks."""
    lost = df.join(labels, key, "left_anti").select(F.lit("row").alias("s"))
    extra = labels.join(df, key, "left_anti").select(F.lit("label").alias("s"))
    if not lost.unionAll(extra).isEmpty():
        raise ValueError("labels and rows do not match by key")
    return df.join(labels, key)


def melted(df: DataFrame, columns: Sequence[str], value_type: str = "string", keep: Sequence[str] = ()):
    """Long form (keep..., feature, value)."""
    typed = df.select(*keep, *[F.col(c).cast(value_type).alias(c) for c in columns])
    return typed.unpivot(list(keep), list(columns), "feature", "value")


def columns_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric and text column names."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return numeric, text


def columns_by_cardinality(
    df: DataFrame, columns: Sequence[str], at_most: int | None = None, more_than: int | None = None,
    approximate: bool = False,
) -> list[str]:
    """Columns whose number of distinct values is within the limits."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    found = df.agg(*[count(c).alias(c) for c in columns]).first().asDict()
    return [
        c for c in columns
        if (at_most is None or found[c] <= at_most) and (more_than is None or found[c] > more_than)
    ]

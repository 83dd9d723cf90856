"""Reading delimited survey files and writing result tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segspark.operators.tables import nan_to_null, require_columns
from segspark.sources import records

DELIMITERS = (",", ";", "\t", "|")
BOM = records.BOM


@dataclass(frozen=True)
class TableSpec:
    """Where a table of the catalog lives and how it is written."""

    file: str
    sep: str = ";"
    schema: T.StructType | str | None = None
    required: tuple[str, ...] = ()
    multiline: bool | None = None


# File names and separators of the raw and of the cleaned survey tables.
RAW_CATALOG = {
    "sa_var": TableSpec("SA#var.csv", ";"),
    "needstate": TableSpec("NeedstateDayDaypart.csv", ";"),
    "brandhealth": TableSpec("Brandhealth.csv", ","),
    "brand_image": TableSpec("Brand_Image.csv", ","),
    "segmentation": TableSpec("2017Segmentation3685case.csv", ";"),
}
CLEANED_CATALOG = {
    "sa_var": TableSpec("sa_var_clean.csv", ","),
    "needstate": TableSpec("needstate_clean.csv", ","),
    "brandhealth": TableSpec("brandhealth_clean.csv", ","),
    "brand_image": TableSpec("brand_image_clean.csv", ","),
    "segmentation": TableSpec("customer_segmentation_clean.csv", ","),
}


def _text(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.text(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"File not found: {path}") from e
        raise


def text_encoding(spark: SparkSession, path: str) -> str:
    """utf-8 if every line is valid utf-8, else latin-1 (which accepts any byte)."""
    bad = _text(spark, path).where(~F.is_valid_utf8("value"))
    return "utf-8" if bad.isEmpty() else "iso-8859-1"


def _unquoted(line) -> Column:
    return F.regexp_replace(line, '"[^"]*"', "")


def _fields(record, sep: str) -> Column:
    return F.size(F.split(_unquoted(record), f"\\Q{sep}\\E", -1))


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """The candidate that splits the most lines into as many fields as the header, then into the most fields.

    One aggregate over all lines; separators inside quotes do not count.
    """
    lines = _text(spark, path)
    header = lines.select(_unquoted("value").alias("value")).first()
    if header is None:
        raise ValueError(f"{path} is empty")
    wanted = {sep: header["value"].count(sep) for sep in DELIMITERS}
    plain = _unquoted("value")
    agree = [
        F.count_if(F.length(plain) - F.length(F.replace(plain, F.lit(sep), F.lit(""))) == n).alias(f"s{i}")
        for i, (sep, n) in enumerate(wanted.items())
    ]
    seen = lines.agg(*agree).first()
    score = {sep: (seen[f"s{i}"] if n else 0, n) for i, (sep, n) in enumerate(wanted.items())}
    return max(DELIMITERS, key=score.__getitem__)


def has_quoted_newlines(spark: SparkSession, path: str) -> bool:
    """Whether some line holds an odd number of quotes, so that a record goes on in the next line."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not _text(spark, path).where(quotes % 2 == 1).isEmpty()


def read_delimited(
    spark: SparkSession, path: str, sep: str = ";", schema=None, encoding: str | None = None, multiline: bool | None = None
) -> DataFrame:
    """Header row, given separator; encoding, and whether records span lines, are found by reading when not given.

    Records that span lines are put together by quote parity, in as many tasks as the file has splits;
    only an encoding whose line ends are not single bytes leaves such a file to one task.
    """
    spans = has_quoted_newlines(spark, path) if multiline is None else multiline
    encoding = encoding or text_encoding(spark, path)
    if spans and encoding.lower() in records.SPLITTABLE:
        return nan_to_null(records.read_records(spark, path, sep, schema, encoding))
    reader = (
        spark.read.option("sep", sep).option("header", True).option("quote", '"').option("escape", '"')
        .option("encoding", encoding).option("multiLine", spans)
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return nan_to_null(df.toDF(*[c.removeprefix(BOM) for c in df.columns]))


def load_catalog(
    spark: SparkSession, folder: str, catalog: Mapping[str, TableSpec]
) -> dict[str, DataFrame]:
    """Every table of the catalog, checked for its required columns."""
    out = {}
    for name, spec in catalog.items():
        df = read_delimited(spark, f"{folder.rstrip('/')}/{spec.file}", spec.sep, spec.schema, multiline=spec.multiline)
        require_columns(df, spec.required, name)
        out[name] = df
    return out


def load_directory(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every ``*.csv`` of a folder by file name; lines with surplus fields are skipped."""
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path")
    )
    paths = sorted(r["path"] for r in listing.collect())
    return {p.rsplit("/", 1)[1]: _read_tolerant(spark, p) for p in paths}


def _read_tolerant(spark: SparkSession, path: str) -> DataFrame:
    sep, encoding, spans = sniff_delimiter(spark, path), text_encoding(spark, path), has_quoted_newlines(spark, path)
    if spans:
        return nan_to_null(records.read_records(spark, path, sep, None, encoding, lambda record: _fields(record, sep)))
    inferred = read_delimited(spark, path, sep, encoding=encoding, multiline=False)
    names = inferred.columns
    schema = T.StructType([*inferred.schema.fields, T.StructField("_line", T.StringType())])
    df = (
        spark.read.option("sep", sep).option("header", True).option("encoding", encoding)
        .option("quote", '"').option("escape", '"').option("enforceSchema", True)
        .option("columnNameOfCorruptRecord", "_line").schema(schema).csv(path)
    )
    surplus = F.coalesce(_fields("_line", sep) > len(names), F.lit(False))
    return nan_to_null(df.where(~surplus).select(*names))


def write_table(df: DataFrame, path: str, form: str = "parquet", bom: bool = False) -> None:
    """Overwrite a result table. CSV has a header, and a byte-order mark per file on request."""
    if form == "parquet":
        df.write.mode("overwrite").parquet(path)
    elif form == "csv":
        marked = df.withColumnRenamed(df.columns[0], BOM + df.columns[0]) if bom else df
        marked.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        raise ValueError(f"unknown format {form!r}")


def write_cleaned(tables: Mapping[str, DataFrame], folder: str) -> None:
    """The cleaned tables under their fixed names, as CSV."""
    for name, df in tables.items():
        write_table(df, f"{folder.rstrip('/')}/{CLEANED_CATALOG[name].file}", "csv")


def write_labelled(df: DataFrame, labels: DataFrame, key: str, path: str) -> None:
    """Feature columns with their cluster, joined by key."""
    write_table(df.join(labels.select(key, "cluster"), key, "left"), path)

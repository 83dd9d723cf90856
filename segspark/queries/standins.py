"""Survey-shaped tables built from the order tables, in Spark and in SQL.

A respondent is a customer (ID, City, Year of order); brands are part brands;
missing answers arise by nature (a brand not bought in December has no P1M).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segspark.functions import fixed

FOCAL = "Brand#1"
KEEP = ["Brand#1", "Brand#2", "Brand#3", "Brand#4"]
YEAR = 1998
NEED_TEXT = "promo"
AGE_BANDS = list(zip([0, 20, 25, 30, 35, 40, 45], fixed.AGE_GROUP_ORDER))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with respondent key and brand."""
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    parts = table(spark, sf_dir, "part")
    # The last join is by the ID itself, so that what follows by ID finds the lines partitioned by it.
    orders = orders.withColumn("_buyer", F.col("o_custkey").cast("string"))
    customers = customers.withColumn("ID", F.col("c_custkey").cast("string"))
    residents = customers.join(nations, customers.c_nationkey == nations.n_nationkey)
    return (
        items.join(parts, items.l_partkey == parts.p_partkey)
        .join(orders, items.l_orderkey == orders.o_orderkey)
        .join(residents, F.col("_buyer") == F.col("ID"))
        .select(
            "ID", F.col("n_name").alias("City"),
            F.year("o_orderdate").alias("Year"), F.month("o_orderdate").alias("month"),
            "o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority", "l_linenumber",
            "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
            F.col("p_brand").alias("brand"), "p_type", "c_acctbal", "c_mktsegment",
        )
    )


LINES_SQL = """
lines AS (
  SELECT CAST(c_custkey AS VARCHAR) AS "ID", n_name AS "City", CAST(year(o_orderdate) AS INTEGER) AS "Year",
         CAST(month(o_orderdate) AS INTEGER) AS month, o_orderdate, o_orderkey, o_orderstatus, o_orderpriority,
         l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus, p_brand AS brand, p_type,
         c_acctbal, c_mktsegment
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def demographics(rows: DataFrame) -> DataFrame:
    """One row per respondent and year, with raw income columns and a previous brand."""
    key = ["ID", "City", "Year"]
    per_brand = rows.groupBy(*key, "brand").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty"),
        F.min(F.struct("o_orderdate", "o_orderkey", "l_linenumber")).alias("first"),
        F.first("c_acctbal").alias("bal"), F.first("c_mktsegment").alias("seg"),
    )
    base = per_brand.groupBy(*key).agg(
        F.min(F.struct("first", "brand"))["brand"].alias("TOM"),
        F.min(F.struct((-F.col("n")).alias("n"), "brand"))["brand"].alias("BUMO"),
        F.min(F.struct((-F.col("qty")).alias("q"), "brand"))["brand"].alias("MostFavourite"),
        F.sum("n").cast("double").alias("Group_size"),
        F.first("bal").alias("bal"), F.first("seg").alias("Occupation"),
    )
    previous = F.lag("BUMO").over(W.partitionBy("ID", "City").orderBy("Year"))
    age = F.floor(F.col("bal") / 200).cast("double") + 20
    group = F.lit(None).cast("string")
    for lower, name in AGE_BANDS:
        group = F.when(age >= lower, name).otherwise(group)
    return base.select(
        *key, "TOM", "BUMO", "MostFavourite", previous.alias("BUMO_Previous"), "Group_size",
        age.alias("Age"), group.alias("Age#Group#2"), "Occupation",
        (F.col("bal") * 10).alias("MPI#Mean"),
        F.when(F.col("Occupation") == "BUILDING", "Stated band").alias("MPI#detail"),
    )


_AGE_CASE = "CASE " + " ".join(
    f"WHEN age >= {lower} THEN '{name}'" for lower, name in reversed(AGE_BANDS)
) + " END"
DEMOGRAPHICS_SQL = f"""
per_brand AS (
  SELECT "ID", "City", "Year", brand, count(*) AS n, sum(l_quantity) AS qty,
         min((o_orderdate, o_orderkey, l_linenumber)) AS first, min(c_acctbal) AS bal, min(c_mktsegment) AS seg
  FROM lines GROUP BY 1, 2, 3, 4),
base AS (
  SELECT "ID", "City", "Year", arg_min(brand, (first, brand)) AS "TOM", arg_min(brand, (-n, brand)) AS "BUMO",
         arg_min(brand, (-qty, brand)) AS "MostFavourite", CAST(sum(n) AS DOUBLE) AS "Group_size",
         min(bal) AS bal, min(seg) AS "Occupation"
  FROM per_brand GROUP BY 1, 2, 3),
aged AS (
  SELECT *, floor(bal / 200) + 20 AS age,
         lag("BUMO") OVER (PARTITION BY "ID", "City" ORDER BY "Year") AS "BUMO_Previous" FROM base),
sa_var AS (
  SELECT "ID", "City", "Year", "TOM", "BUMO", "MostFavourite", "BUMO_Previous", "Group_size", age AS "Age",
         {_AGE_CASE} AS "Age_Group_2", "Occupation", bal * 10 AS "MPI_Mean",
         CASE WHEN "Occupation" = 'BUILDING' THEN 'Stated band' END AS "MPI_detail"
  FROM aged)"""


def needstates(rows: DataFrame) -> DataFrame:
    return rows.select(
        "ID", "City", "Year", F.col("p_type").alias("Needstates"),
        F.col("o_orderpriority").alias("Day#Daypart"), F.col("l_returnflag").alias("NeedstateGroup"),
        F.col("o_orderdate").alias("_day"), F.col("o_orderkey").alias("_order"), F.col("l_linenumber").alias("_line"),
    )


NEED_ORDER = ["_day", "_order", "_line", "Needstates", "Daypart", "NeedstateGroup"]
NEEDSTATES_SQL = """
needstate AS (
  SELECT "ID", "City", "Year", p_type AS "Needstates", o_orderpriority AS "Daypart",
         l_returnflag AS "NeedstateGroup", o_orderdate AS _day, o_orderkey AS _order, l_linenumber AS _line FROM lines)"""


def brandhealth(rows: DataFrame) -> DataFrame:
    """Respondent x brand: each funnel stage holds the brand, or nothing."""
    brand = F.col("brand")

    def when_any(condition, value=brand):
        return F.when(F.max(condition.cast("int")) == 1, value)

    return rows.groupBy("ID", "City", "Year", "brand").agg(
        when_any(F.col("l_linestatus") == "O").alias("Awareness"),
        F.when(F.count("*") >= 2, brand).alias("Spontaneous"),
        when_any(F.col("l_returnflag") == "R").alias("Trial"),
        when_any(F.col("month") >= 10).alias("P3M"),
        when_any(F.col("month") == 12).alias("P1M"),
        when_any(F.col("o_orderpriority") == "1-URGENT").alias("Weekly"),
        F.when(F.count("*") >= 3, brand).alias("Daily"),
        when_any(F.col("l_quantity") >= 45).alias("Brand_Likability"),
        F.when(F.max((F.col("p_type") == "PROMO").cast("int")) == 1, "Know well")
        .when(F.max((F.col("p_type") == "LARGE").cast("int")) == 1, "Don't know").alias("Comprehension"),
        F.nullif(F.sum((F.col("o_orderstatus") == "F").cast("double")), F.lit(0.0)).alias("Fre#visit"),
        F.round(F.sum("l_extendedprice"), 2).alias("Spending"),
        F.when(F.max((F.col("l_returnflag") == "A").cast("int")) == 1, F.round(F.avg("l_quantity"), 4)).alias("PPA"),
        F.nullif(F.floor(F.max("l_quantity") / 5).cast("double"), F.lit(10.0)).alias("NPS#P3M"),
    ).withColumnRenamed("brand", "Brand")


def _sql_when(condition: str) -> str:
    return f"CASE WHEN max(CAST({condition} AS INTEGER)) = 1 THEN brand END"


BRANDHEALTH_SQL = f"""
brandhealth AS (
  SELECT "ID", "City", "Year", brand AS "Brand",
    {_sql_when("l_linestatus = 'O'")} AS "Awareness",
    CASE WHEN count(*) >= 2 THEN brand END AS "Spontaneous",
    {_sql_when("l_returnflag = 'R'")} AS "Trial",
    {_sql_when("month >= 10")} AS "P3M",
    {_sql_when("month = 12")} AS "P1M",
    {_sql_when("o_orderpriority = '1-URGENT'")} AS "Weekly",
    CASE WHEN count(*) >= 3 THEN brand END AS "Daily",
    {_sql_when("l_quantity >= 45")} AS "Brand_Likability",
    CASE WHEN max(CAST(p_type = 'PROMO' AS INTEGER)) = 1 THEN 'Know well'
         WHEN max(CAST(p_type = 'LARGE' AS INTEGER)) = 1 THEN 'Don''t know' END AS "Comprehension",
    nullif(sum(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 0.0) AS "Frequency_Visit",
    round(sum(l_extendedprice), 2) AS "Spending",
    CASE WHEN max(CAST(l_returnflag = 'A' AS INTEGER)) = 1 THEN round(avg(l_quantity), 4) END AS "PPA",
    nullif(floor(max(l_quantity) / 5), 10.0) AS "NPS_P3M"
  FROM lines GROUP BY 1, 2, 3, 4)"""


def brand_images(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("l_returnflag") == "A").select(
        "ID", "City", "Year", F.when(F.col("l_linestatus") == "F", F.col("brand")).alias("Awareness"),
        F.col("p_type").alias("Attribute"), F.col("brand").alias("BrandImage"),
        F.col("o_orderdate").alias("_day"), F.col("o_orderkey").alias("_order"), F.col("l_linenumber").alias("_line"),
    )


IMAGE_ORDER = ["_day", "_order", "_line", "BrandImage", "Attribute", "Awareness"]
BRAND_IMAGES_SQL = f"""
brand_image AS (
  SELECT "ID", "City", "Year", coalesce(CASE WHEN l_linestatus = 'F' THEN brand END, '{FOCAL}') AS "Awareness",
         p_type AS "Attribute", brand AS "BrandImage", o_orderdate AS _day, o_orderkey AS _order, l_linenumber AS _line
  FROM lines WHERE l_returnflag = 'A')"""


def spending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits, spending and spending per visit of each customer."""
    orders = table(spark, sf_dir, "orders")
    per = orders.groupBy("o_custkey").agg(
        F.count("*").alias("Visit"), F.round(F.sum("o_totalprice"), 2).alias("Spending")
    )
    return per.select(
        F.col("o_custkey").cast("string").alias("ID"), "Visit", "Spending",
        (F.col("Spending") / F.col("Visit")).alias("PPA"),
    )


SPENDING_SQL = """
segmentation AS (
  SELECT CAST(o_custkey AS VARCHAR) AS "ID", count(*) AS "Visit", round(sum(o_totalprice), 2) AS "Spending",
         round(sum(o_totalprice), 2) / count(*) AS "PPA" FROM orders GROUP BY o_custkey)"""


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits (and no negative zero), for comparison by value."""
    return df.select(
        *[
            (F.round(F.col(f"`{name}`"), digits) + F.lit(0.0)).alias(name) if kind == "double" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def sql_round(expression: str, name: str, digits: int = 6) -> str:
    return f'round(CAST({expression} AS DOUBLE), {digits}) + 0.0 AS "{name}"'

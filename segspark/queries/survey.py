"""Queries over the cleaning, integration, feature and encoding operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from segspark.functions import columns as c
from segspark.functions import fixed
from segspark.operators import tables as t
from segspark.operators.describe import segment_rule_mismatches
from segspark.operators.encode import FeatureEncoder, FeatureSpec
from segspark.operators.features import FUNNEL, BrandSpec, build_features
from segspark.operators.quantiles import median
from segspark.operators.scaling import standardized, winsorize
from segspark.plans import cleaners, integrate
from segspark.queries import standins as s
from segspark.queries.standins import rounded, sql_round, table
from segspark.session import materialize, materialize_bucketed

BRANDS = BrandSpec(focal=s.FOCAL, keep=s.KEEP)


# ---- integration -----------------------------------------------------------

def merged(spark, sf_dir):
    """Demographics, need states, brand health, brand image and spending of one year, all cleaned."""
    # Four tables are derived from the joined lines, all by respondent: join once, in buckets of the ID, read four times.
    rows = materialize_bucketed(s.lines(spark, sf_dir), "ID", ["Year"])
    raw = {
        "sa_var": s.demographics(rows), "needstate": s.needstates(rows), "brandhealth": s.brandhealth(rows),
        "brand_image": s.brand_images(rows), "segmentation": s.spending(spark, sf_dir),
    }
    # Median and winsorizing limits of brand health come from all years, as the cleaner sees the whole table.
    parts = cleaners.clean_all(raw, s.FOCAL, ["Visit"], s.IMAGE_ORDER)
    order = {
        "needstate": s.NEED_ORDER, "brandhealth": ["Brand"], "brand_image": s.IMAGE_ORDER,
        "segmentation": ["Visit"],
    }
    return integrate.integrate(parts, s.YEAR, order)


_EVIDENCE = " AND ".join(
    f"coalesce({x} = '{s.FOCAL}', false)"
    for x in ['"P3M"', '"P1M"', 'coalesce("Spontaneous", "Awareness")', '"Brand_Likability"', '"Weekly"', '"Daily"']
)
_FILLED_SQL = f"""filled AS (
  SELECT "ID", "City", "Year", "Brand", "Awareness",
    coalesce("Spontaneous", "Awareness", 'Unknown') AS "Spontaneous",
    coalesce("Trial", CASE WHEN {_EVIDENCE} THEN '{s.FOCAL}' ELSE 'Unknown' END) AS "Trial",
    coalesce("P3M", "P1M", "Daily", "Weekly", 'Unknown') AS "P3M",
    coalesce("P1M", "Daily", "Weekly", 'Unknown') AS "P1M", "Weekly", "Daily", "Brand_Likability",
    coalesce("Comprehension", CASE WHEN "Awareness" = '{s.FOCAL}' THEN 'Know a little' ELSE 'Unknown' END) AS "Comprehension",
    "Frequency_Visit", "PPA", "Spending", "NPS_P3M" FROM brandhealth)"""


_VISIT_SQL = " OR ".join(
    f"coalesce(\"{x}\" = '{s.FOCAL}', false)" for x in ["Trial", "P3M", "P1M", "Brand_Likability", "Weekly", "Daily"]
)
_VISITED_SQL = f"""visited AS (
  SELECT * REPLACE (coalesce("Frequency_Visit", CASE WHEN {_VISIT_SQL} THEN
      (SELECT median("Frequency_Visit") FROM brandhealth) ELSE 0 END) AS "Frequency_Visit") FROM filled)"""


_LAST_IMAGE_SQL = """last_image AS (
  SELECT "ID", arg_max("BrandImage", (_day, _order, _line, "BrandImage", "Attribute", "Awareness")) AS img
  FROM brand_image GROUP BY "ID")"""
_LIKED_SQL = """liked AS (
  SELECT v.* REPLACE (coalesce("Brand_Likability", CASE WHEN "Frequency_Visit" > 3 THEN "Brand" END, img, 'Unknown')
      AS "Brand_Likability") FROM visited v LEFT JOIN last_image USING ("ID"))"""
HEALTH_CTES = f"""{s.BRANDHEALTH_SQL.replace("brandhealth AS", "health_raw AS")},
brandhealth AS (SELECT * FROM health_raw WHERE "Awareness" IS NOT NULL),
{_FILLED_SQL}, {_VISITED_SQL}, {_LAST_IMAGE_SQL}, {_LIKED_SQL},
tried AS (SELECT * REPLACE (
    CASE WHEN "Trial" = '{s.FOCAL}' THEN "Spending" ELSE 0.0::DOUBLE END AS "Spending",
    CASE WHEN "Trial" = '{s.FOCAL}' THEN "PPA" ELSE -1.0::DOUBLE END AS "PPA",
    coalesce("Weekly", 'Unknown') AS "Weekly", coalesce("Daily", 'Unknown') AS "Daily") FROM liked),
settled AS (SELECT * REPLACE (CASE WHEN "PPA" IS DISTINCT FROM -1 AND "Frequency_Visit" > 0
      THEN "Spending" / "Frequency_Visit" ELSE "PPA" END AS "PPA"),
    CASE WHEN "Spending" = -1 THEN '{fixed.SEGMENT_UNKNOWN}' WHEN "Spending" < 25000 THEN '{fixed.SEGMENT_MASS}'
      WHEN "Spending" BETWEEN 25000 AND 59000 THEN '{fixed.SEGMENT_MASS_ASPIRING}'
      WHEN "Spending" BETWEEN 60000 AND 99000 THEN '{fixed.SEGMENT_PREMIUM}'
      ELSE '{fixed.SEGMENT_SUPER_PREMIUM}' END AS "Segmentation" FROM tried),
scored AS (SELECT * REPLACE (coalesce("NPS_P3M", CASE
      WHEN "Brand_Likability" = '{s.FOCAL}' OR "Segmentation" IN ('{fixed.SEGMENT_SUPER_PREMIUM}', '{fixed.SEGMENT_PREMIUM}') THEN 9
      WHEN "Segmentation" = '{fixed.SEGMENT_MASS_ASPIRING}' THEN 8 ELSE -1 END) AS "NPS_P3M") FROM settled),
b AS (SELECT quantile_cont("Frequency_Visit"::DOUBLE, 0.01) f0, quantile_cont("Frequency_Visit"::DOUBLE, 0.99) f1,
    quantile_cont("Spending"::DOUBLE, 0.01) s0, quantile_cont("Spending"::DOUBLE, 0.99) s1,
    quantile_cont("NPS_P3M"::DOUBLE, 0.01) n0, quantile_cont("NPS_P3M"::DOUBLE, 0.99) n1 FROM scored),
health AS (SELECT * REPLACE (least(greatest("Frequency_Visit", f0), f1) AS "Frequency_Visit",
    CASE WHEN "Spending" IS NOT NULL THEN least(greatest("Spending", s0), s1) END AS "Spending",
    least(greatest("NPS_P3M", n0), n1) AS "NPS_P3M"),
  CASE WHEN "NPS_P3M" >= 9 THEN 'Promoter' WHEN "NPS_P3M" >= 8 THEN 'Passive' ELSE 'Detractive' END AS "NPS_P3M_Group"
  FROM scored, b)"""


def _first_sql(name, source, order, columns):
    inner = ", ".join(f'"{x}"' for x in columns)
    return (
        f"{name} AS (SELECT * FROM (SELECT \"ID\", \"City\", \"Year\", {inner}, row_number() OVER ("
        f'PARTITION BY "ID", "City", "Year" ORDER BY {", ".join(chr(34) + o + chr(34) for o in order)}) AS rn '
        f"FROM {source}) WHERE rn = 1)"
    )


_TEXT = ["Spontaneous", "Trial", "P3M", "P1M", "Comprehension", "Brand_Likability", "Weekly", "Daily"]
_INCOME = "CASE " + " ".join(
    f"WHEN \"MPI_Mean\" >= {lo} THEN '{name}'" for lo, name in reversed(fixed.INCOME_BANDS)
) + " END"
MERGED_CTES = ",".join([
    s.LINES_SQL, s.DEMOGRAPHICS_SQL, s.NEEDSTATES_SQL, s.BRAND_IMAGES_SQL, HEALTH_CTES, s.SPENDING_SQL,
    _first_sql("ns", "(SELECT DISTINCT * FROM needstate)", s.NEED_ORDER, ["Needstates", "Daypart", "NeedstateGroup"]),
    _first_sql("bh", "health", ["Brand"], ["Brand", *_TEXT, "NPS_P3M", "Segmentation", "NPS_P3M_Group"]),
    _first_sql("bi", "brand_image", s.IMAGE_ORDER, ["Awareness", "Attribute", "BrandImage"]),
    f"""merged AS (
  SELECT a."ID", a."City", a."Year", a."TOM", a."BUMO", a."MostFavourite",
    coalesce(a."BUMO_Previous", 'Unknown') AS "BUMO_Previous", coalesce(a."Group_size", -1) AS "Group_size",
    coalesce(a."Age", -1) AS "Age", a."Age_Group_2", a."Occupation",
    {", ".join(f"coalesce(ns.{chr(34)}{x}{chr(34)}, 'Unknown') AS {chr(34)}{x}{chr(34)}" for x in ["Needstates", "Daypart", "NeedstateGroup"])},
    coalesce(bh."Brand", 'Unknown') AS "Brand",
    {", ".join(f"coalesce(bh.{chr(34)}{x}{chr(34)}, 'Unknown') AS {chr(34)}{x}{chr(34)}" for x in _TEXT)},
    coalesce(bh."NPS_P3M", -1) AS "NPS_P3M",
    coalesce(bh."Segmentation", 'Unknown') AS "Segmentation", coalesce(bh."NPS_P3M_Group", 'Unknown') AS "NPS_P3M_Group",
    {", ".join(f"coalesce(bi.{chr(34)}{x}{chr(34)}, 'Unknown') AS {chr(34)}{x}{chr(34)}" for x in ["Awareness", "Attribute", "BrandImage"])},
    coalesce(sg."Visit", -1) AS "Visit", coalesce(sg."Spending", -1) AS "Spending", coalesce(sg."PPA", -1) AS "PPA"
  FROM sa_var a LEFT JOIN ns USING ("ID", "City", "Year") LEFT JOIN bh USING ("ID", "City", "Year")
  LEFT JOIN bi USING ("ID", "City", "Year") LEFT JOIN segmentation sg USING ("ID")
  WHERE a."Year" = {s.YEAR})""",
])


def integrate_customer(spark, sf_dir):
    return rounded(merged(spark, sf_dir))


_MERGED_COLUMNS = [
    "ID", "City", "Year", "TOM", "BUMO", "MostFavourite", "BUMO_Previous", "Age_Group_2", "Occupation",
    "Needstates", "Daypart", "NeedstateGroup", "Brand", *_TEXT, "Awareness", "Attribute", "BrandImage", "Visit",
    "Segmentation", "NPS_P3M_Group",
]
integrate_customer_sql = f"""WITH {MERGED_CTES}
SELECT {", ".join(f'"{x}"' for x in _MERGED_COLUMNS)},
  {", ".join(sql_round(f'"{x}"', x) for x in ["Group_size", "Age", "NPS_P3M", "Spending", "PPA"])} FROM merged"""


# ---- fills -----------------------------------------------------------------

_HEALTH_KEY = ["ID", "City", "Year", "Brand"]


def _health(spark, sf_dir):
    raw = s.brandhealth(s.lines(spark, sf_dir))
    return raw.withColumnsRenamed({"Fre#visit": "Frequency_Visit", "NPS#P3M": "NPS_P3M"})


_HEALTH_WITH = f"WITH {s.LINES_SQL},{s.BRANDHEALTH_SQL}"
def clean_fills(spark, sf_dir):
    """Ordered and evidence-based fills of the funnel answers."""
    filled = cleaners.fill_funnel(_health(spark, sf_dir), s.FOCAL)
    return filled.select(*_HEALTH_KEY, "Spontaneous", "Trial", "P3M", "P1M", "Comprehension")


clean_fills_sql = f"""{_HEALTH_WITH}, {_FILLED_SQL}
SELECT "ID", "City", "Year", "Brand", "Spontaneous", "Trial", "P3M", "P1M", "Comprehension" FROM filled"""

def median_zero_fill(spark, sf_dir):
    """Visits filled with the median or zero; the table is read for the median and for the fill."""
    health = materialize(_health(spark, sf_dir))
    filled = cleaners.fill_visits(cleaners.fill_funnel(health, s.FOCAL), s.FOCAL)
    return filled.select(*_HEALTH_KEY, "Frequency_Visit")


median_zero_fill_sql = f"""{_HEALTH_WITH}, {_FILLED_SQL}, {_VISITED_SQL}
SELECT "ID", "City", "Year", "Brand", CAST("Frequency_Visit" AS DOUBLE) AS "Frequency_Visit" FROM visited"""

def lookup_fill_last_wins(spark, sf_dir):
    """Likability gaps from own brand, then from the last brand image of the respondent."""
    rows = s.lines(spark, sf_dir)
    image = cleaners.clean_brand_image(s.brand_images(rows), s.FOCAL)
    health = materialize(_health(spark, sf_dir))
    filled = cleaners.fill_visits(cleaners.fill_funnel(health, s.FOCAL), s.FOCAL)
    out = cleaners.fill_likability(filled, image, s.IMAGE_ORDER)
    return out.select(*_HEALTH_KEY, "Brand_Likability")


lookup_fill_last_wins_sql = f"""{_HEALTH_WITH}, {s.BRAND_IMAGES_SQL}, {_FILLED_SQL}, {_VISITED_SQL},
{_LAST_IMAGE_SQL}, {_LIKED_SQL} SELECT "ID", "City", "Year", "Brand", "Brand_Likability" FROM liked"""


def clean_brandhealth(spark, sf_dir):
    """The whole brand-health cleaner: fills, spending rules, segments, scores, winsorizing."""
    rows = materialize_bucketed(s.lines(spark, sf_dir), "ID")
    image = cleaners.clean_brand_image(s.brand_images(rows), s.FOCAL)
    return rounded(cleaners.clean_brandhealth(s.brandhealth(rows), s.FOCAL, image, s.IMAGE_ORDER))


clean_brandhealth_sql = f"""WITH {s.LINES_SQL}, {s.BRAND_IMAGES_SQL}, {HEALTH_CTES}
SELECT "ID", "City", "Year", "Brand", "Awareness", "Spontaneous", "Trial", "P3M", "P1M", "Weekly", "Daily",
  "Brand_Likability", "Comprehension", "Segmentation", "NPS_P3M_Group",
  {", ".join(sql_round(f'"{x}"', x) for x in ["PPA", "Frequency_Visit", "Spending", "NPS_P3M"])} FROM health"""


# ---- the other cleaners ------------------------------------------------------

def clean_demographics(spark, sf_dir):
    return rounded(cleaners.clean_demographics(s.demographics(s.lines(spark, sf_dir))))


clean_demographics_sql = f"""WITH {s.LINES_SQL}, {s.DEMOGRAPHICS_SQL}
SELECT "ID", "City", "Year", "TOM", "BUMO", "MostFavourite", coalesce("BUMO_Previous", 'Unknown') AS "BUMO_Previous",
  "Age_Group_2", "Occupation", {sql_round('"Group_size"', "Group_size")}, {sql_round('"Age"', "Age")},
  coalesce("MPI_detail", {_INCOME}, 'Unknown') AS "IncomeBand" FROM sa_var"""


def clean_needstates(spark, sf_dir):
    """Distinct need states per respondent; types spelled with white space around them."""
    rows = s.needstates(s.lines(spark, sf_dir)).drop("_day", "_order", "_line")
    padded = rows.withColumn("Needstates", F.concat(F.lit("\t"), "Needstates", F.lit(" ")))
    return cleaners.clean_needstates(padded)


clean_needstates_sql = f"""WITH {s.LINES_SQL}, {s.NEEDSTATES_SQL}
SELECT DISTINCT "ID", "City", "Year", "Needstates", "Daypart", "NeedstateGroup" FROM needstate WHERE length("ID") <= 20"""


def clean_brand_image(spark, sf_dir):
    rows = s.brand_images(s.lines(spark, sf_dir)).drop("_day", "_order", "_line")
    return cleaners.clean_brand_image(rows, s.FOCAL)


clean_brand_image_sql = f"""WITH {s.LINES_SQL} SELECT "ID", "City", "Year", coalesce(a, '{s.FOCAL}') AS "Awareness",
  p_type AS "Attribute", brand AS "BrandImage" FROM (
  SELECT DISTINCT "ID", "City", "Year", CASE WHEN l_linestatus = 'F' THEN brand END AS a, p_type, brand
  FROM lines WHERE l_returnflag = 'A')"""


def clean_segmentation(spark, sf_dir):
    """First order of each customer as a segmentation row."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ID"), F.concat(F.lit(" "), "o_orderpriority").alias("Segmentation"),
        F.when(F.col("o_orderstatus") == "P", "Indepentdent Cafe").otherwise(F.col("o_orderstatus")).alias("Brand"),
        "o_totalprice", "o_orderdate", "o_orderkey",
    )
    return cleaners.clean_segmentation(rows, ["o_orderdate", "o_orderkey"])


clean_segmentation_sql = """SELECT CAST(o_custkey AS VARCHAR) AS "ID", o_orderpriority AS "Segmentation",
  CASE WHEN o_orderstatus = 'P' THEN 'Independent Cafe' ELSE o_orderstatus END AS "Brand", o_totalprice, o_orderdate, o_orderkey
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1"""


# ---- deduplication, text, filters -------------------------------------------

def dedup_keep_first(spark, sf_dir):
    """First order of each customer."""
    orders = table(spark, sf_dir, "orders")
    return t.keep_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


dedup_keep_first_sql = """SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1"""


def dedup_rows(spark, sf_dir):
    return t.drop_duplicate_rows(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    )


dedup_rows_sql = "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem"


def text_normalise(spark, sf_dir):
    """White space off both ends; spelling repaired by a map; null stays null."""
    orders = table(spark, sf_dir, "orders")
    padded = F.concat(F.lit(" \t"), F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("\r\n "))
    repairs = {"4-NOT SPECIFIED": "4-UNSPECIFIED", "3-MEDIUM": "3-NORMAL"}
    return orders.select(
        "o_orderkey", c.replace_values(c.strip(padded), repairs).alias("priority"),
        c.fix_brand_spelling(F.when(F.col("o_orderstatus") == "P", "Indepentdent Cafe").otherwise("Other")).alias("brand"),
    )


text_normalise_sql = r"""SELECT o_orderkey,
  CASE p WHEN '4-NOT SPECIFIED' THEN '4-UNSPECIFIED' WHEN '3-MEDIUM' THEN '3-NORMAL' ELSE p END AS priority,
  CASE WHEN o_orderstatus = 'P' THEN 'Independent Cafe' ELSE 'Other' END AS brand
FROM (SELECT *, regexp_replace(' ' || chr(9) || nullif(o_orderpriority, '5-LOW') || chr(13) || chr(10) || ' ',
  '^\s+|\s+$', '', 'g') AS p FROM orders)"""


_TYPE_GROUP = {"ECONOMY": "A", "STANDARD": "N", "PROMO": "R", "MEDIUM": "A", "SMALL": "N"}


def mapping_mismatch(spark, sf_dir):
    """Lines whose return flag is not the one the type map gives; unmapped types count."""
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    bad = t.mapping_mismatches(rows, "p_type", "l_returnflag", _TYPE_GROUP)
    return bad.select("l_orderkey", "l_linenumber", "p_type", "l_returnflag", "MappedGroup")


mapping_mismatch_sql = f"""SELECT l_orderkey, l_linenumber, p_type, l_returnflag, g AS "MappedGroup"
FROM lineitem JOIN part ON l_partkey = p_partkey
LEFT JOIN (VALUES {", ".join(f"('{a}', '{b}')" for a, b in _TYPE_GROUP.items())}) AS m(x, g) ON p_type = x
WHERE g IS DISTINCT FROM l_returnflag"""


def id_length_filter(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    wide = F.concat_ws("-", "c_name", F.col("c_nationkey").cast("string"))
    return t.short_keys_only(customers.select(wide.alias("ID"), "c_mktsegment"), "ID", 20)


id_length_filter_sql = """SELECT "ID", c_mktsegment FROM (
  SELECT c_name || '-' || CAST(c_nationkey AS VARCHAR) AS "ID", c_mktsegment FROM customer) WHERE length("ID") <= 20"""


# ---- bands and rules ---------------------------------------------------------

def income_band(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    detail = F.when(F.col("c_mktsegment") == "BUILDING", "Stated band")
    band = F.coalesce(detail, c.income_band(F.col("c_acctbal") * 10), F.lit(fixed.UNKNOWN))
    return rows.select("c_custkey", band.alias("IncomeBand"))


income_band_sql = f"""SELECT c_custkey, coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN 'Stated band' END,
  {_INCOME.replace('"MPI_Mean"', 'c_acctbal * 10')}, 'Unknown') AS "IncomeBand" FROM customer"""


def segment_band(spark, sf_dir):
    """Spending segments in both readings; pending orders have no amount yet."""
    x = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", c.spend_segment(x).alias("segment"), c.spend_segment(x, strict=True).alias("segment_strict")
    )


segment_band_sql = f"""SELECT o_orderkey, CASE WHEN x = -1 THEN '{fixed.SEGMENT_UNKNOWN}'
    WHEN x < 25000 THEN '{fixed.SEGMENT_MASS}' WHEN x BETWEEN 25000 AND 59000 THEN '{fixed.SEGMENT_MASS_ASPIRING}'
    WHEN x BETWEEN 60000 AND 99000 THEN '{fixed.SEGMENT_PREMIUM}' ELSE '{fixed.SEGMENT_SUPER_PREMIUM}' END AS segment,
  CASE WHEN x IS NULL OR x = -1 THEN '{fixed.SEGMENT_UNKNOWN}'
    WHEN x < 25000 THEN '{fixed.SEGMENT_MASS}' WHEN x < 60000 THEN '{fixed.SEGMENT_MASS_ASPIRING}'
    WHEN x <= 99000 THEN '{fixed.SEGMENT_PREMIUM}' ELSE '{fixed.SEGMENT_SUPER_PREMIUM}' END AS segment_strict
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS x FROM orders)"""


def nps_group(spark, sf_dir):
    """Score gaps filled from brand and segment, then grouped."""
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    segment = c.spend_segment("l_extendedprice")
    score = F.nullif(F.floor(F.col("l_quantity") / 5).cast("double"), F.lit(10.0))
    nps = c.nps_filled(score, "p_brand", segment, s.FOCAL)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", nps.alias("nps"), c.nps_group(nps).alias("grp"))


nps_group_sql = f"""SELECT l_orderkey, l_linenumber, l_partkey, nps,
  CASE WHEN nps >= 9 THEN 'Promoter' WHEN nps >= 8 THEN 'Passive' ELSE 'Detractive' END AS grp
FROM (SELECT *, CAST(coalesce(nullif(floor(l_quantity / 5), 10.0), CASE WHEN p_brand = '{s.FOCAL}'
    OR NOT (x < 25000 OR x BETWEEN 25000 AND 59000) THEN 9
    WHEN x BETWEEN 25000 AND 59000 THEN 8 ELSE -1 END) AS DOUBLE) AS nps
  FROM (SELECT *, l_extendedprice AS x FROM lineitem JOIN part ON l_partkey = p_partkey))"""


def segment_rule_check(spark, sf_dir):
    """Customers whose spending segment disagrees with the band of their spending per visit."""
    rows = s.spending(spark, sf_dir).withColumn("Segmentation", c.spend_segment(F.col("Spending") / 30))
    bad = segment_rule_mismatches(rows.withColumn("PPA", F.col("PPA") / 2500), bounds=(25, 60, 100))
    return rounded(bad.select("ID", "Segmentation", "PPA"), 9)


segment_rule_check_sql = f"""WITH {s.SPENDING_SQL},
x AS (SELECT "ID", "PPA" / 2500 AS r, "Spending" / 30 AS x FROM segmentation),
l AS (SELECT *, CASE WHEN x < 25000 THEN 1 WHEN x BETWEEN 25000 AND 59000 THEN 2
  WHEN x BETWEEN 60000 AND 99000 THEN 3 ELSE 4 END AS k FROM x)
SELECT "ID", CASE k WHEN 1 THEN '{fixed.SEGMENT_MASS}' WHEN 2 THEN '{fixed.SEGMENT_MASS_ASPIRING}'
  WHEN 3 THEN '{fixed.SEGMENT_PREMIUM}' ELSE '{fixed.SEGMENT_SUPER_PREMIUM}' END AS "Segmentation", {sql_round("r", "PPA", 9)}
FROM l WHERE k = 1 AND r >= 25 OR k = 2 AND (r < 25 OR r >= 60) OR k = 3 AND (r < 60 OR r >= 100) OR k = 4 AND r < 100"""


# ---- outliers and logs ---------------------------------------------------------

def _gappy_orders(spark, sf_dir):
    """Orders; pending ones have no price."""
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select("o_orderkey", price.alias("price"))


_GAPPY_SQL = "g AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders)"


def winsorized(spark, sf_dir):
    return rounded(winsorize(_gappy_orders(spark, sf_dir), ["price"]))


winsorized_sql = f"""WITH {_GAPPY_SQL}, q AS (SELECT quantile_cont(price, 0.01) a, quantile_cont(price, 0.99) b FROM g)
SELECT o_orderkey, {sql_round("CASE WHEN price IS NOT NULL THEN least(greatest(price, a), b) END", "price")} FROM g, q"""


def log_clamp(spark, sf_dir):
    """log(1 + x) with negatives at zero, and back."""
    rows = table(spark, sf_dir, "customer")
    logged = c.log1p_clamped("c_acctbal")
    return rounded(rows.select("c_custkey", logged.alias("logged"), c.log1p_inverse(logged).alias("back")))


log_clamp_sql = f"""SELECT c_custkey, {sql_round("ln(1 + greatest(c_acctbal, 0))", "logged")},
  {sql_round("exp(ln(1 + greatest(c_acctbal, 0))) - 1", "back")} FROM customer"""


# ---- features ------------------------------------------------------------------

_FEATURE_COLUMNS = [
    *[f"{x}_Group" for x in BRANDS.grouped], *[f"{x}_flag" for x in FUNNEL],
    "Brand_Loyalty", "Brand_Switcher", "Funnel_Depth", "Awareness_Usage_Gap", "Need_is_Drinking",
]


def featured(spark, sf_dir):
    """The cleaned, integrated table with the behaviour features of each respondent."""
    return build_features(merged(spark, sf_dir), BRANDS, s.NEED_TEXT)


def brand_features(spark, sf_dir):
    return featured(spark, sf_dir).select("ID", "City", *_FEATURE_COLUMNS)


_KEEP_SQL = ", ".join(f"'{x}'" for x in s.KEEP)
FEATURED_CTES = f"""{MERGED_CTES},
grouped AS (SELECT *, {", ".join(f'''CASE WHEN "{x}" IN ({_KEEP_SQL}) THEN "{x}" ELSE 'Others' END AS "{x}_Group"''' for x in BRANDS.grouped)},
  {", ".join(f'''CAST("{x}" = '{s.FOCAL}' AS INTEGER) AS "{x}_flag"''' for x in FUNNEL)} FROM merged),
featured AS (SELECT *, CAST("TOM_Group" = "BUMO_Group" AS INTEGER) + CAST("BUMO_Group" = "MostFavourite" AS INTEGER)
    + CAST("BUMO_Group" = "BUMO_Previous_Group" AS INTEGER) + CAST("MostFavourite_Group" = "MostFavourite" AS INTEGER) AS "Brand_Loyalty",
  CAST("BUMO_Group" <> "BUMO_Previous_Group" AS INTEGER) AS "Brand_Switcher",
  {" + ".join(f'"{x}_flag"' for x in FUNNEL)} AS "Funnel_Depth",
  "Awareness_flag" - "Trial_flag" AS "Awareness_Usage_Gap",
  CAST(lower("Needstates") LIKE '%{s.NEED_TEXT}%' AS INTEGER) AS "Need_is_Drinking" FROM grouped)"""
brand_features_sql = f"""WITH {FEATURED_CTES}
SELECT "ID", "City", {", ".join(f'"{x}"' for x in _FEATURE_COLUMNS)} FROM featured"""


# ---- encoding --------------------------------------------------------------------

def _long(df, key):
    names = [x for x in df.columns if x != key]
    return rounded(t.melted(df, names, "double", [key]))


def encode_standard(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"), F.max("l_discount").alias("discount"),
        F.lit(3.0).alias("constant"),
    )
    return rounded(standardized(rows, ["quantity", "discount", "constant"]))


encode_standard_sql = f"""WITH r AS (SELECT l_orderkey, sum(l_quantity) q, max(l_discount) d FROM lineitem GROUP BY 1),
s AS (SELECT avg(q) mq, stddev_pop(q) sq, avg(d) md, stddev_pop(d) sd FROM r)
SELECT l_orderkey, {sql_round("(q - mq) / sq", "quantity")}, {sql_round("(d - md) / sd", "discount")},
  0.0::DOUBLE AS constant FROM r, s"""


def encode_minmax(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("constant", F.lit(7.0))
    model = FeatureEncoder(FeatureSpec(numeric=["c_acctbal", "constant"], scaler="minmax")).fit(rows)
    return _long(model.transform(rows, ["c_custkey"]), "c_custkey")


encode_minmax_sql = f"""WITH s AS (SELECT min(c_acctbal) a, max(c_acctbal) b FROM customer)
SELECT c_custkey, 'c_acctbal' AS feature, {sql_round("(c_acctbal - a) / (b - a)", "value")} FROM customer, s
UNION ALL SELECT c_custkey, 'constant', 0.0::DOUBLE FROM customer"""


_PRIORITIES = ["5-LOW", "3-MEDIUM", "1-URGENT"]


def encode_ordinal(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    model = FeatureEncoder(FeatureSpec(ordinal={"o_orderpriority": _PRIORITIES})).fit(rows)
    return model.transform(rows, ["o_orderkey"])


encode_ordinal_sql = """SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1
  WHEN '1-URGENT' THEN 2 ELSE -1 END AS DOUBLE) AS o_orderpriority FROM orders"""


def encode_onehot(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    model = FeatureEncoder(FeatureSpec(categorical=["c_mktsegment", "n_name"])).fit(rows)
    return _long(model.transform(rows, ["c_custkey"]), "c_custkey")


encode_onehot_sql = """WITH v AS (
  SELECT c_custkey, 'c_mktsegment' AS col, c_mktsegment AS val FROM customer
  UNION ALL SELECT c_custkey, 'n_name', n_name FROM customer JOIN nation ON c_nationkey = n_nationkey),
k AS (SELECT col, val FROM (SELECT col, val, row_number() OVER (PARTITION BY col ORDER BY val) AS rn
  FROM (SELECT DISTINCT col, val FROM v)) WHERE rn > 1)
SELECT c_custkey, k.col || '_' || k.val AS feature, CAST(v.val = k.val AS INTEGER)::DOUBLE AS value
FROM v JOIN k ON v.col = k.col"""


ENCODE_SPEC = FeatureSpec(
    log_numeric=["Visit", "Spending", "PPA"],
    numeric=["Age", "Group_size", "NPS_P3M", *_FEATURE_COLUMNS[-5:], *[f"{x}_flag" for x in FUNNEL]],
    ordinal={"Age_Group_2": fixed.AGE_GROUP_ORDER, "Comprehension": fixed.COMPREHENSION_ORDER},
    categorical=["Occupation", "Daypart", "NeedstateGroup", *[f"{x}_Group" for x in BRANDS.grouped]],
)


def encode_all(spark, sf_dir):
    """The whole encoder on the integrated, featured table, in long form."""
    rows = materialize(featured(spark, sf_dir))
    model = FeatureEncoder(ENCODE_SPEC).fit(rows)
    return _long(model.transform(rows, ["ID"]), "ID")


def _encode_all_sql():
    scaled, stats = [], []
    for i, x in enumerate([*ENCODE_SPEC.log_numeric, *ENCODE_SPEC.numeric]):
        value = f'ln(1 + greatest("{x}", 0))' if x in ENCODE_SPEC.log_numeric else f'"{x}"'
        stats.append(f"avg({value}) AS m{i}, CASE WHEN stddev_pop({value}) = 0 THEN 1 ELSE stddev_pop({value}) END AS s{i}")
        scaled.append(f"SELECT \"ID\", '{x}' AS feature, {sql_round(f'({value} - m{i}) / s{i}', 'value')} FROM featured, st")
    for x, levels in ENCODE_SPEC.ordinal.items():
        case = " ".join("WHEN '" + v.replace("'", "''") + f"' THEN {i}" for i, v in enumerate(levels))
        scaled.append(f"SELECT \"ID\", '{x}', CAST(CASE \"{x}\" {case} ELSE -1 END AS DOUBLE) FROM featured")
    for x in ENCODE_SPEC.categorical:
        scaled.append(
            f"SELECT f.\"ID\", '{x}_' || k.v, CAST(f.\"{x}\" = k.v AS INTEGER)::DOUBLE FROM featured f JOIN ("
            f'SELECT DISTINCT "{x}" AS v FROM featured WHERE "{x}" > (SELECT min("{x}") FROM featured)) k ON true'
        )
    return f"WITH {FEATURED_CTES}, st AS (SELECT {', '.join(stats)} FROM featured)\n" + "\nUNION ALL ".join(scaled)


# ---- registry ----------------------------------------------------------------------

QUERIES = {
    "integrate_customer": (integrate_customer, integrate_customer_sql),
    "clean_fills": (clean_fills, clean_fills_sql),
    "median_zero_fill": (median_zero_fill, median_zero_fill_sql),
    "lookup_fill_last_wins": (lookup_fill_last_wins, lookup_fill_last_wins_sql),
    "clean_brandhealth": (clean_brandhealth, clean_brandhealth_sql),
    "clean_demographics": (clean_demographics, clean_demographics_sql),
    "clean_needstates": (clean_needstates, clean_needstates_sql),
    "clean_brand_image": (clean_brand_image, clean_brand_image_sql),
    "clean_segmentation": (clean_segmentation, clean_segmentation_sql),
    "dedup_keep_first": (dedup_keep_first, dedup_keep_first_sql),
    "dedup_rows": (dedup_rows, dedup_rows_sql),
    "text_normalise": (text_normalise, text_normalise_sql),
    "mapping_mismatch": (mapping_mismatch, mapping_mismatch_sql),
    "id_length_filter": (id_length_filter, id_length_filter_sql),
    "income_band": (income_band, income_band_sql),
    "segment_band": (segment_band, segment_band_sql),
    "nps_group": (nps_group, nps_group_sql),
    "segment_rule_check": (segment_rule_check, segment_rule_check_sql),
    "winsorize": (winsorized, winsorized_sql),
    "log_clamp": (log_clamp, log_clamp_sql),
    "brand_features": (brand_features, brand_features_sql),
    "encode_standard": (encode_standard, encode_standard_sql),
    "encode_minmax": (encode_minmax, encode_minmax_sql),
    "encode_ordinal": (encode_ordinal, encode_ordinal_sql),
    "encode_onehot": (encode_onehot, encode_onehot_sql),
    "encode_all": (encode_all, _encode_all_sql()),
}

"""Queries over descriptive statistics, cluster profiles, and file and table reports."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import functions as F

from segspark.operators import describe as d
from segspark.operators import profiles as p
from segspark.operators import tables as t
from segspark.queries import standins as s
from segspark.queries.standins import rounded, sql_round, table
from segspark.session import scratch_root
from segspark.sources.files import read_delimited, write_table

ITEM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _items(spark, sf_dir):
    """Line items; a zero discount or tax counts as not recorded."""
    return table(spark, sf_dir, "lineitem").withColumns(
        {"l_discount": F.nullif("l_discount", F.lit(0.0)), "l_tax": F.nullif("l_tax", F.lit(0.0))}
    )


ITEMS_SQL = "items AS (SELECT * REPLACE (nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax) FROM lineitem)"


def _union(template, columns=ITEM):
    return " UNION ALL ".join(template.replace("$c", x) for x in columns)


def describe_numeric(spark, sf_dir):
    return rounded(d.describe_numeric(_items(spark, sf_dir), ITEM))


describe_numeric_sql = f"WITH {ITEMS_SQL} " + _union(
    "SELECT '$c' AS feature, count($c) AS count, "
    + ", ".join(
        sql_round(e, n) for e, n in [
            ("avg($c)", "mean"), ("stddev_samp($c)", "std"), ("min($c)", "min"),
            ("quantile_cont($c, 0.25)", "p25"), ("quantile_cont($c, 0.5)", "p50"),
            ("quantile_cont($c, 0.75)", "p75"), ("max($c)", "max"),
        ]
    ) + " FROM items"
)


PROBS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def custom_percentiles(spark, sf_dir):
    return rounded(d.percentiles(_items(spark, sf_dir), ITEM, PROBS))


custom_percentiles_sql = f"WITH {ITEMS_SQL} " + " UNION ALL ".join(
    f"SELECT '{x}' AS feature, {q}::DOUBLE AS prob, {sql_round(f'quantile_cont({x}, {q})', 'value')} FROM items"
    for x in ITEM for q in PROBS
)


def tail_count(spark, sf_dir):
    return rounded(d.count_above_quantile(_items(spark, sf_dir), ITEM, 0.99))


tail_count_sql = f"WITH {ITEMS_SQL}, q AS (SELECT {', '.join(f'quantile_cont({x}, 0.99) AS q_{x}' for x in ITEM)} FROM items) " + _union(
    f"SELECT '$c' AS feature, {sql_round('min(q_$c)', 'threshold')}, count(*) FILTER (WHERE $c > q_$c) AS n_above FROM items, q"
)

MIXED = ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax"]


def null_distinct_counts(spark, sf_dir):
    return d.null_distinct_counts(_items(spark, sf_dir), MIXED)


null_distinct_counts_sql = f"WITH {ITEMS_SQL} " + _union(
    "SELECT '$c' AS feature, count(*) - count($c) AS null_count, count(DISTINCT $c) AS distinct_count FROM items", MIXED
)

CATS = ["o_orderstatus", "o_orderpriority", "late"]


def _orders(spark, sf_dir):
    """Orders; whether an order is late is known only once it is not pending."""
    late = F.when(F.col("o_orderstatus") != "P", (F.month("o_orderdate") >= 7).cast("string"))
    return table(spark, sf_dir, "orders").withColumn("late", late)


ORDERS_SQL = """o AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN CAST(month(o_orderdate) >= 7 AS VARCHAR) END AS late FROM orders)"""


def value_counts(spark, sf_dir):
    return d.value_counts(_orders(spark, sf_dir), CATS)


value_counts_sql = f"WITH {ORDERS_SQL} " + _union(
    "SELECT '$c' AS feature, $c AS value, count(*) AS n FROM o GROUP BY 2", CATS
)


def corr_matrix(spark, sf_dir):
    """Pairwise Pearson correlation, raw and after log(1 + x)."""
    rows = _items(spark, sf_dir)
    raw = d.correlation_matrix(rows, ITEM).withColumn("form", F.lit("raw"))
    logged = d.correlation_matrix(rows, ITEM, log=True).withColumn("form", F.lit("log"))
    return rounded(raw.unionByName(logged))


def _corr_sql():
    parts = []
    for form, wrap in (("raw", "{}"), ("log", "ln(1 + greatest({}, 0))")):
        for a, b in itertools.product(ITEM, ITEM):
            x, y = (f"CASE WHEN {v} IS NOT NULL THEN {wrap.format(v)} END" for v in (a, b))
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, '{form}' AS form, {sql_round(f'corr({x}, {y})', 'r')} FROM items")
    return f"WITH {ITEMS_SQL} " + " UNION ALL ".join(parts)


def crosstab(spark, sf_dir):
    return d.crosstab(_orders(spark, sf_dir), "o_orderpriority", "late")


crosstab_sql = f"WITH {ORDERS_SQL} SELECT o_orderpriority, late, count(*) AS n FROM o GROUP BY 1, 2"

PAIRED = ["c_mktsegment", "n_name", "rich", "debt"]


def cramers_v(spark, sf_dir):
    """Association of every categorical pair, two of them binary."""
    rows = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).withColumns({
        "rich": (F.col("c_acctbal") > 5000).cast("string"),
        "debt": F.when(F.col("c_mktsegment") != "BUILDING", (F.col("c_acctbal") < 1000).cast("string")),
    })
    return rounded(d.cramers_v(rows, PAIRED))


def _cramers_sql():
    """Every cell of the contingency table is listed, empty ones included."""
    parts = []
    for a, b in itertools.product(PAIRED, PAIRED):
        parts.append(f"""SELECT '{a}' AS a, '{b}' AS b, {sql_round("v", "v")} FROM (
  WITH z AS (SELECT {a} AS x, {b} AS y FROM c WHERE {a} IS NOT NULL AND {b} IS NOT NULL),
  r AS (SELECT x, count(*)::DOUBLE AS rn FROM z GROUP BY 1), k AS (SELECT y, count(*)::DOUBLE AS kn FROM z GROUP BY 1),
  o AS (SELECT x, y, count(*)::DOUBLE AS o FROM z GROUP BY 1, 2),
  s AS (SELECT (SELECT count(*) FROM r) AS nr, (SELECT count(*) FROM k) AS nk, (SELECT count(*) FROM z) AS n),
  e AS (SELECT coalesce(o, 0) AS o, rn * kn / n AS e, nr, nk, n FROM r CROSS JOIN k CROSS JOIN s LEFT JOIN o USING (x, y)),
  h AS (SELECT sum(CASE WHEN nr = 2 AND nk = 2 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) ELSE pow(o - e, 2) END / e) AS chi2,
        min(n) AS n, min(least(nr, nk)) - 1 AS m FROM e)
  SELECT CASE WHEN m = 0 THEN 0 ELSE sqrt(chi2 / n / m) END AS v FROM h)""")
    return """WITH c AS (SELECT c_mktsegment, n_name, CAST(c_acctbal > 5000 AS VARCHAR) AS rich,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_acctbal < 1000 AS VARCHAR) END AS debt
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
""" + "\nUNION ALL ".join(parts)


def histogram(spark, sf_dir):
    return rounded(d.histogram(table(spark, sf_dir, "orders"), "o_totalprice", 20))


histogram_sql = f"""WITH s AS (SELECT min(o_totalprice) lo, max(o_totalprice) hi FROM orders),
c AS (SELECT least(floor((o_totalprice - lo) / ((hi - lo) / 20)), 19)::INTEGER AS bin, count(*) AS n FROM orders, s GROUP BY 1)
SELECT b.bin::INTEGER AS bin, {sql_round("lo + b.bin * ((hi - lo) / 20)", "lower")},
  {sql_round("lo + (b.bin + 1) * ((hi - lo) / 20)", "upper")}, coalesce(n, 0) AS n
FROM range(20) b(bin) CROSS JOIN s LEFT JOIN c ON b.bin = c.bin"""


def box_stats(spark, sf_dir):
    return rounded(d.box_stats(_items(spark, sf_dir), ITEM))


def _box_sql(source, columns, ctes=""):
    per = []
    for x in columns:
        near = f"{x} BETWEEN a - 1.5 * (z - a) AND z + 1.5 * (z - a)"
        per.append(
            f"SELECT '{x}' AS feature, {sql_round('min(a)', 'q1')}, {sql_round('min(m)', 'median')}, {sql_round('min(z)', 'q3')}, "
            f"{sql_round(f'min({x}) FILTER (WHERE {near})', 'whisker_low')}, {sql_round(f'max({x}) FILTER (WHERE {near})', 'whisker_high')}, "
            f"count(*) FILTER (WHERE NOT ({near})) AS n_outliers FROM {source}, (SELECT quantile_cont({x}::DOUBLE, 0.25) a, "
            f"quantile_cont({x}::DOUBLE, 0.5) m, quantile_cont({x}::DOUBLE, 0.75) z FROM {source})"
        )
    return f"WITH {ctes} " + " UNION ALL ".join(per)


def freq_box_stats(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return rounded(d.frequency_box_stats(parts, ["p_brand", "p_type", "p_name"]))


freq_box_stats_sql = _box_sql("w", ["p_brand", "p_type", "p_name"], """w AS (
  SELECT count(*) AS p_brand, NULL::BIGINT AS p_type, NULL::BIGINT AS p_name FROM part GROUP BY part.p_brand
  UNION ALL SELECT NULL, count(*), NULL FROM part GROUP BY part.p_type
  UNION ALL SELECT NULL, NULL, count(*) FROM part GROUP BY part.p_name)""")


def kde_grid(spark, sf_dir):
    """Density of the log price of orders at 50 points."""
    rows = table(spark, sf_dir, "orders").select(F.log1p("o_totalprice").alias("x"))
    return rounded(d.kde_curve(rows, "x", 50))


kde_grid_sql = f"""WITH v AS (SELECT ln(1 + o_totalprice) AS x FROM orders),
s AS (SELECT min(x) lo, max(x) hi, stddev_samp(x) * pow(count(*), -0.2) AS h FROM v),
g AS (SELECT i::INTEGER AS point, lo + (hi - lo) * (i / 49.0::DOUBLE) AS gx, h FROM range(50) r(i), s)
SELECT point, {sql_round("min(gx)", "x")},
  {sql_round(f"avg(exp(-0.5 * pow((gx - x) / h, 2)) / (h * {math.sqrt(2 * math.pi)!r}))", "density")}
FROM g, v GROUP BY point"""


def normal_fit(spark, sf_dir):
    return rounded(d.normal_fit(table(spark, sf_dir, "orders"), ["o_totalprice"], 50))


normal_fit_sql = f"""WITH v AS (SELECT ln(1 + o_totalprice) AS x FROM orders),
s AS (SELECT avg(x) m, stddev_pop(x) sd, min(x) lo, max(x) hi FROM v)
SELECT 'o_totalprice' AS feature, i::INTEGER AS point, {sql_round("m", "mean")}, {sql_round("sd", "std")},
  {sql_round("lo + (hi - lo) * i / 49", "x")},
  {sql_round(f"exp(-0.5 * pow((lo + (hi - lo) * i / 49 - m) / sd, 2)) / (sd * {math.sqrt(2 * math.pi)!r})", "density")}
FROM s, range(50) r(i)"""


# ---- cluster profiles: the market segment stands for the cluster --------------------

PROFILE = ["n_orders", "spend", "first_month", "c_acctbal"]


def _customers(spark, sf_dir):
    """Customers with order behaviour; the favourite priority and nation are categories."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spend"),
        F.min(F.struct("o_orderdate", "o_orderkey", F.month("o_orderdate").alias("m"), "o_orderpriority")).alias("first"),
    )
    return (
        table(spark, sf_dir, "customer")
        .join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey", F.col("c_mktsegment").alias("cluster"), "n_orders", "spend", "c_acctbal", "n_name",
            F.col("first.m").alias("first_month"), F.col("first.o_orderpriority").alias("priority"),
        )
    )


CUSTOMERS_SQL = """f AS (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spend,
  arg_min(month(o_orderdate), (o_orderdate, o_orderkey)) AS first_month,
  arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS priority FROM orders GROUP BY 1),
c AS (SELECT c_custkey, c_mktsegment AS cluster, n_orders, spend, first_month, c_acctbal, n_name, priority
  FROM customer LEFT JOIN f ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def cluster_profile_mean(spark, sf_dir):
    return rounded(p.cluster_means(_customers(spark, sf_dir), PROFILE), 5)


cluster_profile_mean_sql = f"WITH {CUSTOMERS_SQL} SELECT cluster, {', '.join(sql_round(f'avg({x})', x, 5) for x in PROFILE)} FROM c GROUP BY 1"


def cluster_summary(spark, sf_dir):
    return p.cluster_sizes(_customers(spark, sf_dir))


cluster_summary_sql = f"""WITH {CUSTOMERS_SQL} SELECT cluster, count(*) AS size,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM c), 2) AS percentage FROM c GROUP BY 1"""


def cluster_vs_overall(spark, sf_dir):
    return rounded(p.cluster_against_overall(_customers(spark, sf_dir), PROFILE, band=1.0), 5)


_VS_SQL = "v AS (" + " UNION ALL ".join(
    f"SELECT cluster, '{x}' AS feature, avg({x}) AS cm, (SELECT avg({x}) FROM c) AS om FROM c GROUP BY 1" for x in PROFILE
) + "), w AS (SELECT *, CASE WHEN om = 0 THEN 0 ELSE (cm - om) / om * 100 END AS dp FROM v)"
cluster_vs_overall_sql = f"""WITH {CUSTOMERS_SQL}, {_VS_SQL} SELECT cluster, feature, {sql_round("cm", "cluster_mean", 5)},
  {sql_round("om", "overall_mean", 5)}, {sql_round("dp", "diff_pct", 5)},
  CASE WHEN dp > 1 THEN 'up' WHEN dp < -1 THEN 'down' ELSE 'flat' END AS direction FROM w"""

MODES = ["n_name", "priority"]


def cluster_mode(spark, sf_dir):
    return rounded(p.cluster_modes(_customers(spark, sf_dir), MODES))


_MODE_SQL = "k AS (" + " UNION ALL ".join(
    f"SELECT cluster, '{x}' AS feature, {x} AS value, count(*) AS n FROM c GROUP BY 1, 3" for x in MODES
) + """), m AS (SELECT *, sum(n) OVER (PARTITION BY cluster, feature) AS total, row_number() OVER (
  PARTITION BY cluster, feature ORDER BY value IS NULL, n DESC, value) AS rn FROM k)"""
cluster_mode_sql = f"""WITH {CUSTOMERS_SQL}, {_MODE_SQL} SELECT cluster, feature, value AS mode, n AS mode_n,
  {sql_round("n / total * 100", "mode_pct")} FROM m WHERE rn = 1"""


def profiling_wide(spark, sf_dir):
    return rounded(p.profile_table(_customers(spark, sf_dir), PROFILE, MODES), 5)


profiling_wide_sql = f"""WITH {CUSTOMERS_SQL}, {_MODE_SQL}
SELECT cluster, count(*) AS size, {', '.join(sql_round(f'avg({x})', x + '_mean', 5) for x in PROFILE)},
  {', '.join(f"(SELECT value FROM m WHERE m.cluster = c.cluster AND feature = '{x}' AND rn = 1) AS {x}_mode" for x in MODES)}
FROM c GROUP BY 1"""


def distinctive_features(spark, sf_dir):
    return rounded(p.distinctive_features(_customers(spark, sf_dir), PROFILE, top=3), 5)


distinctive_features_sql = f"""WITH {CUSTOMERS_SQL}, {_VS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY abs(cm - om) DESC, feature)::INTEGER AS rank FROM w)
SELECT cluster, rank, feature, {sql_round("cm - om", "diff", 5)} FROM r WHERE rank <= 3"""


def variance_rank(spark, sf_dir):
    return rounded(p.variance_ranking(_items(spark, sf_dir), ITEM, 3), 4)


variance_rank_sql = f"""WITH {ITEMS_SQL}, v AS ({_union("SELECT '$c' AS feature, var_samp($c) AS v FROM items")})
SELECT feature, {sql_round("v", "variance", 4)} FROM v ORDER BY v DESC, feature LIMIT 3"""


# ---- files and reports --------------------------------------------------------------

def csv_roundtrip(spark, sf_dir):
    """Customers written as delimited text and read back with a declared schema."""
    import uuid

    rows = table(spark, sf_dir, "customer")
    path = f"{scratch_root(spark).rstrip('/')}/segspark/{uuid.uuid4().hex}.csv"
    write_table(rows, path, "csv", bom=True)
    return read_delimited(spark, path, ",", rows.schema, "utf-8")


def csv_multiline_roundtrip(spark, sf_dir):
    """Documents, most of them of several lines, written as delimited text and read back in splits."""
    import uuid

    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    path = f"{scratch_root(spark).rstrip('/')}/segspark/{uuid.uuid4().hex}.csv"
    rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    back = read_delimited(spark, path, ",", rows.schema, "utf-8", multiline=True)
    return back.select("doc_id", "lang", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


csv_multiline_roundtrip_sql = "SELECT doc_id, lang, length(text) AS n_chars, md5(text) AS text_md5 FROM documents"


def table_report(spark, sf_dir):
    return d.table_report(table(spark, sf_dir, "orders"))


table_report_sql = "WITH n AS (SELECT count(*) AS n_rows FROM orders) SELECT position::INTEGER AS position, feature, type, n_rows FROM n, (VALUES " + ", ".join(
    f"({i}, '{name}', '{kind}')" for i, (name, kind) in enumerate([
        ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
        ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
    ])
) + ") v(position, feature, type)"


def select_by_cardinality(spark, sf_dir):
    """Counts of the values of those part columns that have at most 20 of them."""
    parts = table(spark, sf_dir, "part")
    few = t.columns_by_cardinality(parts, parts.columns, at_most=20)
    return d.value_counts(parts, few)


def _cardinality_sql():
    columns = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    return " UNION ALL ".join(
        f"SELECT '{x}' AS feature, CAST({x} AS VARCHAR) AS value, count(*) AS n FROM part "
        f"WHERE (SELECT count(DISTINCT {x}) FROM part) <= 20 GROUP BY 2"
        for x in columns
    )


QUERIES = {
    "describe_numeric": (describe_numeric, describe_numeric_sql),
    "custom_percentiles": (custom_percentiles, custom_percentiles_sql),
    "tail_count": (tail_count, tail_count_sql),
    "null_distinct_counts": (null_distinct_counts, null_distinct_counts_sql),
    "value_counts": (value_counts, value_counts_sql),
    "corr_matrix": (corr_matrix, _corr_sql()),
    "crosstab": (crosstab, crosstab_sql),
    "cramers_v": (cramers_v, _cramers_sql()),
    "histogram": (histogram, histogram_sql),
    "box_stats": (box_stats, _box_sql("items", ITEM, ITEMS_SQL)),
    "freq_box_stats": (freq_box_stats, freq_box_stats_sql),
    "kde_grid": (kde_grid, kde_grid_sql),
    "normal_fit": (normal_fit, normal_fit_sql),
    "cluster_profile_mean": (cluster_profile_mean, cluster_profile_mean_sql),
    "cluster_summary": (cluster_summary, cluster_summary_sql),
    "cluster_vs_overall": (cluster_vs_overall, cluster_vs_overall_sql),
    "cluster_mode": (cluster_mode, cluster_mode_sql),
    "profiling_wide": (profiling_wide, profiling_wide_sql),
    "distinctive_features": (distinctive_features, distinctive_features_sql),
    "variance_rank": (variance_rank, variance_rank_sql),
    "csv_roundtrip": (csv_roundtrip, "SELECT * FROM customer"),
    "csv_multiline_roundtrip": (csv_multiline_roundtrip, csv_multiline_roundtrip_sql),
    "table_report": (table_report, table_report_sql),
    "select_by_cardinality": (select_by_cardinality, _cardinality_sql()),
}

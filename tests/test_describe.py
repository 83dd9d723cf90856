import numpy as np
import pytest
from pyspark.sql import functions as F

from segspark.operators import describe as d
from segspark.operators import profiles as p
from segspark.operators import tables as t
from segspark.operators.quantiles import approximate_quantiles, exact_quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows hold one value, some are null, the rest is spread widely."""
    rng = np.random.default_rng(11)
    a = np.concatenate([np.full(3000, 7.0), rng.lognormal(3, 2, 2800), [np.nan] * 200])
    b = rng.integers(0, 5, 6000).astype(float)
    rng.shuffle(a)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    return a[~np.isnan(a)], b, t.nan_to_null(df)


PROBS = [0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]


@pytest.mark.parametrize("sketch", [10_000, 100, 12])
@pytest.mark.parametrize("parts", [1, 9])
def test_quantiles_are_exact_whatever_the_sketch(skewed, sketch, parts):
    a, b, df = skewed
    row = exact_quantiles(df.repartition(parts), ["a", "b"], PROBS, sketch).first()
    assert np.allclose(row["a"], np.quantile(a, PROBS), rtol=1e-9)
    assert np.allclose(row["b"], np.quantile(b, PROBS), rtol=1e-9)


@pytest.mark.parametrize("values", [
    [0.0, 1.0] * 10_000,
    [float(x % 11) for x in range(20_000)],
    [5.0] * 2000,
    [0.0] * 9999 + [1.0] + [0.0] * 5,
    [float(x) for x in range(1001)] + [float("inf"), float("-inf"), -0.0],
    [1.5, 2.5],
    [3.0],
])
def test_quantiles_end_on_ties_and_odd_sizes(spark, values):
    import pandas as pd

    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    probs = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.999, 1.0]
    finite = [p for p in probs if np.isfinite(np.quantile(values, p))]
    for sketch in (20, 10_000):
        got = exact_quantiles(df, ["x"], finite, sketch).first()["x"]
        assert np.allclose(got, np.quantile(values, finite), rtol=1e-12)


def test_ranks_of_one_interval_share_a_sketch(spark, monkeypatch):
    from segspark.operators import quantiles

    seen, sketched = [], F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda *a: seen.append(a) or sketched(*a))
    df = spark.createDataFrame([(float(i), float(-i)) for i in range(101)], "a double, b double")
    row = exact_quantiles(df, ["a", "b"], [0.01, 0.5, 0.99]).first()
    assert row["a"] == [1.0, 50.0, 99.0] and row["b"] == [-99.0, -50.0, -1.0]
    assert len(seen) == 2


def test_quantiles_with_nan_and_nulls(spark):
    rows = [(1.0, None), (2.0, None), (float("nan"), None), (None, None)]
    row = exact_quantiles(spark.createDataFrame(rows, "a double, b double"), ["a", "b"], [0.0, 0.5, 1.0], 5).first()
    assert row["a"][:2] == [1.0, 2.0] and np.isnan(row["a"][2]) and row["b"] is None


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)] * 30, "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5], 10).first()["a"] is None
    assert approximate_quantiles(df, ["b"], [0.5]).first()["b"] == [1.0]


def test_describe_and_counts(skewed):
    a, b, df = skewed
    rows = {r["feature"]: r for r in d.describe_numeric(df, ["a", "b"]).collect()}
    assert rows["a"]["count"] == len(a) and rows["a"]["std"] == pytest.approx(a.std(ddof=1))
    assert rows["a"]["p75"] == pytest.approx(np.quantile(a, 0.75))
    counts = {r["feature"]: r for r in d.null_distinct_counts(df, ["a", "b"]).collect()}
    assert counts["a"]["null_count"] == 200 and counts["b"]["distinct_count"] == 5
    with_null = d.value_counts(df, ["a"]).where("value IS NULL").first()
    assert with_null["n"] == 200
    assert d.value_counts(df, ["a"], with_null=False).where("value IS NULL").count() == 0
    tail = {r["feature"]: r["n_above"] for r in d.count_above_quantile(df, ["a"]).collect()}
    assert tail["a"] == (a > np.quantile(a, 0.99)).sum()


def test_box_and_histogram(skewed):
    a, _, df = skewed
    r = d.box_stats(df, ["a"]).first()
    q1, q3 = np.quantile(a, [0.25, 0.75])
    near = a[(a >= q1 - 1.5 * (q3 - q1)) & (a <= q3 + 1.5 * (q3 - q1))]
    assert (r["whisker_low"], r["whisker_high"], r["n_outliers"]) == (near.min(), near.max(), len(a) - len(near))
    bins = [x["n"] for x in d.histogram(df, "a", 20).orderBy("bin").collect()]
    assert bins == np.histogram(a, 20)[0].tolist()


def test_constant_column(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert [r["n"] for r in d.histogram(df, "x", 2).orderBy("bin").collect()] == [4, 0]
    assert d.describe_numeric(df, ["x"]).first()["std"] == 0.0
    fit = d.normal_fit(df, ["x"], 3, log=False).collect()
    assert fit[0]["std"] == 0.0 and fit[0]["density"] is None


def test_density_curve_integrates_to_one(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=800)
    curve = d.kde_curve(spark.createDataFrame([(float(v),) for v in x], "x double"), "x", 60).orderBy("point").collect()
    gx, gy = np.array([r["x"] for r in curve]), np.array([r["density"] for r in curve])
    h = x.std(ddof=1) * 800 ** -0.2
    want = np.exp(-0.5 * ((gx[:, None] - x) / h) ** 2).mean(1) / (h * np.sqrt(2 * np.pi))
    assert np.allclose(gy, want) and 0.97 < np.trapezoid(gy, gx) <= 1.0


def test_correlation_ignores_rows_with_a_null(spark):
    rows = [(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (None, 50.0), (4.0, None)]
    out = {(r["a"], r["b"]): r["r"] for r in d.correlation_matrix(spark.createDataFrame(rows, "x double, y double"), ["x", "y"]).collect()}
    assert out["x", "y"] == out["y", "x"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1])
    assert out["x", "x"] == pytest.approx(1.0)


def test_cramers_v(spark):
    # 2 x 2 with the continuity correction: |ad - bc| = 10 * 10 - 5 * 5 = 75 over n = 30
    rows = [("a", "p")] * 10 + [("a", "q")] * 5 + [("b", "p")] * 5 + [("b", "q")] * 10
    df = spark.createDataFrame(rows, "x string, y string").withColumn("one", F.lit("k"))
    out = {(r["a"], r["b"]): r["v"] for r in d.cramers_v(df, ["x", "y", "one"]).collect()}
    chi2 = 4 * (2.5 - 0.5) ** 2 / 7.5
    assert out["x", "y"] == out["y", "x"] == pytest.approx(np.sqrt(chi2 / 30))
    assert out["x", "one"] == 0.0 and len(out) == 9


def test_columns_by_type_and_cardinality(spark):
    df = spark.createDataFrame([(i, str(i % 3), float(i)) for i in range(30)], "a long, b string, c double")
    assert t.columns_by_type(df) == (["a", "c"], ["b"])
    assert t.columns_by_cardinality(df, ["a", "b"], at_most=20) == ["b"]
    assert t.columns_by_cardinality(df, ["a", "b"], more_than=20) == ["a"]
    assert t.columns_by_cardinality(df, ["a", "b"], at_most=5, approximate=True) == ["b"]


def test_profiles(spark):
    rows = [(0, 1.0, "b", None), (0, 3.0, "a", None), (1, 10.0, "c", "x"), (1, 10.0, None, "x"), (1, 10.0, None, "y")]
    df = spark.createDataFrame(rows, "cluster int, v double, k string, m string")
    modes = {(r["cluster"], r["feature"]): (r["mode"], r["mode_pct"]) for r in p.cluster_modes(df, ["k", "m"]).collect()}
    assert modes[0, "k"] == ("a", 50.0)  # a tie takes the smallest value
    assert (0, "m") not in modes and modes[1, "m"] == ("x", pytest.approx(200 / 3))
    assert modes[1, "k"] == ("c", pytest.approx(100 / 3))  # nulls count in the share only
    wide = {r["cluster"]: r for r in p.profile_table(df, ["v"], ["k", "m"]).collect()}
    assert wide[0]["size"] == 2 and wide[0]["v_mean"] == 2.0 and wide[0]["m_mode"] is None
    sizes = {r["cluster"]: r["percentage"] for r in p.cluster_sizes(df).collect()}
    assert sizes == {0: 40.0, 1: 60.0}
    gap = {r["cluster"]: r["direction"] for r in p.cluster_against_overall(df, ["v"]).collect()}
    assert gap == {0: "down", 1: "up"}
    zero = p.cluster_against_overall(df.withColumn("v", F.lit(0.0)), ["v"]).first()
    assert zero["diff_pct"] == 0.0 and zero["direction"] == "flat"


def test_report(spark):
    rows = d.table_report(spark.createDataFrame([(1, "a")], "x int, y string")).orderBy("position").collect()
    assert [(r["feature"], r["type"], r["n_rows"]) for r in rows] == [("x", "int", 1), ("y", "string", 1)]

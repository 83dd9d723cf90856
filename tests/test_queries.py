"""Every registered query at the smallest scale, beside its SQL where it has one."""

from datetime import datetime

import pytest

import __spark_entry__ as entry
from conformance import compare, oracle

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, capsys, name):
    """Equal to the SQL, and planned without a product of two tables."""
    df = QUERIES[name](spark, SF)
    df.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name in SQL:
        assert compare(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 3 and "size" in df.columns


def test_segments_cover_the_cleaned_integration(spark):
    """Segment sizes and means add up to those of the cleaned, integrated, featured respondents."""
    from segspark.queries import clusters, survey

    profile = entry.queries()["customer_segments"](spark, SF).toPandas()
    rows = survey.featured(spark, SF).toPandas()
    assert profile["size"].sum() == len(rows) and rows["ID"].is_unique
    for name in clusters.SEGMENT_NUMBERS:
        total = (profile["size"] * profile[f"{name}_mean"]).sum()
        assert total == pytest.approx(rows[name].astype(float).sum(), rel=1e-4, abs=1e-2)
    for name in clusters.SEGMENT_MODES:
        assert set(profile[f"{name}_mode"]) <= set(rows[name])


def test_respondent_tables_come_from_the_lines_without_shuffle(spark, tmp_path, capsys):
    """The joined lines lie by ID already; the tables grouped by respondent are not shuffled again."""
    from segspark.queries import standins as s
    from segspark.session import materialize_bucketed

    def put(name, schema, *rows):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))

    put("nation", "n_nationkey long, n_name string", (1, "Here"))
    put("customer", "c_custkey long, c_nationkey long, c_acctbal double, c_mktsegment string",
        (1, 1, 5.0, "BUILDING"), (2, 1, 900.0, "OTHER"), (None, 1, 1.0, "OTHER"))
    put("part", "p_partkey long, p_brand string, p_type string", (1, "Brand#1", "PROMO"), (2, "Brand#2", "LARGE"))
    put("orders", "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string",
        (1, 1, "F", datetime(1997, 12, 1), "1-URGENT"), (2, 1, "O", datetime(1998, 3, 1), "5-LOW"),
        (3, 2, "F", datetime(1998, 1, 1), "5-LOW"), (4, None, "F", datetime(1998, 1, 1), "5-LOW"))
    put("lineitem", "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_returnflag string, l_linestatus string",
        *[(o, p, p, 45.0 * p, 10.0, "A", "O") for o in (1, 2, 3, 4) for p in (1, 2)], (2, 1, 3, 1.0, 1.0, "R", "F"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = s.lines(spark, str(tmp_path))
        rows = materialize_bucketed(joined, "ID", ["Year"])
        assert sorted(rows.groupBy("ID", "Year").count().collect()) == [("1", 1997, 2), ("1", 1998, 3), ("2", 1998, 2)]
        shuffles = []
        for table in (joined, joined.groupBy("ID").count()):
            capsys.readouterr()
            table.explain()
            shuffles.append(capsys.readouterr().out.count("Exchange hashpartitioning"))
        assert shuffles[0] == shuffles[1] > 0
        for table in (s.demographics(rows), s.brandhealth(rows).dropDuplicates(), s.needstates(rows).dropDuplicates()):
            table.explain()
            assert "Exchange" not in capsys.readouterr().out
        demographics = {(r["ID"], r["Year"]): r for r in s.demographics(rows).collect()}
        assert demographics["1", 1998]["BUMO_Previous"] == "Brand#1" and demographics["1", 1998]["Group_size"] == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_sql_without_query():
    assert set(SQL) <= set(QUERIES)

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segspark.session import materialize, materialize_bucketed, scratch_root
from segspark.sources import files


def write(folder, name, body, encoding="utf-8"):
    (folder / name).write_bytes(body.encode(encoding))
    return str(folder / name)


def test_read_with_separator_and_encodings(spark, tmp_path):
    a = write(tmp_path, "a.csv", "ID;name\n1;Trà\n2;\n")
    b = write(tmp_path, "b.csv", "ID;name\n1;Caf\xe9\n", "latin-1")
    assert files.text_encoding(spark, a) == "utf-8" and files.text_encoding(spark, b) == "iso-8859-1"
    assert [tuple(r) for r in files.read_delimited(spark, a).collect()] == [(1, "Trà"), (2, None)]
    assert files.read_delimited(spark, b, schema="ID long, name string").first()["name"] == "Café"


def test_nan_text_becomes_null(spark, tmp_path):
    a = write(tmp_path, "a.csv", "x,y\n1.5,a\nNaN,b\n")
    assert [r["x"] for r in files.read_delimited(spark, a, ",").collect()] == [1.5, None]


def test_catalog_and_its_errors(spark, tmp_path):
    for spec in files.RAW_CATALOG.values():
        write(tmp_path, spec.file, spec.sep.join(["ID", "v"]) + "\n" + spec.sep.join(["1", "x"]) + "\n")
    tables = files.load_catalog(spark, str(tmp_path), files.RAW_CATALOG)
    assert set(tables) == {"sa_var", "needstate", "brandhealth", "brand_image", "segmentation"}
    assert all(df.columns == ["ID", "v"] for df in tables.values())
    with pytest.raises(FileNotFoundError, match="gone.csv"):
        files.load_catalog(spark, str(tmp_path), {"t": files.TableSpec("gone.csv")})
    with pytest.raises(ValueError, match="City"):
        files.load_catalog(spark, str(tmp_path), {"t": files.TableSpec("SA#var.csv", ";", None, ("City",))})


def test_directory_scan_detects_separators_and_skips_bad_lines(spark, tmp_path):
    write(tmp_path, "comma.csv", 'a,b\n1,"x,y"\n2,z,extra\n3\n4,w\n')
    write(tmp_path, "semi.csv", "a;b;c\n1;2,5;3\n")
    write(tmp_path, "tab.csv", "a\tb\n1\tCaf\xe9\n", "latin-1")
    write(tmp_path, "other.txt", "a,b\n")
    found = files.load_directory(spark, str(tmp_path))
    assert set(found) == {"comma.csv", "semi.csv", "tab.csv"}
    assert [tuple(r) for r in found["comma.csv"].collect()] == [(1, "x,y"), (3, None), (4, "w")]
    assert found["semi.csv"].columns == ["a", "b", "c"] and found["tab.csv"].first()["b"] == "Café"


def test_write_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", ok'), (2, None)], "ID long, t string")
    files.write_table(df, str(tmp_path / "c"), "csv", bom=True)
    part = next((tmp_path / "c").glob("part-*.csv")).read_bytes()
    assert part.startswith(b"\xef\xbb\xbf")
    back = files.read_delimited(spark, str(tmp_path / "c"), ",", df.schema)
    assert sorted(tuple(r) for r in back.collect()) == [(1, 'say "hi", ok'), (2, None)]
    files.write_table(df, str(tmp_path / "p"))
    files.write_table(df.limit(1), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1
    with pytest.raises(ValueError):
        files.write_table(df, str(tmp_path / "x"), "xml")


def test_cleaned_tables_under_their_names(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "ID long, v string")
    files.write_cleaned(dict.fromkeys(files.CLEANED_CATALOG, df), str(tmp_path))
    tables = files.load_catalog(spark, str(tmp_path), files.CLEANED_CATALOG)
    assert {n: x.count() for n, x in tables.items()} == dict.fromkeys(files.CLEANED_CATALOG, 1)


def test_labelled_table(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5), (2, 0.7)], "ID long, f double")
    files.write_labelled(df, df.select("ID", F.col("ID").alias("cluster")), "ID", str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "l")).columns == ["ID", "f", "cluster"]


def test_materialized_table_has_no_history(spark):
    df = materialize(spark.range(10).withColumn("r", F.rand()))
    assert df.collect() == df.collect()
    assert scratch_root(spark) in df.inputFiles()[0]


def test_bucketed_table_needs_no_shuffle_by_its_key(spark, capsys):
    """Same rows (null keys and copies too), no shuffle for the write or after it, nothing left in the catalog."""
    rows = [(None if i % 9 == 0 else f"k{i % 7}", i % 3, i // 2) for i in range(60)]
    df = spark.createDataFrame(rows + rows[:5], "ID string, Year int, v int")
    written = materialize_bucketed(df, "ID", ["Year"])
    assert sorted(written.collect(), key=str) == sorted(df.collect(), key=str)
    assert spark.catalog.listTables() == [] and scratch_root(spark) in written.inputFiles()[0]
    counted = written.groupBy("ID", "Year").agg(F.sum("v").alias("v"))
    previous = counted.withColumn("p", F.lag("v").over(W.partitionBy("ID").orderBy("Year")))
    again = materialize_bucketed(previous, "ID")
    both = previous.join(again.groupBy("ID").agg(F.max("v").alias("most")), "ID", "left")
    for table in (previous, both):
        capsys.readouterr()
        table.explain()
        assert "Exchange hashpartitioning" not in capsys.readouterr().out
    assert materialize_bucketed(df.where("v < 0"), "ID").count() == 0


def test_quoted_newlines_stay_in_their_record(spark, tmp_path):
    path = tmp_path / "notes.csv"
    path.write_text('id;note;x\n1;"first\nsecond; ""third""";a\n2;plain;b\n', encoding="utf-8")
    rows = [tuple(r) for r in files.read_delimited(spark, str(path), ";").collect()]
    assert rows == [(1, 'first\nsecond; "third"', "a"), (2, "plain", "b")]
    loaded = files.load_directory(spark, str(tmp_path))["notes.csv"]
    assert [tuple(r) for r in loaded.collect()] == rows


def test_the_separator_is_chosen_over_all_lines(spark, tmp_path):
    path = tmp_path / "late.csv"
    body = ["a;b,c"] + ["1;2,3"] * 30 + [f"{i};x" for i in range(100)]
    path.write_text("\n".join(body), encoding="utf-8")
    assert files.sniff_delimiter(spark, str(path)) == ";"

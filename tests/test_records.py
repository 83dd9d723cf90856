"""Records over several lines, read in splits, against the one-task reader and Python's csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from segspark.sources import files, records


@pytest.fixture
def split_bytes(spark, monkeypatch):
    """Sets how many bytes a split of the text scan holds; only that scan is cut so small."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    write, size, seen = records.materialize, [], []

    def cut_small(df):
        if "inside" not in df.columns or not size:
            return write(df)
        spark.conf.set(names[0], str(size[-1]))
        spark.conf.set(names[1], "0")
        try:
            lines = write(df)
        finally:
            for n, v in before.items():
                spark.conf.set(n, v)
        seen.append(lines.select("file", "split").distinct().count())
        return lines

    monkeypatch.setattr(records, "materialize", cut_small)

    def limit(n):
        size.append(n)
        return seen

    return limit


def one_task(spark, path, schema, sep=","):
    return (
        spark.read.option("sep", sep).option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", True).schema(schema).csv(path)
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCHEMA = "id long, note string, x string"
BODY = 'id,note,x\n1,"first\nsecond, ""third""",a\n2,plain,b\n3,"""\n""",c\n4,"a\n\n\nb",\n5,,"é\n,"\n'


@pytest.mark.parametrize("size", [6, 11, 23, 1000])
def test_any_split_size_gives_the_same_records(spark, tmp_path, split_bytes, size):
    path = str(tmp_path / "t.csv")
    (tmp_path / "t.csv").write_text(BODY, encoding="utf-8", newline="")
    wanted = rows(one_task(spark, path, SCHEMA))
    split_bytes(size)
    assert rows(records.read_records(spark, path, ",", SCHEMA)) == wanted
    assert wanted[0] == (1, 'first\nsecond, "third"', "a") and len(wanted) == 5


def test_random_tables_in_several_tasks(spark, tmp_path, split_bytes):
    rng = random.Random(5)
    pieces = ["a", '"', "\n", ",", " b", "", "\n\n", '""', "c,\nd"]
    for turn in range(2):
        made = [(i, "x" + "".join(rng.choices(pieces, k=rng.randint(0, 6))) + "x") for i in range(150)]
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\r\n" if turn % 2 else "\n")
        writer.writerow(["id", "t"])
        writer.writerows(made)
        path = tmp_path / f"r{turn}.csv"
        path.write_bytes(out.getvalue().encode())
        seen = split_bytes(211 + 40 * turn)
        assert sorted(tuple(r) for r in records.read_records(spark, str(path), ",", "id long, t string").collect()) == made
        assert seen[-1] > 5


def test_one_record_over_many_splits(spark, tmp_path, split_bytes):
    text = "\n".join(f"line {i}" for i in range(120))
    path = tmp_path / "long.csv"
    path.write_text(f'id,t\n1,"{text}"\n2,end\n', newline="")
    split_bytes(128)
    assert rows(records.read_records(spark, str(path), ",", "id long, t string")) == [(1, text), (2, "end")]


def test_folder_with_a_header_per_file_and_odd_files(spark, tmp_path, split_bytes):
    (tmp_path / "a.csv").write_text('\n\nid,t\n1,"x\ny"\n\n2,"  "\n')
    (tmp_path / "b.csv").write_text("id,t\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text('id,t\n3,z,surplus\n4\n5,"never\nclosed')
    split_bytes(12)
    got = rows(records.read_records(spark, str(tmp_path), ",", "id long, t string"))
    assert got == [(1, "x\ny"), (2, "  "), (3, "z"), (4, None), (5, "never\nclosed")]
    tolerant = records.read_records(spark, str(tmp_path), ",", None, surplus=lambda r: files._fields(r, ","))
    assert {r["id"] for r in tolerant.collect()} == {1, 2, 4, 5}
    with pytest.raises(ValueError, match="empty"):
        records.read_records(spark, str(tmp_path / "c.csv"), ",")


def test_types_are_found_over_all_records(spark, tmp_path):
    path = tmp_path / "t.csv"
    body = (
        '﻿"a",b,c,d,e,f,g,,a\n1,5000000000,1.5,2020-01-31,2020-01-31 10:00:00,true,"x\n",,1\n'
        '-2,1,NaN,2020-02-01,2020-02-01,False,7,,\n'
    )
    path.write_text(body, encoding="utf-8")
    df = records.read_records(spark, str(path), ",")
    assert df.columns == ["a0", "b", "c", "d", "e", "f", "g", "_c7", "a8"]
    assert [t for _, t in df.dtypes] == ["int", "bigint", "double", "date", "timestamp", "boolean", "string", "string", "int"]
    assert df.dtypes == [(n, t) for n, t in one_task_inferred(spark, str(path)).dtypes]


def one_task_inferred(spark, path):
    return (
        spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
        .option("inferSchema", True).csv(path)
    )


def test_latin_text_and_the_delimited_reader(spark, tmp_path, split_bytes):
    path = tmp_path / "l.csv"
    path.write_bytes('id;t\n1;"Caf\xe9\nÜ"\n'.encode("latin-1"))
    split_bytes(4)
    assert [tuple(r) for r in files.read_delimited(spark, str(path)).collect()] == [(1, "Caf\xe9\nÜ")]


def test_records_are_read_by_many_tasks(spark, tmp_path, split_bytes):
    path = tmp_path / "t.csv"
    path.write_text("id,t\n" + "".join(f'{i},"a\nb"\n' for i in range(2000)))
    seen = split_bytes(4000)
    df = records.read_records(spark, str(path), ",", "id long, t string")
    assert df.count() == 2000 and df.agg(F.sum("id")).first()[0] == 1999 * 1000
    assert seen[-1] > 4

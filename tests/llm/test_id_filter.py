from segspark.llm import id_filter
from segspark.llm.id_filter import split_by_bitmap


def test_no_id_is_lost_and_most_others_pass(spark, monkeypatch):
    monkeypatch.setattr(id_filter, "BITS", 1 << 12)
    rows = spark.createDataFrame([(i, "x") for i in range(1000)] + [(None, "x"), (5, "x")], "row_id long, other string")
    ids = spark.createDataFrame([(i,) for i in range(0, 1000, 25)] + [(None,)], "gone long")
    sure, unsure = split_by_bitmap(rows, "row_id", ids)
    assert sure.columns == unsure.columns == rows.columns
    passed = [r["row_id"] for r in sure.collect()]
    held = [r["row_id"] for r in unsure.collect()]
    assert len(passed) + len(held) == rows.count()
    assert {None, *range(0, 1000, 25)} <= set(held) and len(passed) > 900


def test_empty_sides(spark):
    rows = spark.createDataFrame([(1,)], "row_id long")
    none = spark.createDataFrame([], "gone long")
    sure, unsure = split_by_bitmap(rows, "row_id", none)
    assert sure.count() == 1 and unsure.isEmpty()
    assert all(x.isEmpty() for x in split_by_bitmap(rows.limit(0), "row_id", rows))

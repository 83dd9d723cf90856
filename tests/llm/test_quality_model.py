import numpy as np
import pyarrow as pa
from odd import ODD_IDS, TEXTS, ids, odd_documents
from pyspark.sql import functions as F

from segspark.llm.quality_model import STATISTICS, fit, grow, score, statistics
from segspark.llm.queries import op5_quality
from segspark.llm.text_arrays import slices

SF = "/root/testdata/sf0.01"


def walk(forest, row):
    """One row through every tree, node by node."""
    total = forest.intercept
    for at in forest.roots:
        while forest.left[at] != at:
            at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
        total += forest.value[at]
    return total


def test_flat_traversal_and_fit():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 6)).astype(np.float32)
    x[:, 5] = 1.0  # a constant
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = grow(x[:1000], y[:1000], trees=40)
    assert np.allclose(forest.raw(x[:50]), [walk(forest, r) for r in x[:50]])
    assert ((forest.probability(x[1000:]) >= 0.5) == y[1000:]).mean() > 0.95


def test_statistics_do_not_depend_on_slices():
    texts = pa.array([*TEXTS, "A b!! C\nA b!! C\nx", "THE!! END!!", "word### other$$$"])
    one = np.concatenate([statistics(p) for p in slices(texts)])
    many = np.concatenate([statistics(p) for p in slices(texts, 1)])
    assert one.shape == (len(texts), len(STATISTICS)) and np.allclose(one, many, atol=1e-6) and np.isfinite(one).all()
    at = {k: one[:, i] for i, k in enumerate(STATISTICS)}
    assert at["dup_lines"][9] == np.float32(1 / 3) and at["shouted_words"][10] == 1 and at["odd_ended_words"][11] == 1
    assert (one[:2] == 0).all()


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    out = op5_quality(spark, SF)
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = out.filter("held_out").join(labels, "doc_id")
    right, total = held.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int")), F.count("*")).first()
    assert total > 100 and right > 0.95


def test_odd_rows(spark):
    df = odd_documents(spark)
    assert {r["score"] for r in score(df, fit(df, df.withColumn("quality", F.lit(None).cast("int")))).collect()} == {0.5}
    assert {round(r["score"], 6) for r in score(df, fit(df, df.withColumn("quality", F.lit(0)))).collect()} == {0.0}
    both = fit(df, df.withColumn("quality", (F.coalesce("doc_id", F.lit(0)) % 2).cast("int")))
    out = score(df, both)
    assert ids(out) == ODD_IDS and out.filter("score IS NULL OR score < 0 OR score > 1").isEmpty()
    assert score(df.limit(0), both).isEmpty()
    assert fit(df.limit(0), df.withColumn("quality", F.lit(1))).intercept == 0.0

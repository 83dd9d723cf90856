import zlib

import numpy as np
import pytest
from odd import ODD_IDS, ids, odd_documents
from pyspark.sql import functions as F

from segspark.llm.language import LanguageModel, count_grams, fit, fold, grams, identify
from segspark.llm.queries import op9_language

SF = "/root/testdata/sf0.01"


def test_fold_is_crc32_of_the_text_of_the_id(spark):
    for r in spark.range(50).select("id", fold(F.col("id"), 3).alias("f")).collect():
        assert r["f"] == zlib.crc32(str(r["id"]).encode()) % 3


def test_grams_are_those_of_words():
    texts = ["Ab, cdé 1x", "", "..", "zz"]
    hashes, owner, letters = grams(texts, (3,))
    windows = {0: ["^ab", "ab^", "^cd", "cdé", "dé^", "^x^"], 3: ["^zz", "zz^"]}
    assert letters.tolist() == [6, 0, 0, 2]
    assert [owner.tolist().count(i) for i in range(4)] == [len(windows[0]), 0, 0, 2]
    again, _, _ = grams(["CDÉ"], (3,))
    assert len(set(again.tolist()) & set(hashes.tolist())) == 3


def test_counts_equal_one_task(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).select("lang", "text")
    rows = docs.collect()
    got = {(r["lang"], r["gram"]): r["n"] for r in count_grams(docs.repartition(5), "lang", "text").collect()}
    want: dict = {}
    for r in rows:
        for g in grams([r["text"] or ""])[0].view(np.int64).tolist():
            want[r["lang"], g] = want.get((r["lang"], g), 0) + 1
    assert got == want


def test_false_positives_are_corrected():
    rng = np.random.default_rng(0)
    slots = np.zeros((1024, 1), np.uint8)
    slots[rng.choice(1024, 512, replace=False), 0] |= 1
    model = LanguageModel(["a", "b"], 0, slots, np.array([0.125, 0.0]))
    votes, _ = model.votes(["".join(chr(97 + i) for i in rng.integers(0, 26, 20_000))])
    assert votes[0, 0] < 0.02 * 40_000  # chance hits are not votes


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    out = op9_language(spark, SF)
    assert out.count() == docs.count()
    held = out.filter("held_out").join(docs, "doc_id")
    right, total = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 200 and right > 0.98


def test_odd_rows(spark):
    df = odd_documents(spark)
    learning = spark.createDataFrame([("abc abd abe " * 9, "xx"), ("pqr pqs " * 9, "yy"), (None, "yy"), ("abc", None)], "text string, lang string")
    model = fit(learning)
    assert model.languages == ["xx", "yy"] and model.usual == 1
    out = identify(df, model)
    assert ids(out) == ODD_IDS
    by = {r["doc_id"]: r for r in out.collect()}
    for i in (0, 1, 2):
        assert (by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0)
    assert by[8]["lang_pred"] == "yy" and all(0 <= r["score"] <= 1 for r in by.values())
    nothing = fit(learning.limit(0))
    assert {r["lang_pred"] for r in identify(df, nothing).collect()} == {"und"}
    assert identify(df.limit(0), model).isEmpty()


@pytest.mark.parametrize("n", [1, 9, 17])
def test_more_languages_than_a_byte_has_bits(spark, n):
    words = ["".join(chr(97 + (i * 7 + j * 3) % 26) for j in range(6)) for i in range(n)]
    model = fit(spark.createDataFrame([(" ".join([w] * 20), f"l{i:02d}") for i, w in enumerate(words)], "text string, lang string"))
    got = identify(spark.createDataFrame(list(enumerate(words)), "doc_id long, text string"), model)
    assert {r["doc_id"]: r["lang_pred"] for r in got.collect()} == {i: f"l{i:02d}" for i in range(n)}

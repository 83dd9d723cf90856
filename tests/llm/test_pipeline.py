import re

import corpus_pipeline
import public_tokenizers as P
import pytest
from test_exact_dedup import digest
from test_near_dedup import brute as near_groups
from test_repetition import brute as repetition_counts
from test_secret_scan import base
from tokenizers import Tokenizer

from segspark.llm.repetition import RepetitionRules
from segspark.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's rows, the documents first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF))
        out.append(docs)
    return [x.toPandas() for x in out]


def rejected(text):
    rules = RepetitionRules()
    c = repetition_counts(text, rules)
    bad = c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]
    bad |= 100 * c["n_dup_lines"] > rules.line_percent * c["n_lines"] or 100 * c["dup_line_chars"] > rules.line_char_percent * c["word_chars"]
    return bad or any(100 * c[f"dup_chars_{n}"] > x * c["word_chars"] for n, x in rules.ngram_percent.items())


def test_stages_equal_brute_force(stages):
    docs, ruled, exact, near, clean, packed = stages
    for table in stages[:-1]:
        assert list(table.columns) == list(docs.columns)
    want = docs[~docs.text.map(rejected)]
    assert set(ruled.doc_id) == set(want.doc_id) and len(ruled) == len(want)

    best = want.assign(d=want.text.map(digest), size=-want.text.str.len()).sort_values(["size", "doc_id"]).groupby("d").doc_id.first()
    assert set(exact.doc_id) == set(best) and len(exact) == len(best)

    groups = near_groups(list(zip(exact.doc_id, exact.text, strict=True)), 5)
    assert set(near.doc_id) == {g for _, g in groups.values()} and len(near) == near.doc_id.nunique()

    assert set(clean.doc_id) == set(near.doc_id)
    before, after = near.set_index("doc_id"), clean.set_index("doc_id")
    for i in before.index:
        spans = base(before.text[i])
        assert bool(spans) <= ("[SECRET]" in after.text[i]) and not base(after.text[i])
        kept = re.split(r"\[SECRET\]", after.text[i])
        assert all(part in before.text[i] for part in kept) and after.n_chars[i] == len(after.text[i])

    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for i, g in packed.sort_values("start").groupby("doc_id"):
        assert [x for part in g.ids for x in part] == tokenizer.encode(after.text[i], add_special_tokens=False).ids + [1]
    assert set(packed.doc_id) == set(clean.doc_id)


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").toPandas()
    want = stages[-1][["doc_id", "start", "length", "ids_crc32"]]
    # Where documents lie decides how they are cut; what they hold does not change.
    assert got.groupby("doc_id").length.sum().to_dict() == want.groupby("doc_id").length.sum().to_dict()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.isEmpty()

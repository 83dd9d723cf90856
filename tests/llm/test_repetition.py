import random
import re
from collections import Counter

import pyarrow as pa
from odd import CLASHING, ODD_IDS, ids, odd_documents
from pyspark.sql import functions as F

from segspark.llm.repetition import RepetitionRules, measure, repetition_filter, repetition_statistics
from segspark.llm.text_arrays import slices

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text, rules):
    text = text or ""
    w = WORD.findall(text)
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in rules.symbols for c in text)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    out |= {"n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines))}
    chars = lambda x: sum(map(len, WORD.findall(x)))
    out["dup_line_chars"] = sum((c - 1) * chars(x) for x, c in Counter(lines).items())
    for n in {*rules.ngram_percent, rules.window}:
        grams = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        times = Counter(grams)
        inside = {i + j for i, g in enumerate(grams) if times[g] > 1 for j in range(n)}
        if n == rules.window:
            out["n_repeat_words"] = len(inside)
        if n in rules.ngram_percent:
            out[f"dup_chars_{n}"] = sum(len(w[i]) for i in inside)
    return out


def test_counts_equal_brute_force():
    random.seed(3)
    pieces = ["a", "bb", "é", "日本", " ", "  ", "\n", "\t", "#", "a bb c dd e ff g hh i\n", "\x0b", "\x1c"]
    texts = ["".join(random.choices(pieces, k=random.randint(0, 120))) for _ in range(300)] + ["", None, "\n", " "]
    for rules in (RepetitionRules(), RepetitionRules(ngram_percent={2: 10, 4: 10}, window=3)):
        for limit in (1, 300, 1 << 20):
            got = [(part.first, len(part), measure(part, rules)) for part in slices(pa.array(texts), limit)]
            for first, n, counts in got:
                for i in range(n):
                    assert {k: int(v[i]) for k, v in counts.items()} == brute(texts[first + i], rules)
            assert sum(n for _, n, _ in got) == len(texts)


def test_odd_rows(spark):
    df = odd_documents(spark)
    out = repetition_statistics(df)
    assert ids(out) == ODD_IDS
    assert out.filter("n_words = 0 AND NOT base_failed").isEmpty()
    assert out.filter("doc_id = 5").first()["base_failed"]
    assert repetition_statistics(df.limit(0)).isEmpty()
    assert repetition_filter(df).isEmpty()
    assert repetition_filter(df, rules=RepetitionRules(least_words=1, window_percent=100, ngram_percent={}, line_percent=100)).columns == df.columns


def test_filter_keeps_what_the_verdict_keeps(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn(CLASHING[0], F.lit(1))
    kept = ids(repetition_statistics(docs).filter("kept"))
    assert ids(repetition_filter(docs)) == kept and 0 < len(kept) < docs.count()

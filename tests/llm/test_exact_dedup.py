import hashlib
import random
import re
from collections import Counter, defaultdict

from odd import ODD_IDS, ids, odd_documents

from segspark.llm.exact_dedup import drop_exact_duplicates, exact_duplicates, heavy_candidates, misra_gries


def digest(text):
    return hashlib.sha256(re.sub("[ \t-\r]", "", text or "").encode()).hexdigest()


def corpus(spark, n=600):
    random.seed(6)
    texts = ["the hot text"] * (n // 3) + [f"text {random.randint(0, 80)}" for _ in range(n - n // 3)]
    rows = [(i, t.replace(" ", random.choice([" ", "  ", "\n"])), "x") for i, t in enumerate(texts)]
    random.shuffle(rows)
    return rows, spark.createDataFrame(rows, "doc_id long, text string, digest string").repartition(7)


def test_misra_gries_finds_every_frequent_value(spark):
    rows, df = corpus(spark)
    times = Counter(digest(t) for _, t, _ in rows)
    digests = spark.createDataFrame([(digest(t),) for _, t, _ in rows], "d string").repartition(5)
    summary = misra_gries(digests, "d", 4).collect()
    assert len(summary) <= 5 * 4
    low = Counter()
    for r in summary:
        low[r["d"]] += r["counter"]
    assert all(times[d] - len(rows) / 5 <= c <= times[d] for d, c in low.items())
    for share, counters in ((0.3, 4), (0.01, 200)):
        found = {r["d"] for r in heavy_candidates(digests, "d", len(rows), share, counters).collect()}
        assert {d for d, c in times.items() if c > share * len(rows)} <= found
        assert len(found) <= 1 / (share - 1 / (counters + 1))


def expected(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[digest(t)].append((-len(t or ""), i is None, i))
    return {(i, digest(t)): (min(groups[digest(t)])[2], len(groups[digest(t)])) for i, t, *_ in rows}


def test_equal_to_brute_force_for_any_split(spark):
    rows, df = corpus(spark)
    want = expected(rows)
    for share, counters in ((1 / 256, 511), (0.2, 10), (0.9, 2)):
        for r in exact_duplicates(df, share=share, counters=counters).collect():
            keep, size = want[r["doc_id"], r["text_sha256"]]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, size, keep == r["doc_id"])


def test_odd_rows(spark):
    df = odd_documents(spark)
    out = exact_duplicates(df).collect()
    assert sorted((r["doc_id"] for r in out), key=lambda x: (x is None, x)) == ODD_IDS
    by = defaultdict(list)
    for r in out:
        by[r["text_sha256"]].append(r)
    assert all(sum(r["kept"] for r in g) == 1 and all(r["group_size"] == len(g) for r in g) for g in by.values())
    empties = by[digest("")]
    assert {r["doc_id"] for r in empties} == {0, 1, 2, None} and all(r["keep_id"] == 2 for r in empties)  # the longest original
    kept = drop_exact_duplicates(df)
    assert kept.columns == df.columns and kept.count() == len(by)
    assert ids(kept) == [2, 3, 4, 5, 6, 8, None]
    assert exact_duplicates(df.limit(0)).isEmpty() and drop_exact_duplicates(df.limit(0)).isEmpty()


def test_repeated_rows_with_null_text_keep_their_columns(spark):
    rows = [(1, None, "x"), (1, None, "x"), (2, "some text", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    assert sorted(tuple(r) for r in drop_exact_duplicates(df).collect()) == [(1, None, "x"), (2, "some text", "y")]

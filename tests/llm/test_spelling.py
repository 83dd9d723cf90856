import random
import re
import zlib
from collections import Counter

import pytest
from odd import odd_documents

from segspark.llm.spelling import enumerated, near_vectors, near_words, respell, roots, variants, word_counts

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute_counts(rows, least_length=6, least_count=5, every=199):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if every and h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            n[word] += 1
    return {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}


def apart_by_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n):
    near = {w: [v for v in n if apart_by_one(w, v)] for w in n}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda v: (-n[v], v))
            if n[best] >= 5 * n[w]:
                form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def misspelled(seed=5, words=60, docs=250):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéñü") for _ in range(rng.randint(6, 9))) for _ in range(words)]

    def spoiled(w):
        for _ in range(rng.choice([0] * 6 + [1, 1, 2])):
            at, kind = rng.randrange(len(w)), rng.randrange(4)
            w = {0: w[:at] + w[at + 1 :], 1: w[:at] + rng.choice("abcé") + w[at:], 2: w[:at] + rng.choice("abcé") + w[at + 1 :], 3: "".join(sorted(w))}[kind]
        return w.upper() if rng.random() < 0.1 else w

    return [(i if i % 50 else None, rng.choice([" ", "-", "7"]).join(spoiled(rng.choice(base[: 1 + i % words])) for _ in range(60))) for i in range(docs)]


def test_equal_to_brute_force(spark):
    rows = misspelled()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for every in (199, 7):
        counts = brute_counts(rows, every=every)
        words = word_counts(df, least_length=6, least_count=5, drop_every=every)
        assert {r["word"]: r["n"] for r in words.collect()} == counts
        got = {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in variants(words).collect()}
        assert got == brute_variants(counts)
        assert any(f for _, f, *_ in got)


def test_no_near_pair_of_vectors_is_missed(spark):
    rng = random.Random(2)
    vectors = sorted({"".join(sorted(rng.choice("abcdefg") for _ in range(rng.randint(1, 7)))) for _ in range(400)})

    def distance(a, b):
        return sum((Counter(a) - Counter(b)).values()) + sum((Counter(b) - Counter(a)).values())

    want = {frozenset((a, b)) for a in vectors for b in vectors if a < b and distance(a, b) <= 2 and (len(a) != len(b) or distance(a, b) == 2) and abs(len(a) - len(b)) <= 1}
    got = [frozenset((r["a"], r["b"])) for r in near_vectors(spark.createDataFrame([(v,) for v in vectors], "v string")).collect()]
    assert want <= set(got) and len(got) == len(set(got))


@pytest.mark.parametrize(("k", "n1", "n2"), [(2, 1, 6), (2, 2, 3), (2, 3, 1), (1, 1, 4), (1, 2, 1)])
def test_signatures_meet_within_distance(k, n1, n2):
    chosen = enumerated(k, n1, n2)
    rng = random.Random(1)
    for _ in range(200):
        touched = {rng.randrange(n1 * n2) for _ in range(k)}  # parts that differ
        assert any(not touched & set(kept) for kept in chosen)


def test_a_hub_word_keeps_all_its_neighbours(spark):
    hub = "abcdefgh"
    words = sorted({hub} | {hub[:i] + c + hub[i + 1 :] for i in range(8) for c in "klmnopqrst"} | {hub[:i] + hub[i + 1 :] for i in range(8)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = near_words(df).collect()
    assert sum(r["word"] == hub for r in got) == len(words) - 1
    assert {(r["word"], r["near"]) for r in got} == {(a, b) for a in words for b in words if apart_by_one(a, b)}


def test_chains_end_at_their_last_form(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(9)] + [("x", "w3")]
    got = {r["word"]: r["root"] for r in roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {w: "w9" for w, _ in links}


def test_odd_rows(spark):
    df = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    words = word_counts(df)
    assert {r["word"]: r["n"] for r in words.collect()} == brute_counts(rows, 1, 1, 0)
    got = {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in variants(words).collect()}
    assert got == brute_variants(brute_counts(rows, 1, 1, 0))
    assert variants(word_counts(df.limit(0))).isEmpty()
    ab = "ab" * 60_000
    long_word = spark.createDataFrame([(1, f"{ab} {ab}c c{ab} {ab[:-1]}d {ab[:-2]}dd")], "doc_id long, text string")
    got = variants(word_counts(long_word, least_length=6)).collect()
    assert {r["word"].replace(ab[:-2], "~"): r["n_near"] for r in got} == {"~ab": 3, "~abc": 1, "c~ab": 1, "~ad": 2, "~dd": 1}


def test_respelled_texts(spark):
    df = spark.createDataFrame([(1, "A colour, a Colr!"), (2, None), (3, "colr colr")], "doc_id long, text string")
    found = spark.createDataFrame([("colr", "colour"), ("colour", "colour")], "word string, root string")
    got = {r["doc_id"]: r["text"] for r in respell(df, found).collect()}
    assert got == {1: "A colour, a colour!", 2: None, 3: "colour colour"}

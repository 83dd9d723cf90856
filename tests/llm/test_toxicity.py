import random

import pytest
from odd import ODD_IDS, ids, odd_documents
from pyspark.sql import functions as F

from segspark.llm.queries import op10_toxicity
from segspark.llm.toxicity import (
    LetterModel, Lookup, ToxicityModel, count_letter_pairs, decode, fit, restore, score, scores, spaced_features, spaced_readings, tokens, word_features,
)

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def letters(spark):
    text = "an idiot and a moron told a stupid loser that trash is worthless and pathetic scum is disgusting clown letter coffee "
    return LetterModel.of(*count_letter_pairs(spark.createDataFrame([(text * 50,)], "text string")))


def test_letter_pairs_equal_brute_force(spark):
    got = count_letter_pairs(spark.createDataFrame([("Ab ab!",), (None,), ("b",)], "text string"))
    assert got == ({("", "a"): 2, ("a", "b"): 2, ("b", ""): 3, ("", "b"): 1}, {"": 3, "a": 2, "b": 3})
    mixed = count_letter_pairs(spark.createDataFrame([("aя яb a本",)], "text string"))
    assert mixed[0] == {("", "a"): 2, ("b", ""): 1} and mixed[1] == {"": 3, "a": 2, "b": 1}  # totals cover pairs with other letters


@pytest.mark.parametrize("hidden,word", [
    ("1d10t", "idiot"), ("id1ot", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("l0s3r", "loser"), ("tr@sh", "trash"),
    ("idiooooot", "idiot"), ("mmmoron", "moron"), ("sc*um", "scum"), ("letter", "letter"), ("coffeeee", "coffee"), ("idiot!!", "idiot"), ("###moron###", "moron"),
])
def test_restored(letters, hidden, word):
    assert word in restore(hidden, letters)


def test_spaced_letters_are_joined(letters):
    assert "idiot" in tokens("you i d i o t there")[0] and "moron" in tokens("m.o.r.o.n!")[0]
    assert restore("2024", letters) == [] and restore("...", letters) == []


def test_viterbi_is_the_cheapest_reading(letters):
    from itertools import product

    from segspark.llm.toxicity import lattice

    def cost(choices):
        total, state = sum(c for _, c in choices), ""
        for text, _ in choices:
            if text == " ":
                total += letters.cost(state, "") if state else 0.0
                state = ""
            else:
                for x in text:
                    total += letters.cost(state, x)
                    state = x
        return total + (letters.cost(state, "") if state else 0.0)

    random.seed(12)
    for _ in range(60):
        token = "".join(random.choices("ilo01$@!ts", k=random.randint(1, 5)))
        readings = {" ".join("".join(t for t, _ in c).split()): cost(c) for c in sorted(product(*lattice(token)), key=cost, reverse=True)}
        assert readings[decode(token, letters)[0]] == pytest.approx(min(readings.values()))


def test_held_out_accuracy_and_hidden_words(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    out = op10_toxicity(spark, SF)
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = out.filter("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in held}
    assert n.get((0, 1), 0) <= 0.01 * sum(c for (t, _), c in n.items() if t == 0)
    assert n[1, 1] >= 0.8 * sum(c for (t, _), c in n.items() if t == 1)


def test_hidden_words_score_as_plain_ones(spark):
    words = ["idiot", "moron", "stupid"]
    random.seed(13)
    clean = "the river runs along a green hill and into the old town where letters are read".split()
    rows = []
    for i in range(300):
        text = random.choices(clean, k=30)
        if i % 3 == 0:
            text[random.randrange(30)] = random.choice(words)
        rows.append((i, " ".join(text), int(i % 3 == 0)))
    learnt = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit(learnt.drop("toxic"), learnt.drop("text"))
    asked = ["the green 1d10t hill", "an old m0r0n", "a $tuuuupid town", "the i d i o t runs", "the green hill", "old town 2024", None, ""]
    got = {r["doc_id"]: r["score"] for r in score(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).collect()}
    assert all(got[i] >= 0.5 for i in range(4)) and all(got[i] < 0.5 for i in range(4, 8))


def test_odd_rows(spark):
    df = odd_documents(spark)
    blank = fit(df, df.withColumn("toxic", F.lit(None).cast("int")))
    assert {round(r["score"], 6) for r in score(df, blank).collect()} == {0.0}
    one = fit(df, df.withColumn("toxic", F.lit(1)))
    assert {round(r["score"], 6) for r in score(df, one).collect()} == {1.0}
    both = fit(df, df.withColumn("toxic", (F.coalesce("doc_id", F.lit(0)) % 2).cast("int")))
    out = score(df, both)
    assert ids(out) == ODD_IDS and out.filter("score IS NULL OR score < 0 OR score > 1").isEmpty()
    assert score(df.limit(0), both).isEmpty()
    assert fit(df.limit(0), df.withColumn("toxic", F.lit(1))).weights == {}


@pytest.mark.parametrize("hidden,word", [
    ("a$$", "ass"), ("4$$", "ass"), ("sh!+", "shit"), ("ki||", "kill"), ("(lown", "clown"), ("stuupid", "stupid"), ("idiiot", "idiot"),
    ("idiot!!", "idiot"), ("mississippi", "mississippi"), ("mississippi!", "mississippi"),
])
def test_signs_at_the_edge_and_pairs_are_read_both_ways(letters, hidden, word):
    assert word in restore(hidden, letters)


@pytest.mark.parametrize("text,word", [
    ("a m o r o n", "moron"), ("y o u a r e a n i d i o t o k", "idiot"), ("y o u  i d i o t", "idiot"), ("i  d  i  o  t", "idiot"),
    ("m . o . r . o . n", "moron"), ("$ t u p ! d", "stupid"), ("1 d 1 0 t !", "idiot"), ("y o u m m m m m o o o o r o n n n n", "moron"),
])
def test_a_word_may_end_anywhere_between_spaced_letters(letters, text, word):
    readings = [r for run in tokens(text)[1] for r in spaced_readings(run, letters)]
    assert any(spaced_features(r, {word + "$"}, [len(word)]) for r in readings)


def test_long_tokens_and_spaced_texts_take_little_memory(letters):
    import tracemalloc

    model = ToxicityModel(letters, {"idiot$": 9.0, "moron": 9.0}, -5.0)
    filler = "x y z " * 42_000
    texts = [filler + " i d i 0 t " + filler, "1a" * 10_000 + "-m0r0n", "ab" * 100_000]
    for text, toxic in zip(texts, (True, True, False)):
        tracemalloc.start()
        got = scores(model, [text])[0]
        assert (got > 0.5) == toxic and tracemalloc.get_traced_memory()[1] < 50e6
        tracemalloc.stop()


def test_skipped_decoding_loses_no_feature(letters):
    random.seed(3)
    model = ToxicityModel(letters, dict.fromkeys(["idiot$", "moron", "coffee$", "aabb$", "loser"], 1.0))
    lookup = Lookup(model)
    for _ in range(3000):
        word = "".join(c * random.choice([1, 1, 1, 2, 3]) for c in random.choice(["idiot", "moronic", "cofe", "ab", "loser", "clown", "tolso"]))
        want = {f for w in restore(word, letters) for f in word_features(w) if f in model.weights}
        assert {model.names[i] for i in lookup.of(word)} == want

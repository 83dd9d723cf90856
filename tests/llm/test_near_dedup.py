import math
import random
import re
from itertools import combinations

import numpy as np
import pytest
from odd import ODD_IDS, ids, odd_documents

from segspark.llm import near_dedup
from segspark.llm.near_dedup import bands_for, components, drop_near_duplicates, least_matches, near_duplicates

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(rows, size, percent=80):
    sets = {i: shingles(t, size) for i, t in rows}
    group = {i: i for i in sets}
    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]) and group[a] != group[b]:
            low, high = sorted((group[a], group[b]))
            group = {i: low if g == high else g for i, g in group.items()}
    return {i: (len(sets[i]), group[i]) for i in sets}


def corpus(seed=8):
    """Copies, a chain whose ends are not similar, a large group of near copies, and a passage in many short texts."""
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdefgh", k=4))
    texts = []
    base = [word() for _ in range(60)]
    for _ in range(120):  # near copies of one text: not all of them are similar to each other
        own = list(base)
        for _ in range(random.randint(0, 4)):
            own[random.randrange(60)] = word()
        texts.append(" ".join(own))
    chain = [word() for _ in range(50)]
    for k in range(0, 40, 2):
        texts.append(" ".join([*(word() for _ in range(0)), *[f"n{j}" for j in range(k)], *chain[k:]]))
    passage = [word() for _ in range(30)]
    for _ in range(60):
        texts.append(" ".join(passage + [word() for _ in range(random.randint(3, 14))]))
    texts += ["Same Text here"] * 40 + ["same  text\nHERE", "word", "WORD", "", " "]
    texts += [" ".join(word() for _ in range(random.randint(1, 40))) for _ in range(60)]
    random.shuffle(texts)
    return list(enumerate(texts))


def test_bands_and_posterior():
    b = bands_for(80, 6, 1e-5)
    assert (1 - 0.8**6) ** b <= 1e-5 < (1 - 0.8**6) ** (b - 1)
    grid = np.linspace(0, 1, 200_001)
    for n, m in least_matches(96, 80, 1e-4, 48):
        def above(k, n=n):
            density = grid**k * (1 - grid) ** (n - k)
            return density[grid >= 0.8].sum() / density.sum()
        assert above(m) >= 1e-4 > above(m - 1)
    assert math.isclose(above(96), 1 - 0.8**97, rel_tol=1e-3)


@pytest.mark.parametrize("block", [256, 4])
@pytest.mark.parametrize("size", [2, 5])
def test_equal_to_brute_force(spark, monkeypatch, block, size):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows, size)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, size=size).collect()}
    assert got == want


def test_all_links_without_hubs_help(spark, monkeypatch):
    """Groups are whole when hub comparisons find nothing, so that blocks do all the work."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    real = near_dedup._confirm
    monkeypatch.setattr(near_dedup, "_confirm", lambda pairs, sets, percent: real(pairs.filter("v % 7 = 0"), sets, percent))
    rows = [(i, t) for i, t in corpus(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, size=2).collect()}
    want = brute(rows, 2)
    # A bucket's hub is not dealt out again, so only its own links may be missing here.
    same = sum(got[i] == want[i] for i in want)
    assert same > 0.9 * len(want)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(5, 5)]
    df = spark.createDataFrame([(b, a) for a, b in links], "u long, v long").filter("u <> v")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_odd_rows(spark):
    df = odd_documents(spark)
    out = {}
    for r in near_duplicates(df, size=2).collect():
        out.setdefault(r["doc_id"], []).append(r)
    assert sorted((i for i, g in out.items() for _ in g), key=lambda x: (x is None, x)) == ODD_IDS
    for i in (0, 1, 2):
        assert (out[i][0]["n_shingles"], out[i][0]["component_id"], out[i][0]["kept"]) == (0, i, True)
    assert [r["n_shingles"] for r in out[3]] == [1, 1] and all(r["kept"] for r in out[3])
    assert out[7][0]["component_id"] == 6 and not out[7][0]["kept"]
    assert all(r["kept"] and r["component_id"] is None for r in out[None])
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns and ids(kept) == [0, 1, 2, 3, 3, 4, 5, 6, 8, None, None]
    assert near_duplicates(df.limit(0)).isEmpty() and drop_near_duplicates(df.limit(0)).isEmpty()
    only_empty = df.filter("doc_id = 1")
    assert near_duplicates(only_empty).first()["component_id"] == 1


def test_rows_that_share_an_id_go_by_their_own_text(spark):
    text = " ".join(f"w{i}" for i in range(40))
    near = text + " more"
    rows = [(1, text), (None, near), (None, "a lonely text that nothing is like"), (None, None), (5, near + " still"), (5, "another text of the same id"), (5, near)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in drop_near_duplicates(df).collect()]
    assert sorted(kept, key=str) == sorted([rows[0], rows[2], rows[3], rows[5]], key=str)

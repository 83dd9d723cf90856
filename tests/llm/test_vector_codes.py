import hashlib
import math
import random

import numpy as np
import pytest

from segspark.llm.vector_codes import LARGEST, Codebook, fit, with_label_error

SCHEMA = "vec_id long, embedding array<float>, label int"


def kept_rows(rows, width):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [[max(-LARGEST, min(LARGEST, math.floor(float(np.float32(x)) * 1024))) for x in r[1]] for r in kept]
    return kept, [w + [0] * (4 * width - len(w)) for w in whole]


def nearest(book, part):
    return min((sum((a - b) ** 2 for a, b in zip(e, part)), i) for i, e in enumerate(book))


def brute(rows, width, entries=256, rounds=4):
    kept, whole = kept_rows(rows, width)
    cut = [[w[p * width : (p + 1) * width] for p in range(4)] for w in whole]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0], kept[i][1]))[:entries]
    books = [[cut[i][p] for i in order] for p in range(4)]
    for _ in range(rounds):
        for p in range(4):
            groups = {}
            for parts in cut:
                groups.setdefault(nearest(books[p], parts[p])[1], []).append(parts[p])
            books[p] = [[sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else e for i, e in enumerate(books[p])]
    out = []
    for r, parts in zip(kept, cut):
        found = [nearest(books[p], parts[p]) for p in range(4)]
        out.append((r[0], "".join(f"{i:02x}" for _, i in found), sum(e for e, _ in found), r[2]))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def vectors(n, dim, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(dim)], rng.choice([1, 1, 2, None])) for i in range(n)]
    return rows + [(n + i, rows[0][1], 1) for i in range(n // 3)]  # a third are copies


@pytest.mark.parametrize("scale", [1, 1e5, 1e9])
def test_search_is_exact_at_any_size_of_components(scale):
    rng = np.random.default_rng(3)
    book = np.floor(rng.normal(0, 300 * scale, (200, 5))).astype(np.int64).tolist()
    book[50], book[150] = book[10], book[10]  # equal entries: the lowest index counts
    parts = np.vstack([np.floor(rng.normal(0, 300 * scale, (700, 5))), np.array(book[10:12], float)])
    code, error = Codebook(book).nearest(parts)
    for row, c, e in zip(parts.astype(np.int64).tolist(), code, error):
        assert (int(e), int(c)) == nearest(book, row)


def test_search_stops_early_where_sums_differ():
    book = [[1000 * i, 1000 * i] for i in range(256)]
    found = Codebook(book)
    met = []
    entries = found.entries.astype(float)

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                met.append(at.stop - at.start)
            return np.asarray(super().__getitem__(at))

    rows = np.array([[1000.0, 1000.0], [1500.0, 1400.0]])
    found._expand(rows, rows.sum(axis=1), entries.view(Watched), found.sums.astype(float))
    assert sum(met) < 128


def test_equal_to_brute_force(spark):
    rows = vectors(60, 8)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want, sha = brute(rows, 2, entries=16)
    codec = fit(df, entries=16)
    got = with_label_error(codec.encode(df, keep=["label"])).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == sorted(w[:3] for w in want)
    assert codec.sha256() == sha
    for r in got:
        assert r["label_error"] == sum(e for _, _, e, label in want if label == r["label"])


def test_odd_rows(spark):
    rows = [
        (0, [0.5] * 8, 1), (1, None, 1), (2, [0.1, None, *[0.0] * 6], 2), (3, [float("nan")] * 8, 2), (4, [float("inf")] * 8, 2),
        (5, [], None), (6, [0.25] * 5, None), (7, [1e30, -1e30, *[0.0] * 6], 3), (None, [0.5] * 8, 1), (None, None, None), (0, [0.5] * 8, 1),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", code string, key string")
    codec = fit(df)
    out = with_label_error(codec.encode(df, keep=["label"])).collect()
    want, sha = brute(rows, 2)
    bound = (1 << 63) - 1
    assert sorted(map(str, ((r["vec_id"], r["code"], r["error"]) for r in out))) == sorted(str((i, c, min(e, bound))) for i, c, e, _ in want)
    assert codec.sha256() == sha
    assert [r["error"] for r in out if r["vec_id"] == 6] == [0]
    empty = df.limit(0)
    assert fit(empty).encode(empty).isEmpty()
    nothing = spark.createDataFrame([(1, [], 1)], SCHEMA)
    assert [tuple(r) for r in fit(nothing).encode(nothing).collect()] == [(1, "00000000", 0)]

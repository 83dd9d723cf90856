import zlib

import numpy as np
import pandas as pd
import public_tokenizers as P
import pyarrow as pa
import pytest
from odd import ODD_IDS, TEXTS, ids, odd_documents
from tokenizers import Tokenizer

from segspark.llm.packing import Bins, cut_at_space, cuts, pack, token_ids, worker_tokens
from segspark.llm.span_cache import SpanCache
from segspark.llm.text_arrays import slices

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def hold(pieces: pd.DataFrame, capacity: int):
    """Sequences are gapless and within the capacity."""
    p = pieces.sort_values(["sequence_id", "offset"])
    assert (p.groupby("sequence_id").length.cumsum() - p.length == p.offset).all()
    used = p.groupby("sequence_id").length.sum()
    assert used.max() <= capacity
    return used


def padding(used, capacity):
    return sum(0 if u & (u - 1) == 0 else capacity - u for u in used)


def test_cuts():
    for n in range(0, 5000, 7):
        assert sum(cuts(n, 2048)) == n and all(0 < x <= 2048 for x in cuts(n, 2048))
    assert cuts(2048 + 1024 + 128 + 5) == [2048, 1024, 128, 5]


def test_bins_hold_every_id_once():
    rng = np.random.default_rng(5)
    bins, rows, total = Bins(64, 100), [], 0
    for d in range(500):
        n, start = int(rng.integers(1, 200)), 0
        for length in cuts(n, 64):
            rows += bins.add((d, start, np.arange(start, start + length, dtype=np.int32), n))
            start += length
        total += n
    rows += bins.rest()
    p = pd.DataFrame([(d, s, len(x), q, o) for d, s, x, _, q, o in rows], columns=["doc", "start", "length", "sequence_id", "offset"])
    used = hold(p, 64)
    assert p.length.sum() == total and padding(used, 64) < 0.03 * total
    for d, g in p.sort_values("start").groupby("doc"):
        assert (g.start == g.length.cumsum() - g.length).all()


MIXED = [
    "a\x1cb c\x1f d", "x\xa0y z\x85w", "DON'T stop's 12,5", "Σας ΣΑΣ İi", "é é É, ÉÀÞ! ×÷ a×b ß? ẞ ſ A\u030a a\u030a, Ünïcödé,!", "...", ".a. a.. ,A",
    "<|endoftext|> a<|endoftext|>b", "", "don't!!, we'LL #tag# C3PO, 日本語 🎉 text;",
]


def test_tokens_are_the_library_s(library):
    definition = open(PATH, encoding="utf-8").read()
    for limit in (4, 1 << 20):
        for part in slices(pa.array(MIXED), limit):
            tokens, bounds = token_ids(worker_tokens(definition), part)
            for i in range(len(part)):
                assert tokens[bounds[i] : bounds[i + 1]].tolist() == library.encode(MIXED[part.first + i], add_special_tokens=False).ids


def test_long_documents_are_cut_at_white_space():
    text = ("ab cde " * 40 + "x" * 300 + " ") * 3
    (part,) = slices(pa.array([text]))
    cut = cut_at_space(part, 64)
    assert len(cut) > 3 and b"".join(x.data.tobytes() for x in cut) == text.encode()
    assert text.split() == [w for x in cut for w in x.data.tobytes().decode().split()]


def test_span_cache_forgets_and_survives_equal_hashes():
    def encode(spans):
        return np.array([ord(c) for s in spans for c in s], np.int32), np.array([len(s) for s in spans])

    rng = np.random.default_rng(4)
    for hash_of in (lambda n: np.arange(n, dtype=np.uint64) % 3, lambda n: rng.integers(0, 40, n).astype(np.uint64)):
        cache = SpanCache(encode, most=50)
        for _ in range(30):
            spans = ["".join(rng.choice(list("abc"), rng.integers(1, 5))) for _ in range(40)]
            data = np.frombuffer("".join(spans).encode(), np.uint8)
            end = np.cumsum([len(s) for s in spans])
            by_span = dict(zip(spans, hash_of(40)))  # equal spans have equal hashes, others may too
            tokens, counts = cache.ids(data, end - [len(s) for s in spans], end, np.array([by_span[s] for s in spans], np.uint64))
            assert bytes(tokens.astype(np.uint8).tolist()) == data.tobytes() and counts.tolist() == [len(s) for s in spans]
            assert cache.ids_of.entries <= 50 + 40


def test_odd_rows(spark, library):
    df = odd_documents(spark).repartition(3)
    pieces = pack(df, PATH, with_ids=True)
    assert sorted(set(ids(pieces)) - {None}) == sorted(set(ODD_IDS) - {None})
    p = pieces.toPandas()
    hold(p, 2048)
    for i, text in enumerate(TEXTS):
        want = library.encode(text or "", add_special_tokens=False).ids + [1]
        own = p[p.doc_id == i].sort_values("start")
        copies = 2 if i == 3 else 1
        assert own.length.sum() == copies * len(want) and (own.doc_tokens == len(want)).all()
        for r in own.itertuples():
            part = want[r.start : r.start + r.length]
            assert list(r.ids) == part and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert pack(df.limit(0), PATH).isEmpty()
    with pytest.raises(ValueError):
        pack(df, PATH, capacity=1000)


def test_query_packs_all_documents(spark, library):
    from segspark.llm.queries import op3_harmonic_packing

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas().set_index("doc_id").text
    p = op3_harmonic_packing(spark, sf).toPandas()
    used = hold(p, 2048)
    total = 0
    for i, g in p.sort_values("start").groupby("doc_id"):
        want = library.encode(docs[i] or "", add_special_tokens=False).ids + [1]
        assert g.length.sum() == len(want) and (g.start == g.length.cumsum() - g.length).all()
        for s, n, c in zip(g.start, g.length, g.ids_crc32, strict=True):
            assert c == zlib.crc32(np.array(want[s : s + n], "<u4").tobytes())
        total += len(want)
    assert p.doc_id.nunique() == len(docs) and padding(used, 2048) < 0.02 * total

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from odd import ODD_IDS, TEXTS, ids, odd_documents

from segspark.llm.bpe import EditableText, Encoder, PrefixTable, encode

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        return Encoder(f.read(), P.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})


def made(k):
    parts = ["a", "b", "the", "ing", "ion", " ", "  ", "\n", "é", "ß", "日本", "1", "23", "!", "...", "​", "🎉", "'s", "<|endoftext|>", "\xa0"]
    return "".join(random.choices(parts, k=k))


def test_ids_equal_the_library(encoder, library):
    random.seed(1)
    for _ in range(1500):
        text = made(random.randint(0, 40))
        found, _ = encoder.encode([text])
        assert found.tolist() == library.encode_ordinary(text)
        assert encoder.vocabulary.decode(found).tobytes() == text.encode()


def test_tables_append_and_edit(encoder):
    random.seed(2)
    v = encoder.vocabulary
    for _ in range(300):
        data = made(12).encode()
        table = PrefixTable(v, data[:5])
        table.append(data[5:])
        assert table.ids() == v.merge(data)
        i = random.randint(0, len(data))
        j = random.randint(i, len(data))
        table.replace(i, j, made(2).encode())
        assert table.ids() == v.merge(table.data)


def test_an_edit_fills_only_its_surroundings(encoder):
    table = PrefixTable(encoder.vocabulary, b"understanding" * 500)
    assert table.replace(2000, 2001, b"q") < 4 * encoder.vocabulary.longest
    assert table.ids() == PrefixTable(encoder.vocabulary, table.data).ids()


def test_editable_texts(encoder, library):
    random.seed(4)
    for _ in range(800):
        text = made(random.randint(0, 25))
        edited = EditableText(encoder, text)
        i = random.randint(0, len(text))
        j = random.randint(i, len(text))
        new = random.choice(["", " ", "x", "  a", "ing", "\n\n", "'s", "é"])
        edited.replace(i, j, new)
        assert edited.text == text[:i] + new + text[j:] and edited.ids() == library.encode_ordinary(edited.text)


def test_small_caches_change_nothing(encoder, library):
    encoder.cache.most, most = 3, encoder.cache.most
    texts = [made(30) for _ in range(20)]
    for text in texts * 2:
        assert encoder.encode([text])[0].tolist() == library.encode_ordinary(text)
    encoder.cache.most = most


def test_odd_rows(spark, library):
    df = odd_documents(spark)
    out = encode(df, PATH, P.PATTERN, ["ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"])
    assert ids(out) == ODD_IDS
    for r in out.collect():
        if r["doc_id"] is None:
            continue
        text = TEXTS[r["doc_id"]] or ""
        want = library.encode_ordinary(text)
        assert r["ids"] == want and r["n_tokens"] == len(want) and bytes(r["decoded"]) == text.encode()
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert encode(df.limit(0), PATH, P.PATTERN, ["ids"]).isEmpty()


def test_query_over_all_documents(spark, library):
    from segspark.llm.queries import op2_byte_bpe

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_byte_bpe(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = library.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()

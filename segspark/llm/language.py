"""Language identification with language-bitmask n-gram filters.

All languages share one Bloom filter, cut into slices: slot s holds a mask with bit l set when an
n-gram of language l fell on s. The AND of an n-gram's slots gives every language that contains it
in one step. A document's votes for a language are the number of its n-grams with that bit (a
popcount down the slice), corrected by the slice's false-positive rate; the most votes decide.

Learning counts n-grams of letters per language over all learning rows (numpy in tasks, one shuffle
of pre-aggregated counts). An n-gram enters a language's filter when its share among the language's
n-grams is at least `least_share`; so there are at most 1 / least_share per language, and the
filter that is collected and broadcast is bounded by the number of languages alone.

Results for odd cases: a null text, or one without a letter, is `und` with score 0. A text whose n-grams
are all unknown gets the language with the most learning rows, score 0; without learning rows all
texts are `und`. Ties go to the first language in the alphabet. Texts are read whole. Null languages are
not learnt. Repeated rows count again in learning and give repeated results; an empty table gives an
empty result; a null id is never a learning row's doubt: it is used as given. Only the named columns
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segspark.llm.bpe import text_slices
from segspark.llm.piece_cache import worker_state
from segspark.llm.text_arrays import Rolling, mix

LENGTHS = (3, 4)
LEAST_SHARE = 2e-5
HASHES = 3
SLICE_CHARS = 1 << 20


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % folds


def letter_table() -> np.ndarray:
    state = worker_state()
    if "letters" not in state:
        state["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return state["letters"]


def letter_stream(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters with one separator (0) between words: codes, the document of each, letters per document."""
    lowered = [t.lower() for t in texts]
    joined = "\n" + "\n".join(lowered) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts) + 1), [1, *(len(t) + 1 for t in lowered)]) - 1
    letter = letter_table()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    return np.where(letter, codes, 0)[keep], doc[keep], np.bincount(doc[letter], minlength=len(texts))


def grams(texts: list[str], lengths: tuple[int, ...] = LENGTHS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams of letters (a separator may be first or last), the document of each, letters per document."""
    codes, doc, letters = letter_stream(texts)
    rolling = Rolling(mix(codes.astype(np.uint64) + np.uint64(1)))
    breaks = np.concatenate([[0], np.cumsum(codes == 0)])
    hashes, owners = [], []
    for n in lengths:
        start = np.arange(max(0, len(codes) - n + 1))
        start = start[breaks[start + n - 1] == breaks[start + 1]]  # none inside
        hashes.append(mix(rolling.spans(start, start + n) + np.uint64(n)))
        owners.append(doc[start + 1])
    return np.concatenate(hashes), np.concatenate(owners), letters


@dataclass
class LanguageModel:
    languages: list[str]  # in alphabetic order
    usual: int  # the language with the most learning rows
    slots: np.ndarray  # (slots, bytes): one bit per language
    false_positive: np.ndarray  # per language
    lengths: tuple[int, ...] = LENGTHS
    hashes: int = HASHES

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        size = np.uint64(len(self.slots) - 1)
        step = mix(hashes) | np.uint64(1)
        out = self.slots[(hashes & size).astype(np.int64)]
        for j in range(1, self.hashes):
            out = out & self.slots[((hashes + np.uint64(j) * step) & size).astype(np.int64)]
        return out

    def votes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected votes (documents x languages), and the number of letters per document."""
        hashes, owner, letters = grams(texts, self.lengths)
        total = np.bincount(owner, minlength=len(texts)).astype(float)
        masks = self.masks(hashes)
        votes = np.empty((len(texts), len(self.languages)))
        for i in range(len(self.languages)):
            has = (masks[:, i // 8] >> (i % 8)) & 1
            seen = np.bincount(owner, has, len(texts))
            votes[:, i] = (seen - total * self.false_positive[i]) / (1 - self.false_positive[i])
        return np.maximum(votes, 0), letters


def count_grams(df: DataFrame, lang_col: str, text_col: str, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """(lang, gram, n) over all rows with a language and a text."""
    source = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("body")).dropna()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, langs = np.unique(np.array(batch.column(0).to_pylist(), dtype=object).astype(str), return_inverse=True)
            for first, texts in text_slices(batch.column(1), SLICE_CHARS):
                hashes, owner, _ = grams(texts, lengths)
                lang = langs[first : first + len(texts)][owner]
                for i in np.unique(lang):
                    gram, n = np.unique(hashes[lang == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[i]] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n, pa.int64())],
                        names=["lang", "gram", "n"],
                    )

    return source.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(
    df: DataFrame, lang_col: str = "lang", text_col: str = "text", lengths: tuple[int, ...] = LENGTHS,
    least_share: float = LEAST_SHARE, hashes: int = HASHES,
) -> LanguageModel:
    """Learn from all rows of `df` with a language."""
    from segspark.session import materialize

    counts = materialize(count_grams(df, lang_col, text_col, lengths))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    # At most 1 / least_share rows per language.
    chosen = counts.join(F.broadcast(totals), "lang").filter(F.col("n") >= F.greatest(F.lit(2.0), F.col("total") * least_share))
    rows = chosen.select("lang", "gram").toArrow()
    sizes = {r["lang"]: r["count"] for r in df.filter(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("lang")).count().collect()}
    languages = sorted(sizes)
    number = {name: i for i, name in enumerate(languages)}
    gram = np.asarray(rows["gram"].to_numpy()).view(np.uint64)
    lang = np.array([number[x] for x in rows["lang"].to_pylist()], np.int64)
    size = 1 << max(10, int(np.ceil(np.log2(8 * max(1, len(np.unique(gram)))))))
    slots = np.zeros((size, max(1, -(-len(languages) // 8))), np.uint8)
    step = mix(gram) | np.uint64(1)
    for j in range(hashes):
        at = ((gram + np.uint64(j) * step) & np.uint64(size - 1)).astype(np.int64)
        np.bitwise_or.at(slots, (at, lang // 8), (1 << (lang % 8)).astype(np.uint8))
    filled = np.array([((slots[:, i // 8] >> (i % 8)) & 1).mean() for i in range(len(languages))])
    usual = max(range(len(languages)), key=lambda i: sizes[languages[i]], default=0)
    return LanguageModel(languages, usual, slots, filled**hashes, lengths, hashes)


def identify(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score (the chosen language's share of all votes)."""
    sent = df.sparkSession.sparkContext.broadcast(vars(model))  # plain values: workers need not import this package
    source = df.select(F.col(id_col).alias("row_key"), F.col(text_col).cast("string").alias("body"))
    kind = source.schema["row_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(**sent.value)
        names = np.array([*model.languages, "und"], dtype=object)
        for batch in batches:
            for first, texts in text_slices(batch.column(1), SLICE_CHARS):
                best, score = decide(model, texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(names[best], pa.string()), pa.array(score)],
                    names=["row_key", "lang_pred", "score"],
                )

    return source.mapInArrow(run, f"row_key {kind}, lang_pred string, score double").withColumnRenamed("row_key", id_col)


def decide(model: LanguageModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of each text's language (the number of languages for `und`) and its score."""
    if not model.languages:
        return np.zeros(len(texts), int), np.zeros(len(texts))
    votes, letters = model.votes(texts)
    best, total = votes.argmax(axis=1), votes.sum(axis=1)
    score = votes[np.arange(len(texts)), best] / np.where(total > 0, total, 1)
    best[total <= 0] = model.usual
    best[letters == 0] = len(model.languages)
    return best, np.where((letters == 0) | (total <= 0), 0.0, score)

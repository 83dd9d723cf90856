"""Grouping of spelling variants: PartEnum signatures on the letters of words.

A word's letters, with their number of times, are a binary vector (one dimension per letter and
occurrence). Two words at one replaced character have vectors at Hamming distance 2 and equal size; with one
inserted or deleted character, distance 1 and sizes one apart. PartEnum finds all vectors within
distance k by equality alone: the letters are split into n1 first-level parts of n2 second-level parts each;
within some first-level part the distance is at most k2 = ceil((k + 1) / n1) - 1, so at least n2 - k2 of its
second-level parts are equal. A signature is the content of n2 - k2 chosen second-level parts.

* Words are counted with a dictionary of bounded size per task before the shuffle.
* Signatures are made for distinct vectors, not words: anagrams share one. Vectors that share a signature meet in an
  equi-join whose condition already checks parity bits and the distance, so only near vectors leave it.
* Near vectors fetch their words by equi-joins, and the exact edit distance is again part of the join's
  condition: no list of candidates is ever written. Vectors of equal words differ in nothing, so anagrams never meet.
* Letters are dealt to parts by how often they occur in the vectors, which keeps signatures selective; at most as many
  counts as there are distinct letters reach the driver.
* Chains of forms end by pointer doubling: rounds grow with the logarithm of the longest chain.

A word's form is its near word of largest count if that count is at least `ratio` times its own (ties: smallest in
code-point order); its root is the last form of the chain. Counts rise along a chain, so chains end.

Results for odd cases: a null or empty text has no words; words of any length count and are compared whole; a
null id is written as an empty one where ids are asked for; repeated rows count each time; an
empty table gives no rows. Only id and text are read into names of our own, so other columns cannot clash.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segspark.session import materialize

#: Maximal runs of these characters are words.
LETTERS = "A-Za-zÀ-ÿ"
RATIO = 5
#: (n1, n2) for words of equal length (k = 2) and for words one character apart in length (k = 1).
SAME_LENGTH, ONE_LONGER = (1, 6), (1, 4)
#: Distinct words a task holds before it passes its counts on, and the text size from which matches are not listed at once.
HELD, LONG_TEXT = 200_000, 1 << 20
#: Words up to this length are compared by the built-in edit distance.
SHORT = 64

_UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def lowered(word: str) -> str:
    """A-Z lower-cased, nothing else."""
    return word.lower() if word.isascii() else word.translate(_UPPER)


def _runs(pattern: re.Pattern, text: str) -> Counter:
    if len(text) < LONG_TEXT:
        return Counter(pattern.findall(text))
    return Counter(m[0] for m in pattern.finditer(text))


def word_counts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: str = LETTERS,
    least_length: int = 1, least_count: int = 1, drop_every: int = 0,
) -> DataFrame:
    """(word, n): lower-cased words of at least `least_length` code points with their occurrences, from `least_count` on.

    With `drop_every`, a word of a document loses one code point wherever the crc32 h of `<id>:<word>` is a
    multiple of it: the one at h modulo its length.
    """
    source = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("string"))
    spelled = f"[{letters}]{{{least_length},}}"  # a shorter run cannot give a longer word

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, counts = re.compile(spelled), {}

        def passed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            ids, texts = batch.columns
            for row, key in enumerate(ids.to_pylist()):
                text = texts[row].as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{key}:".encode())
                for raw, n in _runs(pattern, text).items():
                    word = lowered(raw)
                    if drop_every:
                        h = zlib.crc32(word.encode(), start)
                        if h % drop_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_length:
                                continue
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > HELD:
                    yield passed_on()
        yield passed_on()

    found = source.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def enumerated(k: int, n1: int, n2: int) -> list[tuple[int, ...]]:
    """The signatures: for each, the second-level parts (numbered through) whose content it holds."""
    k2 = -(-(k + 1) // n1) - 1
    if n2 <= k2:
        raise ValueError("n2 has to be larger than ceil((k + 1) / n1) - 1")
    return [tuple(first * n2 + p for p in kept) for first in range(n1) for kept in itertools.combinations(range(n2), n2 - k2)]


def dealt(letters: dict[str, int], parts: int) -> list[str]:
    """Letters in `parts` groups of about equal weight, the heaviest first to the lightest group."""
    load, out = [0] * parts, [""] * parts
    for letter, weight in sorted(letters.items(), key=lambda x: (-x[1], x[0])):
        i = load.index(min(load))
        load[i] += weight
        out[i] += letter
    return out


def _parity(vector: Column) -> Column:
    """64 bits, letters flip theirs: within Hamming distance k, at most k bits differ."""
    return F.aggregate(F.split(vector, ""), F.lit(0).cast("long"), lambda bits, c: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 61)))


def one_edit(a: Column, b: Column) -> Column:
    """Whether exactly one character is inserted, deleted or replaced; `b` is as long as `a` or one longer, or one shorter.

    The built-in distance takes time in the square of the length, so longer words are compared from their first difference on.
    """
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    same = F.zip_with(F.split(short, ""), F.split(long, ""), lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False).cast("int")  # from 1; none if equal
    rest = F.substring(short, F.when(F.length(a) == F.length(b), first + 1).otherwise(first), F.length(long))
    linear = (first > 0) & (rest == F.substring(long, first + 1, F.length(long)))
    return F.when(F.length(long) <= SHORT, F.levenshtein(a, b, 1) == 1).otherwise(linear)


def near_vectors(vectors: DataFrame) -> DataFrame:
    """Pairs (a, b) of sorted-letter strings at Hamming distance 2 and equal size, or 1 and sizes one apart (b the larger).

    A few pairs more may be among them (where parity bits of long vectors coincide); none is missing. `vectors`: distinct strings `v`.
    """
    weights = vectors.select(F.explode(F.split("v", "")).alias("letter")).groupBy("letter").count().collect()
    letters = {r["letter"]: r["count"] for r in weights if r["letter"]}

    def signatures(k: int, shape: tuple[int, int]) -> list[Column]:
        groups = dealt(letters, shape[0] * shape[1])
        left_out = ["".join(g for p, g in enumerate(groups) if p not in kept) for kept in enumerated(k, *shape)]
        return [F.xxhash64(F.lit(k), F.lit(i), F.translate("v", out, "") if out else F.col("v")) for i, out in enumerate(left_out)]

    keyed = vectors.select("v", F.length("v").alias("size"), _parity(F.col("v")).alias("parity"), F.array(*signatures(2, SAME_LENGTH)).alias("same"), F.array(*signatures(1, ONE_LONGER)).alias("one"))
    base = keyed.select(
        "v", "size", "parity",
        F.explode(F.concat(
            F.transform("same", lambda s: F.struct(F.col("size").alias("base"), s.alias("key"))),
            F.transform("one", lambda s: F.struct(F.col("size").alias("base"), s.alias("key"))),
            F.transform("one", lambda s: F.struct((F.col("size") - 1).alias("base"), s.alias("key"))),
        )).alias("s"),
    ).select("v", "size", "parity", F.xxhash64("s.base", "s.key").alias("key"))
    base = materialize(base)
    a, b = base.alias("a"), base.alias("b")
    differ = F.bit_count(F.col("a.parity").bitwiseXOR(F.col("b.parity")))
    same = (F.col("a.size") == F.col("b.size")) & (F.col("a.v") < F.col("b.v")) & (differ <= 2)
    longer = (F.col("a.size") + 1 == F.col("b.size")) & (differ <= 1)
    apart = F.when(F.col("b.size") <= SHORT, F.levenshtein("a.v", "b.v", 2) >= 0).otherwise(True)
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (same | longer) & apart)
    return met.select(F.col("a.v").alias("a"), F.col("b.v").alias("b")).distinct()


def near_words(words: DataFrame) -> DataFrame:
    """(word, near) in both directions for every pair at edit distance one. `words`: a written table with unique `word`."""
    spelled = materialize(words.select("word", F.array_join(F.array_sort(F.split("word", "")), "").alias("v")))
    pairs = materialize(near_vectors(spelled.select("v").distinct()))
    left = pairs.join(spelled.select(F.col("word"), F.col("v").alias("a")), "a").select("word", "b")
    right = spelled.select(F.col("word").alias("near"), F.col("v").alias("b"))
    found = materialize(left.join(right, (left["b"] == right["b"]) & one_edit(left["word"], right["near"])).select("word", "near"))
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("word").alias("near")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of `forms` (word, form): the end of each chain, by pointer doubling."""
    at = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if at.join(ahead, "root", "left_semi").isEmpty():
            return at
        at = materialize(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of all `words` (word, n), which are unique."""
    words = materialize(words.select("word", "n"))
    near = near_words(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    found = words.join(best, "word", "left")
    strong = -F.col("best.less") >= ratio * F.col("n")
    found = materialize(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, F.col("best.form")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"),
    ))
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def respell(df: DataFrame, found: DataFrame, text_col: str = "text", letters: str = LETTERS) -> DataFrame:
    """`df` with every lower-cased word that has a root replaced by it; other words, case and signs stay.

    `found` holds (word, root). Texts are taken apart and put together again by row, so the table of roots is joined
    and never sent whole.
    """
    rows = materialize(df.withColumn("~row", F.monotonically_increasing_id()))
    words = rows.select("~row", F.explode(F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(f"([{letters}]+)"), 1))).alias("~raw"))
    plain = F.translate("~raw", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = found.where("root <> word").select(F.col("word").alias("~word"), F.col("root").alias("~root"))
    hits = words.join(changed, plain == F.col("~word")).groupBy("~row").agg(F.map_from_entries(F.collect_list(F.struct("~raw", "~root"))).alias("~map"))
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(f"([{letters}]+|[^{letters}]+)"), 1)
    respelled = F.array_join(F.transform(pieces, lambda p: F.coalesce(F.element_at("~map", p), p)), "")
    text = F.when(F.col("~map").isNull(), F.col(text_col)).otherwise(respelled)
    return rows.join(hits, "~row", "left").withColumn(text_col, text).drop("~row", "~map")

"""Toxicity scores behind a noisy channel.

Words are hidden by writing letters as digits or signs, by signs or spaces between letters, and by
repeating letters. For every such token a lattice of what each character may stand for is decoded by
Viterbi under a letter-pair model of the corpus; the score then looks at restored words only, those of
the few likeliest readings (letter pairs alone cannot always tell "ldiot" from "idiot"). Signs at a
word's edge that may be letters are read both ways, two equal letters also as one, and between spaced
letters a word may end anywhere. Digits alone are a number.

* The letter-pair model counts all letter pairs of all documents, pre-aggregated in tasks. The driver gets the
  pairs among Latin letters (readings are Latin) and one total per Latin letter over all its pairs: both bounded by
  the alphabet, not by the data.
* Features are restored words and their beginnings of 5 to 8 letters. They are chosen by significance alone, and their
  weights fitted (logistic regression with an L2 penalty), on at most `per_class` labelled rows of
  each class, the ones with the smallest hash of their id; classes are weighted back to their true
  sizes.
* In a run of spaced letters words may begin and end anywhere: its lattice is decoded as a whole, and features are
  looked for at every letter of the readings, in time and memory in proportion to the run. Tokens and runs of any
  length are decoded in overlapping windows of `WINDOW` characters.
* Scoring looks every token up once per worker. A token of letters only is decoded for its repeated letters only if
  a feature could come of it: with runs cut to one letter, all its readings look alike, and so must the feature.

Results for odd cases: a null or empty text has no features and gets the score of such texts. Texts
are read whole. Rows without a label are not learnt from; without any label of either class the score
is the share of the other (0 or 1), and 0 without labels. Repeated rows give repeated scores; an empty
table an empty result. Among equally cheap readings the first found counts; rows of equal id hash are drawn by id; a row
with a null id is scored but not learnt from. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segspark.llm.bpe import text_slices
from segspark.llm.language import letter_stream
from segspark.llm.piece_cache import PieceCache, worker_state
from segspark.session import materialize

PER_CLASS = 5000
BEGINNINGS = (5, 6, 7, 8)
#: Letter pairs are kept among Latin letters (and word edges): readings are Latin, so only those are asked for.
LATIN_END = 0x250
#: Longer tokens and spaced runs are decoded in overlapping windows of so many characters.
WINDOW = 64
ROWS_TOGETHER = 50_000  # in an Arrow batch of features
#: A feature is kept from this many toxic rows, this log-odds ratio and this many standard errors on.
LEAST_ROWS, LEAST_ODDS, LEAST_ERRORS = 3, 1.0, 3.0

# What a character may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
# Costs in nats: a character read as a letter; a sign that can be no letter dropped, or read as a word's
# end; the same for one that can be a letter (which also saves that letter's cost); a run shortened.
READ, DROP, BREAK, DROP_LETTER, SHORTEN = 0.5, 1.0, 2.5, 6.0, 0.5
READINGS = 6
EDGE = ".,;:!?#*%&|<>()[]{}\"'`~^-_=+/\\$…«»“”’"
SIGNS = "".join(c for c in LEET if not c.isdigit())  # signs that may be letters, also at a token's edge
NO_LETTER = "".join(c for c in EDGE if c not in SIGNS)
_RUN = re.compile(r"([^\W\d_])\1\1")
_PAIR = re.compile(r"([^\W\d_])\1")
_PAIR_RUN = re.compile(r"([^\W\d_])\1+")
# Possessive, so that the engine keeps no state per letter of a long run.
_SPACED = re.compile(r"(?<![^\W_])[^\W_](?:[ .\-_*][^\W_](?![^\W_])){2,}+")
_LETTER = rf"(?:[^\W_]|[{re.escape(SIGNS)}])"
_GAP = re.compile(r"[\s.\-_*]+")
_SPACED_WIDE = re.compile(rf"(?<![^\W_]){_LETTER}(?:[\s.\-_*]++{_LETTER}(?![^\W_])){{2,}}+")


@dataclass
class LetterModel:
    """Log-probabilities of a letter after another; '' is a word's edge."""

    pairs: dict[tuple[str, str], float]
    rare: dict[str, float]  # after a letter: the log-probability of a letter never seen there

    @staticmethod
    def of(counts: dict[tuple[str, str], int], totals: dict[str, int]) -> LetterModel:
        """`totals`: per letter, its pairs with any letter."""
        letters = len({b for _, b in counts}) + 1
        return LetterModel(
            {(a, b): math.log((n + 0.5) / (totals[a] + 0.5 * letters)) for (a, b), n in counts.items()},
            {a: math.log(0.5 / (n + 0.5 * letters)) for a, n in totals.items()},
        )

    def cost(self, a: str, b: str) -> float:
        return -self.pairs.get((a, b), self.rare.get(a, -12.0))


def lattice(token: str, pairs: bool = True) -> list[list[tuple[str, float]]]:
    """Per run of equal characters: what it may stand for ('' nothing, ' ' a word's end) and at what cost.

    With `pairs`, two equal letters may stand for one. Signs at the token's edges are dropped like other signs.
    """
    out = []
    first, last = len(token) - len(token.lstrip(SIGNS)), len(token.rstrip(SIGNS))
    for run in re.finditer(r"(.)\1*", token, re.S):
        c, n = run[1], len(run[0])
        if c.isalpha():
            once = [(c, SHORTEN)] * (pairs or n > 2)
            out.append([(c * n, 0.0)] + once * (n == 2) if n < 3 else once + [(c * 2, SHORTEN)])
            continue
        inside = first <= run.start() < last
        choices = [("", DROP_LETTER), (" ", DROP_LETTER)] if c in LEET and inside else [("", DROP), (" ", BREAK)]
        for letter in LEET.get(c, ""):
            choices += [(letter, READ)] + [(letter * 2, READ)] * (n > 1)
        out.append(choices)
    return out


def decode(token: str, model: LetterModel, readings: int = READINGS, pairs: bool = True) -> list[str]:
    """The cheapest readings of a token, best first (Viterbi with that many paths per state); words are separated by a space."""
    best: dict[str, list[tuple]] = {"": [(0.0, None)]}
    for choices in lattice(token, pairs):
        after: dict[str, list[tuple]] = {}
        for state, paths in best.items():
            for text, extra in choices:
                if text == " ":
                    end, more = "", extra + (model.cost(state, "") if state else 0.0)
                else:
                    end, more = state, extra
                    for letter in text:
                        more += model.cost(end, letter)
                        end = letter
                after.setdefault(end, []).extend((cost + more, (path, text)) for cost, path in paths)
        best = {end: heapq.nsmallest(readings, paths, key=_cost) for end, paths in after.items()}
    ends = [(cost + (model.cost(s, "") if s else 0.0), path) for s, paths in best.items() for cost, path in paths]
    out: list[str] = []
    for _, path in sorted(ends, key=_cost):
        parts = []
        while path is not None:
            parts.append(path[1])
            path = path[0]
        out.append(" ".join("".join(reversed(parts)).split()))
    return list(dict.fromkeys(out))[:readings]


def _cost(path: tuple) -> float:
    return path[0]


def restore(token: str, model: LetterModel) -> list[str]:
    """The words of a lower-case token without white space: of all its likely readings, if it needs decoding.

    Signs at the edges that may be letters are read both ways, as are two equal letters. Digits alone are a number.
    """
    core = token.strip(NO_LETTER)
    if len(core) > WINDOW:
        return list(dict.fromkeys(w for part in windows(core) for w in restore(part, model)))
    if not any(c.isalpha() or c in SIGNS for c in core):
        return []
    bare = token.rstrip(EDGE).lstrip(EDGE.replace("$", "").replace("!", "").replace("|", ""))
    found: list[str] = []
    if bare.isalpha() and not _RUN.search(bare):
        found = [bare]
    elif any(c.isalpha() for c in bare):
        found = decode(bare, model, pairs=False)
    if core != bare or _PAIR.search(core):
        found = found + decode(core, model)
    return list(dict.fromkeys(w for reading in found for w in reading.split()))


def windows(letters: str) -> Iterator[str]:
    """The whole string if it is short, else overlapping windows: a lattice's memory does not grow with the text."""
    for i in range(0, max(1, len(letters) - WINDOW // 2), WINDOW // 2):
        yield letters[i : i + WINDOW]


def spaced_readings(run: str, model: LetterModel) -> Iterator[str]:
    """What the letters of a spaced run spell, without word ends: as they are, and the readings of their lattice."""
    letters = _GAP.sub("", run)
    if letters.isalpha():
        yield letters
    if not letters.isalpha() or _PAIR.search(letters):
        for window in windows(letters):
            yield from dict.fromkeys(r.replace(" ", "") for r in decode(window, model))


def spaced_features(reading: str, wanted: dict[str, int] | set[str], lengths: list[int]) -> set[str]:
    """The wanted features of all words in a reading: letter pairs cannot tell where words end here, so they may begin and end anywhere.

    `lengths`: those of whole words among the features.
    """
    found = set()
    for i in range(len(reading)):
        for n in BEGINNINGS:
            if reading[i : i + n] in wanted:
                found.add(reading[i : i + n])
        for n in lengths:
            if i + n <= len(reading) and reading[i : i + n] + "$" in wanted:
                found.add(reading[i : i + n] + "$")
    return found


def word_lengths(features) -> list[int]:
    return sorted({len(f) - 1 for f in features if f.endswith("$")})


def tokens(text: str) -> tuple[list[str], list[str]]:
    """Lower-case tokens, with those that single letters with a space or sign between them form, and the spaced runs."""
    lowered = text.lower()
    joined = [re.sub(r"[ .\-_*]", "", m[0]) for m in _SPACED.finditer(lowered)]
    return lowered.split() + joined, [m[0] for m in _SPACED_WIDE.finditer(lowered)]


def word_features(word: str) -> list[str]:
    return [word + "$", *(word[:n] for n in BEGINNINGS if len(word) >= n)]


@dataclass
class ToxicityModel:
    letters: LetterModel
    weights: dict[str, float]  # per feature
    intercept: float = 0.0
    key: bytes = b""
    names: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.names = sorted(self.weights)
        self.key = hashlib.sha256(repr((self.names, self.intercept)).encode()).digest()


def count_letter_pairs(df: DataFrame, text_col: str = "text") -> tuple[dict[tuple[str, str], int], dict[str, int]]:
    """Over all rows: counts of pairs of Latin letters ('' is a word's edge), and per Latin letter of its pairs with any letter."""
    source = df.select(F.col(text_col).cast("string").alias("body")).dropna()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_slices(batch.column(0), 1 << 21):
                codes = letter_stream(texts)[0].astype(np.int64)
                codes = np.minimum(codes, LATIN_END)  # one mark for all other letters
                pair, n = np.unique(codes[:-1] * (LATIN_END + 1) + codes[1:], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n, pa.int64())], names=["pair", "n"])

    counts = source.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    name = lambda c: chr(c) if c else ""
    pairs, totals = {}, {}
    for r in counts:
        a, b = divmod(r["pair"], LATIN_END + 1)
        if a < LATIN_END:
            totals[name(a)] = totals.get(name(a), 0) + r["n"]
            if b < LATIN_END:
                pairs[name(a), name(b)] = r["n"]
    return pairs, totals


def _document_features(df: DataFrame, letters: LetterModel, wanted: list[str] | None) -> DataFrame:
    """(row_key, y, feature) of labelled rows, each feature once per row; only the wanted ones if given."""
    sent = df.sparkSession.sparkContext.broadcast((letters.pairs, letters.rare, None if wanted is None else set(wanted)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, rare, wanted = sent.value
        letters = LetterModel(pairs, rare)
        known: dict[str, list[str]] = {}
        lengths = word_lengths(wanted or ())
        for batch in batches:
            keys, labels = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            out: list[tuple] = []
            for i, text in enumerate(batch.column(1)):
                found: set[str] = set()
                whole, spaced = tokens(text.as_py() or "")
                if wanted is not None:  # features are chosen by words that stand alone
                    for run in spaced:
                        for reading in spaced_readings(run, letters):
                            found |= spaced_features(reading, wanted, lengths)
                for token in set(whole):
                    if token not in known:
                        if len(known) > 300_000:
                            known.clear()
                        own = [f for w in restore(token, letters) for f in word_features(w)]
                        known[token] = own if wanted is None else [f for f in own if f in wanted]
                    found.update(known[token])
                out += [(keys[i], labels[i], f) for f in sorted(found)]
                if len(out) > ROWS_TOGETHER:
                    yield table(out)
                    out = []
            yield table(out)

    def table(out: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, names=["row_key", "y", "feature"])

    return df.mapInArrow(run, "row_key long, y int, feature string")


def significant(a: int, b: int, drawn: dict[int, int]) -> bool:
    """Whether a feature of `a` toxic rows and `b` others is kept; more toxic rows or fewer others never speak against it."""
    p1, p0 = (a + 0.5) / (drawn[1] + 1), (b + 0.5) / (drawn[0] + 1)
    odds = math.log(p1 / (1 - p1)) - math.log(p0 / (1 - p0))
    return odds > LEAST_ODDS and odds / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) > LEAST_ERRORS


def fit(df: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> ToxicityModel:
    """Learn from the rows of `df` that `labels` (`id_col`, `label_col` 0 or 1) covers; letter pairs from all rows of `df`."""
    letters = LetterModel.of(*count_letter_pairs(df, text_col))
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("key")).agg(F.max(label_col).cast("int").alias("y"))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    # Ids are drawn from the labels alone; the texts of the few that are drawn follow by a broadcast join.
    keys = [known.filter(F.col("y") == y).orderBy(F.xxhash64("key"), "key").limit(per_class) for y in (0, 1)]
    texts = df.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    sample = texts.join(F.broadcast(keys[0].unionAll(keys[1])), "key").groupBy("key", "y").agg(F.min("body").alias("body"))
    sample = materialize(sample.select(F.xxhash64(F.col("key").cast("string")).alias("row_key"), "body", "y").repartition(16, "row_key"))
    drawn = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    if len(drawn) < 2:
        return ToxicityModel(letters, {}, 30.0 if drawn.get(1) else -30.0)

    least = next(a for a in range(LEAST_ROWS, drawn[1] + LEAST_ROWS) if a >= drawn[1] or significant(a, 0, drawn))
    in_toxic = _document_features(sample.filter("y = 1"), letters, None).groupBy("feature").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    frequent = [r["feature"] for r in in_toxic.collect()]  # of at most `per_class` rows
    found = materialize(_document_features(sample, letters, frequent))
    counted = found.groupBy("feature").agg(F.count_if(F.col("y") == 1).alias("a"), F.count_if(F.col("y") == 0).alias("b")).collect()
    chosen = []
    for r in counted:
        if significant(r["a"], r["b"], drawn):
            chosen.append(r["feature"])
    names = sorted(chosen)
    rows = found.join(F.broadcast(sample.sparkSession.createDataFrame([(n,) for n in names], "feature string")), "feature") if names else None
    entries = rows.select("row_key", "y", "feature").collect() if rows is not None else []
    weights, intercept = _logistic(names, entries, sizes, drawn)
    return ToxicityModel(letters, dict(zip(names, weights, strict=True)), intercept)


def _logistic(names: list[str], entries: list, sizes: dict[int, int], drawn: dict[int, int], penalty: float = 0.05, steps: int = 300) -> tuple[list[float], float]:
    """Weights by accelerated gradient descent. Rows without a chosen feature are all alike: they enter as one weighted row per class."""
    number = {n: i for i, n in enumerate(names)}
    rows: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(entries, key=lambda r: (r["row_key"], r["feature"])):
        rows.setdefault(r["row_key"], (r["y"], []))[1].append(number[r["feature"]])
    y = [v[0] for v in rows.values()] + [0, 1]
    blank = {c: drawn[c] - sum(v[0] == c for v in rows.values()) for c in (0, 1)}
    weight = np.array([sizes[v[0]] / drawn[v[0]] for v in rows.values()] + [max(0, blank[c]) * sizes[c] / drawn[c] for c in (0, 1)])
    weight /= weight.sum()
    y = np.array(y, float)
    row = np.array([i for i, v in enumerate(rows.values()) for _ in v[1]], np.int64)
    col = np.array([j for v in rows.values() for j in v[1]], np.int64)
    w, b = np.zeros(len(names)), math.log(sizes[1] / sizes[0])
    look_w, look_b, rate = w.copy(), b, 4.0 / (1 + max(1, np.bincount(row).max() if len(row) else 1))
    lam = penalty / max(1.0, sum(drawn.values()))
    for step in range(steps):
        z = look_b + np.bincount(row, look_w[col], len(y))
        gap = weight * (1 / (1 + np.exp(-z)) - y)
        new_w = look_w - rate * (np.bincount(col, gap[row], len(names)) + lam * look_w)
        new_b = look_b - rate * gap.sum()
        ahead = step / (step + 3)
        look_w, look_b = new_w + ahead * (new_w - w), new_b + ahead * (new_b - b)
        w, b = new_w, new_b
    return w.tolist(), float(b)


def cut_runs(letters: str) -> str:
    return _PAIR_RUN.sub(r"\1", letters)


class Lookup:
    """Numbers of the model's features in tokens and spaced runs."""

    def __init__(self, model: ToxicityModel):
        self.letters, self.number = model.letters, {n: i for i, n in enumerate(model.names)}
        self.lengths = word_lengths(model.names)
        self.starts = {cut_runs(n) for n in model.names}
        self.cache = PieceCache(lambda found: [self.of(t) for t in found])

    def of(self, token: str) -> list[int]:
        core = token.strip(NO_LETTER)
        if core.isalpha() and len(core) <= WINDOW and _PAIR.search(core):
            short = cut_runs(core)
            words = restore(token, self.letters) if any(short[:n] in self.starts for n in range(1, 9)) or short + "$" in self.starts else []
        else:
            words = [core] if core.isalpha() and len(core) <= WINDOW else restore(token, self.letters)
        return [self.number[f] for w in words for f in word_features(w) if f in self.number]

    def spaced(self, runs: list[str]) -> set[int]:
        return {self.number[f] for run in runs for r in spaced_readings(run, self.letters) for f in spaced_features(r, self.number, self.lengths)}


def worker_features(model: ToxicityModel) -> Lookup:
    state, key = worker_state(), ("toxicity", model.key)
    if key not in state:
        state[key] = Lookup(model)
    return state[key]


def scores(model: ToxicityModel, texts: list[str]) -> np.ndarray:
    lookup, features = worker_features(model), len(model.names)
    split = [tokens(t) for t in texts]
    ids, bounds = lookup.cache.ids([whole for whole, _ in split])
    spaced = [(i, f) for i, (_, runs) in enumerate(split) if runs for f in lookup.spaced(runs)]
    doc = np.concatenate([np.repeat(np.arange(len(texts)), np.diff(bounds)), np.array([i for i, _ in spaced], np.int64)])
    once = np.unique(doc * np.int64(features + 1) + np.concatenate([ids, np.array([f for _, f in spaced], np.int64)]))
    weight = np.array([model.weights[n] for n in model.names] + [0.0])
    z = model.intercept + np.bincount(once // (features + 1), weight[once % (features + 1)], len(texts))
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def score(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score."""
    sent = df.sparkSession.sparkContext.broadcast((model.letters.pairs, model.letters.rare, model.weights, model.intercept))
    source = df.select(F.col(id_col).alias("row_key"), F.col(text_col).cast("string").alias("body"))
    kind = source.schema["row_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, rare, weights, intercept = sent.value
        model = ToxicityModel(LetterModel(pairs, rare), weights, intercept)
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(scores(model, texts))], names=["row_key", "score"]
                )

    return source.mapInArrow(run, f"row_key {kind}, score double").withColumnRenamed("row_key", id_col)

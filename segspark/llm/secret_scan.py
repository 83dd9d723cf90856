"""Secret scans: fixed forms, and a battery of randomness tests for strings of no known form.

Everything is DataFrame and SQL expressions; no Python runs on executors.

Base spans are the matches of three forms (`FORMS`), leftmost and non-overlapping per form. The battery
looks at runs of 20 or more base64 characters that hold a letter and a digit and overlap no base span,
and at the parts of 20 or more between their `/`, `-` and `_` (a secret behind a path); parts of a run
that is found whole are not reported. Each is given the narrowest encoding whose alphabet holds it, and
three tests measure in standard deviations how far it is from a random string of that encoding:

* chi-squared uniformity over the alphabet: ordinary strings (names, paths, joined phrases with a number) use
  characters unevenly;
* runs: ordinary strings change less often between digits, capitals, small letters and signs;
* serial correlation of neighbouring alphabet positions: characters of one kind stand together.

The three distances, each bounded, add up to one, near a standard normal for random strings whatever their
encoding. What is tested is the null hypothesis of an ordinary string, whose distance depends on encoding and
length: per encoding and length class (quarters of a power of two), its mean and spread are fitted to all candidates
of the corpus as a mixture with the known distances of random strings, under fixed values that weigh as
much as `PRIOR_WEIGHT` candidates, so that rare encodings have a null too. A step-up false-discovery rule per power of two of the length then
decides over the whole corpus: long and short candidates do not share a threshold, since short ones carry
less evidence. All this needs only the counts per encoding, length class and bin of the distance (at most
9 x 16 x 500 rows, pre-aggregated), whatever the corpus, and the thresholds become literals.

Results for odd cases: a null text counts as empty and has no spans. Texts are scanned whole. Repeated
rows give repeated results; an empty table an empty one; a null id stays null. Positions are code
points, end exclusive; at the same start, spans come in the order of the forms. Only id and text are read
by `scan`, and `redact` works under names of its own, so other columns cannot clash.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segspark.session import materialize

# Per form its pattern, the group that is measured, and how long that must be.
FORMS = {
    "assign": ("(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 12),
    "access": ("AKIA[A-Z0-9]+", 0, 18),
    "hex": ("[0-9a-f]{16,}", 0, 16),
}
KINDS = [*FORMS, "random"]
# Every fitting match of a form holds one of these, which is quicker to see.
GATES = {"assign": FORMS["assign"][0], "access": "AKIA[A-Z0-9]{14,}", "hex": "[0-9a-f]{16,}"}

CANDIDATE = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
DIGITS, UPPER, LOWER = string.digits, string.ascii_uppercase, string.ascii_lowercase
# Narrowest first.
ALPHABETS = {
    "hex": (DIGITS + "abcdef"), "HEX": (DIGITS + "ABCDEF"), "base32": ("234567" + UPPER),
    "base36": (DIGITS + LOWER), "BASE36": (DIGITS + UPPER), "base62": (DIGITS + UPPER + LOWER),
    "base64": (DIGITS + UPPER + LOWER + "+/"), "base64url": (DIGITS + UPPER + LOWER + "-_"), "mixed": (DIGITS + UPPER + LOWER + "+/-_"),
}

# An ordinary string, before the corpus has been seen: share of equal pairs of characters above that of a random
# string, changes of kind against a random string, serial correlation, spread of the distance.
EQUAL_PAIRS, LEAST_UNEVEN, CHANGES, SERIAL, SPREAD = 0.045, 0.73, 0.5, 0.4, 1.2
PRIOR_WEIGHT, ROUNDS = 30, 40
RANDOM = (-0.15, 1.2)  # mean and spread of the distance of random strings, from trials at 20 to 40 characters
NEAREST, FARTHEST, BIN = -2.0, 12.0, 0.05  # bounds of one test's distance; width of a bin of the sum
SHORTEST, LONGEST = 17, 32  # length classes: quarters of a power of two, from 20 and up to 256 characters
FALSE_DISCOVERIES = 0.05


def _change_rate(alphabet: str) -> float:
    """How often neighbours in a random string are of different kinds."""
    kinds = [sum(ch in kind for ch in alphabet) for kind in (DIGITS, UPPER, LOWER)]
    return 1 - sum((n / len(alphabet)) ** 2 for n in [*kinds, len(alphabet) - sum(kinds)])


def _running(array: str) -> str:
    """SQL: what stands before each element of an array of numbers, in blocks so that cost stays near linear."""
    inclusive = "aggregate({0}, array(0L), (s, x) -> concat(s, array(s[size(s) - 1] + x)))"
    blocks = f"transform(sequence(0, (size({array}) - 1) div 256), b -> slice({array}, b * 256 + 1, 256))"
    inner = f"transform({blocks}, k -> slice({inclusive.format('k')}, 1, size(k)))"
    totals = f"transform({blocks}, k -> aggregate(k, 0L, (s, x) -> s + x))"
    before = f"slice({inclusive.format(totals)}, 1, size({blocks}))"
    return f"flatten(zip_with({inner}, {before}, (p, o) -> transform(p, x -> x + o)))"


def _located(df: DataFrame, text: str, out: str, pattern: str, gate: str, group: int) -> DataFrame:
    """Adds array `out` of (start, end, value) of all matches; `value` is the group."""
    body = F.col(text)
    seen = body.rlike(gate)
    df = df.withColumn(
        "~raw",
        F.when(
            seen,
            F.struct(
                F.split(body, pattern, -1).alias("gaps"),
                F.regexp_extract_all(body, F.lit(pattern), F.lit(0)).alias("whole"),
                F.regexp_extract_all(body, F.lit(pattern), F.lit(group)).alias("value"),
            ),
        ),
    )
    df = df.withColumn(
        "~steps", F.expr("transform(sequence(1, size(`~raw`.whole)), i -> CAST(length(`~raw`.gaps[i - 1]) + length(`~raw`.whole[i - 1]) AS BIGINT))")
    )
    df = df.withColumn("~before", F.when(F.size("~steps") > 0, F.expr(_running("`~steps`"))))
    spans = (
        "transform(sequence(1, size(`~steps`)), i -> named_struct("
        "'start', `~before`[i - 1] + length(`~raw`.gaps[i - 1]), 'end', `~before`[i - 1] + `~steps`[i - 1], 'value', `~raw`.value[i - 1]))"
    )
    empty = F.expr("CAST(array() AS array<struct<start:bigint,end:bigint,value:string>>)")
    return df.withColumn(out, F.coalesce(F.when(F.size("~steps") > 0, F.expr(spans)), empty)).drop("~raw", "~steps", "~before")


def _with_parts(run: str) -> str:
    """SQL: a run and its parts of 20 or more characters between separators, as an array."""
    one = "named_struct('start', {0}, 'end', {1}, 'value', {2}, 'whole', {3})"
    longer = f"IF(length(w) >= 20, concat(s.out, array({one.format('s.at', 's.at + length(w)', 'w', 'false')})), s.out)"
    parts = (
        f"aggregate(split(rtrim('=', {run}.value), '[/_-]'), named_struct('at', {run}.start, 'out',"
        " CAST(array() AS array<struct<start:bigint,end:bigint,value:string,whole:boolean>>)),"
        f" (s, w) -> named_struct('at', s.at + length(w) + 1, 'out', {longer}), s -> s.out)"
    )
    whole = f"array({one.format(f'{run}.start', f'{run}.end', f'{run}.value', 'true')})"
    return f"IF({run}.value RLIKE '[/_-]', concat({whole}, {parts}), {whole})"


def _tested(df: DataFrame, groups: str) -> DataFrame:
    """Replaces the arrays of candidates by (start, end, whole, encoding, length_class, bin)."""
    def by_encoding(value) -> str:
        return "CASE c.encoding " + " ".join(f"WHEN '{n}' THEN {value(a)}" for n, a in ALPHABETS.items()) + " END"

    encoding = "CASE " + " ".join(f"WHEN c.core RLIKE '^[{a.replace('-', '')}{'-' * ('-' in a)}]+$' THEN '{n}'" for n, a in ALPHABETS.items()) + " END"
    kinds = f"translate(c.core, '{DIGITS + UPPER + LOWER}+/-_', '{'0' * 10 + '1' * 26 + '2' * 26 + '3333'}')"
    place = "'start', c.start, 'end', c.end, 'whole', c.whole"
    steps = [
        f"named_struct({place}, 'core', rtrim('=', c.value))",
        f"named_struct({place}, 'core', c.core, 'encoding', {encoding}, 'kinds', {kinds})",
        f"named_struct({place}, 'core', c.core, 'encoding', c.encoding, 'alphabet', {by_encoding(lambda a: repr(a))},"
        f" 'rate', CAST({by_encoding(_change_rate)} AS DOUBLE),"
        " 'n', length(c.core), 'changes', length(regexp_replace(c.kinds, '(.)\\\\1+', '$1')) - 1)",
        f"named_struct({place}, 'encoding', c.encoding, 'n', c.n, 'k', length(c.alphabet), 'rate', c.rate, 'changes', c.changes,"
        " 'squares', aggregate(sequence(1, length(c.alphabet)), 0D, (s, i) -> s + power(c.n - length(replace(c.core, substr(c.alphabet, i, 1), '')), 2)),"
        " 'v', transform(filter(split(c.core, ''), h -> h <> ''), h -> CAST(locate(h, c.alphabet) AS DOUBLE)))",
        f"named_struct({place}, 'encoding', c.encoding, 'n', c.n, 'k', c.k, 'rate', c.rate, 'changes', c.changes, 'squares', c.squares,"
        " 'mean', aggregate(c.v, 0D, (s, x) -> s + x) / c.n, 'power2', aggregate(c.v, 0D, (s, x) -> s + x * x) / c.n,"
        " 'lagged', aggregate(zip_with(slice(c.v, 1, c.n - 1), slice(c.v, 2, c.n - 1), (a, b) -> a * b), 0D, (s, x) -> s + x) / (c.n - 1))",
    ]
    for step in steps:
        df = df.withColumn(groups, F.expr(f"transform({groups}, g -> transform(g, c -> {step}))"))

    def judged(c: Column) -> Column:
        n, k, rate = c["n"].cast("double"), c["k"].cast("double"), c["rate"]
        uneven = (k / n * c["squares"] - n - (k - 1)) / F.sqrt(2 * (k - 1))
        runs = ((n - 1) * rate - c["changes"]) / F.sqrt((n - 1) * rate * (1 - rate))
        spread = c["power2"] - c["mean"] * c["mean"]
        r = F.when(spread > 0, (c["lagged"] - c["mean"] * c["mean"]) / spread).otherwise(F.lit(1.0))
        r = F.least(F.greatest(r, F.lit(-0.99)), F.lit(0.99))
        serial = F.log((1 + r) / (1 - r)) / 2 * F.sqrt(n - 3)
        distance = F.lit(0.0)
        for z in (uneven, runs, serial):
            distance = distance + F.least(F.greatest(z, F.lit(NEAREST)), F.lit(FARTHEST))
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["whole"].alias("whole"), c["encoding"].alias("encoding"),
            F.least(F.floor(F.log2(n) * 4), F.lit(LONGEST)).cast("int").alias("length_class"),
            F.floor((distance - 3 * NEAREST) / (BIN * 3**0.5)).cast("int").alias("bin"),
        )

    return df.withColumn(groups, F.transform(groups, lambda g: F.transform(g, judged)))


def with_spans(df: DataFrame, text: str) -> DataFrame:
    """Adds `~base`, the base spans in order as (start, rank, end), and `~candidates`, per run the tested run and parts."""
    df = df.withColumn("~body", F.coalesce(F.col(text).cast("string"), F.lit("")))
    for kind, (pattern, group, least) in FORMS.items():
        df = _located(df, "~body", f"~{kind}", pattern, GATES[kind], group)
        df = df.withColumn(f"~{kind}", F.expr(f"filter(`~{kind}`, c -> length(c.value) >= {least})"))
    ranked = [F.expr(f"transform(`~{kind}`, c -> named_struct('start', c.start, 'rank', {r}, 'end', c.end))") for r, kind in enumerate(FORMS)]
    df = df.withColumn("~base", F.array_sort(F.concat(*ranked))).drop(*(f"~{k}" for k in FORMS))
    df = _located(df, "~body", "candidates", CANDIDATE, CANDIDATE, 0)
    fit = "c.value RLIKE '[0-9]' AND c.value RLIKE '[A-Za-z]' AND NOT exists(`~base`, b -> b.start < c.end AND c.start < b.end)"
    df = df.withColumn("candidates", F.expr(f"transform(candidates, c -> filter({_with_parts('c')}, c -> {fit}))"))
    return _tested(df, "candidates").withColumnRenamed("candidates", "~candidates").drop("~body")


def _ordinary(encoding: str, length_class: int, counts: dict[int, int]) -> tuple[float, float]:
    """Mean and spread of the distance of ordinary strings of one encoding and length class.

    The corpus's candidates are a mixture of random strings, whose distances are known, and ordinary ones."""
    k, rate = len(ALPHABETS[encoding]), _change_rate(ALPHABETS[encoding])
    n = max(20.0, 2 ** (length_class / 4))
    uneven = (n - 1) * max(LEAST_UNEVEN, EQUAL_PAIRS * k - 1) / math.sqrt(2 * (k - 1))
    runs = (n - 1) * rate * CHANGES / math.sqrt((n - 1) * rate * (1 - rate))
    fixed = sum(min(z, FARTHEST) for z in (uneven, runs, math.atanh(SERIAL) * math.sqrt(n - 3))) / math.sqrt(3)
    seen = [(_distance(level) + BIN / 2, count) for level, count in counts.items()]
    middle, spread, random = fixed, SPREAD, 0.5
    for _ in range(ROUNDS):
        weights = []
        for x, count in seen:
            own = (1 - random) / spread * math.exp(-(((x - middle) / spread) ** 2) / 2)
            other = random / RANDOM[1] * math.exp(-(((x - RANDOM[0]) / RANDOM[1]) ** 2) / 2)
            weights.append(count * (own / (own + other) if own + other > 0 else 1.0))
        ordinary = sum(weights)
        random = min(max(1 - ordinary / sum(count for _, count in seen), 0.001), 0.999)
        middle = (PRIOR_WEIGHT * fixed + sum(w * x for w, (x, _) in zip(weights, seen))) / (PRIOR_WEIGHT + ordinary)
        square = sum(w * (x - middle) ** 2 for w, (x, _) in zip(weights, seen))
        spread = math.sqrt((PRIOR_WEIGHT * SPREAD**2 + square) / (PRIOR_WEIGHT + ordinary))
    return middle, spread


def _distance(level: int) -> float:
    """Lower end of a bin."""
    return level * BIN + math.sqrt(3) * NEAREST


def thresholds(tested: DataFrame, q: float = FALSE_DISCOVERIES) -> dict[tuple[str, int], int]:
    """Per encoding and length class the largest bin at which false discoveries are at most a share q of the octave's."""
    cells: dict[tuple[str, int], dict[int, int]] = {}
    each = tested.select(F.explode(F.flatten("~candidates")).alias("c"))
    for r in each.groupBy("c.encoding", "c.length_class", "c.bin").count().collect():
        cells.setdefault((r["encoding"], r["length_class"]), {})[r["bin"]] = r["count"]
    octaves: dict[int, list] = {}
    for key, counts in cells.items():
        middle, spread = _ordinary(*key, counts)
        for level, count in counts.items():
            p = math.erfc((middle - _distance(level + 1)) / spread / math.sqrt(2)) / 2
            octaves.setdefault(key[1] // 4, []).append((p, key, level, count))
    out: dict[tuple[str, int], int] = {}
    for tests in octaves.values():
        total, found, last = sum(x[-1] for x in tests), 0, -1.0
        tests.sort()
        for p, _, _, count in tests:
            found += count
            last = p if total * p <= q * found else last
        for p, key, level, _ in tests:
            if p <= last:
                out[key] = max(level, out.get(key, level))
    return out


def _accepted(levels: dict[tuple[str, int], int]) -> Column:
    """All spans, base and random, as sorted (start, rank, end)."""
    clauses = [f"(c.encoding = '{e}' AND c.length_class = {n} AND c.bin <= {b})" for (e, n), b in sorted(levels.items())]
    hit = f"({' OR '.join(clauses) or 'false'})"
    groups = f"transform(`~candidates`, g -> filter(g, c -> {hit}))"
    groups = f"transform({groups}, g -> IF(exists(g, c -> c.whole), filter(g, c -> c.whole), g))"
    random = F.expr(f"transform(flatten({groups}), c -> named_struct('start', c.start, 'rank', {len(FORMS)}, 'end', c.end))")
    return F.array_sort(F.concat("~base", random))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["rank"]], s["start"], s["end"])), ",")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = FALSE_DISCOVERIES) -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, n_random, base_sha256, spans (kind:start:end, comma-joined)."""
    rows = df.select(F.col(id_col).alias("~id"), F.col(text_col).alias("~text"))
    tested = materialize(with_spans(rows, "~text").drop("~text"))
    accepted = tested.withColumn("~spans", _accepted(thresholds(tested, q)))
    counts = [F.expr(f"CAST(size(filter(`~spans`, s -> s.rank = {r})) AS BIGINT)").alias(f"n_{kind}") for r, kind in enumerate(KINDS)]
    return accepted.select(
        F.col("~id").alias(id_col), *counts, F.sha2(_written(F.col("~base")), 256).alias("base_sha256"), _written(F.col("~spans")).alias("spans")
    )


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]", q: float = FALSE_DISCOVERIES) -> DataFrame:
    """`df` with every span of its texts replaced by `mark`; overlapping spans become one mark. Null stays null."""
    packed = df.select(F.struct("*").alias("~row"), F.col(text_col).cast("string").alias("~text"))
    tested = with_spans(packed, "~text")
    levels = thresholds(materialize(tested.select("~candidates")), q)
    merged = (
        "aggregate(`~spans`, CAST(array() AS array<struct<start:bigint,end:bigint>>), (m, s) ->"
        " CASE WHEN size(m) > 0 AND s.start < m[size(m) - 1].end"
        " THEN concat(slice(m, 1, size(m) - 1), array(named_struct('start', m[size(m) - 1].start, 'end', greatest(m[size(m) - 1].end, s.end))))"
        " ELSE concat(m, array(named_struct('start', s.start, 'end', s.end))) END)"
    )
    parts = (
        f"concat(transform(sequence(1, size(`~spans`)), i -> concat(substr(`~text`, 1 + CAST(if(i = 1, 0, `~spans`[i - 2].end) AS INT),"
        f" CAST(`~spans`[i - 1].start - if(i = 1, 0, `~spans`[i - 2].end) AS INT)), '{mark}')),"
        f" array(substr(`~text`, 1 + CAST(`~spans`[size(`~spans`) - 1].end AS INT))))"
    )
    out = tested.withColumn("~spans", _accepted(levels)).withColumn("~spans", F.expr(merged))
    cleaned = F.when(F.size("~spans") > 0, F.array_join(F.expr(parts), "")).otherwise(F.col("~text"))
    return out.select(*(cleaned.alias(c) if c == text_col else F.col("~row").getField(c).alias(c) for c in df.columns))

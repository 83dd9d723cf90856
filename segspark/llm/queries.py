"""Registered queries of this part: name -> (Spark callable, equivalent SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The rules of the stated query.
URL_RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def op1_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segspark.llm.url_trust import judge_pages

    return judge_pages(table(spark, sf_dir, "pages"), URL_RULES)


def _op1_sql() -> str:
    from segspark.llm.url_trust import DAMPING, LEAST, LINK, ROUNDS

    link = LINK.replace("'", "''")
    by_length = sorted(sorted(URL_RULES), key=len, reverse=True)
    fits = " ".join(
        f"WHEN (host = '{on}' OR ends_with(host, '.{on}')) AND starts_with(path, '/{rest}') THEN '{rule}'"
        for rule in by_length
        for on, _, rest in [rule.partition("/")]
    )
    verdicts = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in URL_RULES.items())
    lower = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rounds = ", ".join(
        f"""flow{i} AS MATERIALIZED (
        SELECT host, sum(t) AS t, sum(d) AS d FROM (
          SELECT dst AS host, t * o * {DAMPING} AS t, 0.0 AS d FROM edges JOIN flow{i - 1} f ON f.host = src
          UNION ALL SELECT src, 0.0, d * b * {DAMPING} FROM edges JOIN flow{i - 1} f ON f.host = dst) GROUP BY host)"""
        for i in range(1, ROUNDS + 1)
    )
    flows = " UNION ALL ".join(f"SELECT * FROM flow{i}" for i in range(1, ROUNDS + 1))
    return f"""WITH split AS (
      SELECT page_id, {lower("regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1)")} AS host,
        regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path, html FROM pages),
    ruled AS (SELECT *, CASE {fits} END AS rule FROM split),
    judged AS MATERIALIZED (SELECT page_id, host, path, rule, CASE rule {verdicts} END AS ruled, html FROM ruled),
    targets AS (SELECT page_id, host AS src, unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)) AS t FROM judged),
    links AS (
      SELECT DISTINCT page_id, src, {lower("regexp_extract(CASE WHEN starts_with(t, '//') THEN 'x:' || t ELSE t END, '^.*?://([^/?#]*)', 1)")} AS dst
      FROM targets),
    pairs AS (SELECT src, dst, count(*) AS n FROM links WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
    edges AS MATERIALIZED (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS o, n / sum(n) OVER (PARTITION BY dst) AS b FROM pairs),
    per_host AS MATERIALIZED (
      SELECT host, count(*) FILTER (WHERE ruled = 'allow') AS a, count(*) FILTER (WHERE ruled = 'block') AS b FROM judged GROUP BY host),
    flow0 AS MATERIALIZED (
      SELECT host, a / greatest((SELECT sum(a) FROM per_host), 1) AS t, b / greatest((SELECT sum(b) FROM per_host), 1) AS d
      FROM per_host WHERE host <> '' AND a + b > 0),
    {rounds},
    n_hosts AS (
      SELECT count(*) AS n FROM (SELECT host FROM per_host UNION SELECT src FROM edges UNION SELECT dst FROM edges) WHERE host <> ''),
    bad AS (
      SELECT host FROM ({flows}) GROUP BY host
      HAVING sum(d) > sum(t) AND sum(d) * {1 - DAMPING} * (SELECT n FROM n_hosts) >= {LEAST})
    SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
    FROM judged"""


OP1_SQL = _op1_sql()


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from segspark.llm.bpe import encode

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, ["n_tokens", "ids_sha256", "decoded_sha256"])


def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from segspark.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segspark.llm.exact_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segspark.llm.secret_scan import scan

    return scan(table(spark, sf_dir, "documents"))


OP7_SQL = """WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)"""


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segspark.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segspark.llm.language import fold
    from segspark.llm.quality_model import fit, score

    docs, held_out = table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 3) == 1
    forest = fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return score(docs, forest).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segspark.llm.repetition import repetition_statistics

    return repetition_statistics(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def repetition_ctes(documents: str = "documents", prefix: str = "") -> str:
    """CTEs up to `{prefix}judged`: per document the counts of op6 and its verdict, window by window."""
    from segspark.llm.repetition import RepetitionRules

    rules, p = RepetitionRules(), prefix
    lengths = sorted({*rules.ngram_percent, rules.window})
    grams = " UNION ALL ".join(
        f"SELECT doc_id, i, {n} AS n, list_aggregate(w[i:i+{n - 1}], 'string_agg', ' ') AS gram"
        f" FROM {p}tokens, unnest(range(1, len(w) - {n - 2})) t(i) WHERE len(w) >= {n}"
        for n in lengths
    )
    char_rules = " OR ".join(f"100 * dup_chars_{n} > {x} * word_chars" for n, x in rules.ngram_percent.items())
    return f"""
    {p}tokens AS (
      SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {documents}),
    {p}grams AS ({grams}),
    {p}again AS (SELECT doc_id, n, i FROM (SELECT doc_id, n, i, count(*) OVER (PARTITION BY doc_id, n, gram) AS c FROM {p}grams) WHERE c > 1),
    {p}places AS (SELECT DISTINCT doc_id, n, i + j AS k FROM {p}again, unnest(range(0, n)) u(j)),
    {p}covered AS (
      SELECT doc_id, count(*) FILTER (WHERE n = {rules.window}) AS n_repeat_words,
        {", ".join(f"sum(length(w[k])) FILTER (WHERE n = {n}) AS dup_chars_{n}" for n in rules.ngram_percent)}
      FROM {p}places JOIN {p}tokens USING (doc_id) GROUP BY doc_id),
    {p}split_lines AS (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM {p}tokens),
    {p}same_lines AS (
      SELECT doc_id, line, count(*) AS c, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars FROM {p}split_lines
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line),
    {p}line_counts AS (
      SELECT doc_id, sum(c) AS n_lines, sum(c - 1) AS n_dup_lines, sum((c - 1) * chars) AS dup_line_chars FROM {p}same_lines GROUP BY doc_id),
    {p}counted AS (
      SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(body, '[^{rules.symbols}]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_lines, 0)::BIGINT AS n_lines,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        {", ".join(f"coalesce(dup_chars_{n}, 0)::BIGINT AS dup_chars_{n}" for n in rules.ngram_percent)}
      FROM {p}tokens LEFT JOIN {p}line_counts USING (doc_id) LEFT JOIN {p}covered USING (doc_id)),
    {p}judged AS (
      SELECT *, n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.window_percent} * n_words AS base_failed,
        NOT (base_failed OR 100 * n_dup_lines > {rules.line_percent} * n_lines
          OR 100 * dup_line_chars > {rules.line_char_percent} * word_chars OR {char_rules}) AS kept
      FROM {p}counted)"""


OP6_SQL = f"""WITH {repetition_ctes()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segspark.llm.language import fit, fold, identify

    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = fit(docs.filter(~held_out))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segspark.llm.language import fold
    from segspark.llm.toxicity import fit, score

    docs, held_out = table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 5) == 0
    model = fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segspark.llm.sharding import even_tree, placed_documents

    placed = placed_documents(table(spark, sf_dir, "documents"), even_tree())
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _op11_sql() -> str:
    from segspark.llm.sharding import BITS, even_tree, leaves, with_new_region

    def draw(path: str, weight: float) -> str:
        drawn = f"('0x' || substr(md5(k || '/{path}'), 1, {BITS // 4}))::BIGINT"
        return f"-ln(({drawn} + 0.5) / {1 << BITS}.0) / {float(weight)}"

    def descent(tree: list, name: str) -> str:
        """CTEs `{name}0`, ...: one level each, `reached` being the path reached or `=shard`."""
        levels, nodes, path_of = [], [("", tree)], "SELECT *, '' AS reached FROM sized"
        while nodes:
            draws = " ".join(f"WHEN '{path}' THEN [{', '.join(draw(f'{path}{i}', sum(w for _, w in leaves(c))) for i, c in enumerate(node))}]" for path, node in nodes)
            ends = [(path, [f"={c[0]}" if isinstance(c, tuple) else f"{path}{i}." for i, c in enumerate(node)]) for path, node in nodes]
            steps = " ".join(f"WHEN '{path}' THEN ([{', '.join(map(repr, to))}])[list_position(d, list_min(d))]" for path, to in ends)
            levels.append(f"{name}{len(levels)} AS (SELECT * EXCLUDE (reached, d), coalesce(CASE reached {steps} END, reached) AS reached FROM (SELECT *, CASE reached {draws} END AS d FROM ({path_of})))")
            path_of = f"SELECT * FROM {name}{len(levels) - 1}"
            nodes = [(f"{path}{i}.", c) for path, node in nodes for i, c in enumerate(node) if isinstance(c, list)]
        return ", ".join(levels) + f", {name} AS (SELECT *, substr(reached, 2)::INTEGER AS {name}_shard FROM {name}{len(levels) - 1})"

    return f"""WITH bits AS (
      SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS remainder),
    sized AS MATERIALIZED (
      SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id::VARCHAR, '') AS k, strlen(coalesce(text, ''))::BIGINT + 1 AS size,
        xor(list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
          lambda c, b: xor(c >> 8, remainder[1 + (xor(c, b) & 255)])), 4294967295) AS text_crc32
      FROM documents, bits),
    {descent(even_tree(), "now")}, {descent(with_new_region(even_tree()), "later")}
    SELECT now.doc_id, now.size, now.text_crc32, 'key' AS law, now_shard AS shard,
      row_number() OVER (PARTITION BY now_shard ORDER BY now.doc_id NULLS FIRST, now.size, now.text_crc32) - 1 AS slot,
      later_shard AS grown_shard
    FROM now JOIN later USING (r)"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segspark.llm.vector_codes import fit, with_label_error
    from segspark.session import materialize

    vectors = table(spark, sf_dir, "embeddings")
    codec = fit(vectors)
    coded = with_label_error(materialize(codec.encode(vectors, keep=["label"])))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(codec.sha256()).alias("codebooks_sha256"))


def _op12_sql() -> str:
    from segspark.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE

    width = f"(dim // {PARTS})"
    steps = ", ".join(
        f"""found{i} AS MATERIALIZED (
      SELECT r, part, min(({{near}})::BIGINT * {ENTRIES} + entry) AS best FROM parts JOIN book{i} b USING (part) GROUP BY r, part)"""
        + (f""", book{i + 1} AS MATERIALIZED (
      SELECT part, entry, coalesce(m.vec, b.vec) AS vec FROM book{i} b LEFT JOIN (
        SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY j) AS vec FROM (
          SELECT part, (best % {ENTRIES})::BIGINT AS entry, j, sum(vec[j])::BIGINT AS s, count(*) AS n
          FROM found{i} JOIN parts USING (r, part), unnest(range(1, len(vec) + 1)) t(j) GROUP BY part, best % {ENTRIES}, j)
        GROUP BY part, entry) m USING (part, entry))""" if i < ROUNDS else "")
        for i in range(ROUNDS + 1)
    ).replace("{near}", "list_inner_product(parts.vec, parts.vec) - 2 * list_inner_product(parts.vec, b.vec) + list_inner_product(b.vec, b.vec)")
    return f"""WITH kept AS (
      SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label, len(embedding) AS dim,
        list_transform(embedding, lambda x: floor({SCALE} * x)::BIGINT) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
      SELECT r, part, v[part * {width} + 1:(part + 1) * {width}] AS vec FROM kept, unnest(range(0, {PARTS})) t(part)),
    book0 AS (SELECT part, r AS entry, vec FROM parts WHERE r < {ENTRIES}),
    {steps},
    coded AS MATERIALIZED (
      SELECT r, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY part) AS code, sum(best // {ENTRIES})::BIGINT AS error
      FROM found{ROUNDS} GROUP BY r)
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
      (SELECT sha256(string_agg(array_to_string(vec, ','), ',' ORDER BY part, entry)) FROM book{ROUNDS}) AS codebooks_sha256
    FROM coded JOIN kept USING (r)"""


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from segspark.llm.spelling import variants, word_counts

    words = word_counts(table(spark, sf_dir, "documents"), least_length=6, least_count=5, drop_every=199)
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    "op1_url_trust": (op1_url_trust, OP1_SQL),
    "op2_byte_bpe": (op2_byte_bpe, None),
    "op3_harmonic_packing": (op3_harmonic_packing, None),
    "op7_exact_dedup": (op7_exact_dedup, OP7_SQL),
    "op8_secret_scan": (op8_secret_scan, None),
    "op9_language": (op9_language, None),
    "op10_toxicity": (op10_toxicity, None),
    "op4_near_dedup": (op4_near_dedup, None),
    "op5_quality": (op5_quality, None),
    "op6_repetition": (op6_repetition, OP6_SQL),
    "op11_hash_tree_sharding": (op11_hash_tree_sharding, _op11_sql()),
    "op12_vector_codes": (op12_vector_codes, _op12_sql()),
    "op13_spelling_variants": (op13_spelling_variants, None),
}

"""The operators applied to whole tables, one query each, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import bitpack, disclosure, divergence, exact_dedup, license_digest, minhash_join, mixing, packing, ppm, preference_chat, prefix_trie, quality_rules, url_trie
from jobtide.llm.frames import stored

TOKENIZER, END_ID = "byte_bpe_50k.json", 2


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_documents(spark, sf_dir).select("doc_id", "text"), "text", keep=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op2_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation is the chosen one; the rejected one answers last as it did first, or not at all."""
    chosen = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    answers = chosen.where("role = 'assistant'").groupBy("conv_id").agg(F.min(F.struct("turn", "text")).alias("first"), F.max("turn").alias("last"))
    worse = F.when(F.col("first.turn") < F.col("last"), F.col("first.text")).otherwise("")
    rejected = chosen.join(answers, "conv_id", "left").select("conv_id", "turn", "role", F.when(F.col("turn") == F.col("last"), worse).otherwise(F.col("text")).alias("text"))
    return preference_chat.preference_pairs(chosen, rejected)


def op3_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest.match_licenses(_documents(spark, sf_dir), license_digest.known_licenses(spark))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(_documents(spark, sf_dir)).withColumn("target", F.round("target", 6))


def op5_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return ppm.score(_documents(spark, sf_dir), held_out, across=True)


def op6_bit_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = bitpack.write_ids(_documents(spark, sf_dir), tokenizer_path(), end=END_ID)
    return bitpack.read_ids(files, with_ids=False).drop("ids")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokenizer_path(), end=END_ID, with_ids=False)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(_documents(spark, sf_dir))


def op9_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_groups(_documents(spark, sf_dir))


def op10_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.find_personal(_documents(spark, sf_dir))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_documents(spark, sf_dir))


#: The entries of the URL filter's query: host, path, action.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op12_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_trie.judge_urls(pages, rules, keep=["page_id"])


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    keys = stored(prefix_trie.turn_keys(conversations), "turn-keys")
    return prefix_trie.prefix_nodes(prefix_trie.share_openings(keys))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_quality_rules, op2_preference_pairs, op3_license_digest, op4_mix_sources, op5_ppm_score, op6_bit_ids, op7_best_fit_packing, op8_exact_dedup, op9_minhash_join, op10_disclosure, op11_source_divergence, op12_url_trie, op13_prefix_trie)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _canonical_sql(text: str) -> str:
    out = f"regexp_replace(lower({text}), '(?m)^[ \\t]*(copyright\\b|\\(c\\)|©)[^\\n]*$', ' ', 'g')"
    for old, new in license_digest.SPELLINGS:
        out = f"replace({out}, '{old}', '{new}')"
    return f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ')"


_known = ", ".join(f"('{name}', '{text}')" for name, text in license_digest.KNOWN)

ORACLES: dict[str, str] = {
    "op2_preference_pairs": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
answers AS (SELECT conv_id, min(turn) AS first_turn, max(turn) AS last_turn, arg_min(text, turn) AS first_text FROM c WHERE role = 'assistant' GROUP BY conv_id),
both_sides AS (
  SELECT c.*, CASE WHEN turn = last_turn THEN CASE WHEN first_turn < last_turn THEN first_text ELSE '' END ELSE text END AS other
  FROM c LEFT JOIN answers USING (conv_id)),
split AS (SELECT conv_id, min(turn) FILTER (text <> other) AS split FROM both_sides GROUP BY conv_id),
written AS (
  SELECT conv_id, turn, role, split, turn >= split AS tail,
    '{preference_chat.OPEN}' || role || chr(10) AS head, text || '{preference_chat.CLOSE.strip()}' || chr(10) AS yes, other || '{preference_chat.CLOSE.strip()}' || chr(10) AS no
  FROM both_sides JOIN split USING (conv_id)),
placed AS (
  SELECT *, sum(length(head || yes)) OVER w AS yes_end, sum(length(head || no)) OVER w AS no_end
  FROM written WINDOW w AS (PARTITION BY conv_id, coalesce(tail, false) ORDER BY turn ROWS UNBOUNDED PRECEDING))
SELECT conv_id AS pair_id,
  count(*) FILTER (NOT coalesce(tail, false)) AS shared_turns,
  coalesce(string_agg(head || yes, '' ORDER BY turn) FILTER (NOT coalesce(tail, false)), '') AS prompt,
  coalesce(string_agg(head || yes, '' ORDER BY turn) FILTER (tail), '') AS chosen,
  coalesce(string_agg(head || no, '' ORDER BY turn) FILTER (tail), '') AS rejected,
  coalesce(string_agg((yes_end - length(yes)) || ':' || yes_end, ',' ORDER BY turn) FILTER (tail AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg((no_end - length(no)) || ':' || no_end, ',' ORDER BY turn) FILTER (tail AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY conv_id""",
    "op3_license_digest": f"""
WITH known(license, license_text) AS (VALUES {_known}),
wanted AS (SELECT DISTINCT license, {_canonical_sql("license_text")} AS form FROM known),
units AS (
  SELECT doc_id, true AS whole, coalesce(text, '') AS piece FROM documents
  UNION ALL
  SELECT doc_id, false, unnest(string_split(text, chr(10))) FROM documents WHERE contains(text, chr(10)))
SELECT doc_id, license, bool_or(whole) AS whole, count(*) AS n_lines
FROM units JOIN wanted ON {_canonical_sql("piece")} = form AND form <> '' GROUP BY doc_id, license""",
    "op4_mix_sources": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS hash
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
ranked AS (SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::DOUBLE AS weight FROM totals),
leveled AS (
  SELECT *, 2.0 * source_size AS cap,
    (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2.0 * source_size) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM ranked WINDOW b AS (ORDER BY source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (SELECT arg_min(level, source_size / weight) AS level FROM leveled WHERE level * weight < cap),
targets AS (SELECT source, source_size, least(cap, coalesce(weight * (SELECT level FROM final), cap))::DOUBLE AS target FROM leveled),
budgets AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
units AS (
  SELECT source, hash, sum(size) AS unit, max(size) AS one, row_number() OVER (PARTITION BY source ORDER BY hash) AS k FROM d GROUP BY source, hash),
walk AS (
  SELECT source, target, 0::BIGINT AS k, (target - whole * source_size)::DOUBLE AS room, 9e18::DOUBLE AS most, false AS done, false AS chosen FROM budgets
  UNION ALL
  SELECT w.source, target, w.k + 1, CASE WHEN NOT done AND one <= most AND unit <= room THEN room - unit ELSE room END,
    CASE WHEN NOT done AND one <= most AND unit > room THEN floor(room) ELSE most END,
    done OR (one <= most AND unit > room AND room <= {mixing.NEAR} * target), NOT done AND one <= most AND unit <= room
  FROM walk w JOIN units u ON u.k = w.k + 1 AND u.source IS NOT DISTINCT FROM w.source),
more AS (SELECT u.source, u.hash FROM units u JOIN walk w ON u.k = w.k AND u.source IS NOT DISTINCT FROM w.source WHERE chosen)
SELECT doc_id, size, source_size, round(target, 6) AS target, (size * least(2, whole + CASE WHEN more.hash IS NOT NULL THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN more ON more.hash = d.hash AND more.source IS NOT DISTINCT FROM d.source""",
    "op8_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op9_minhash_join": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN roots USING (doc_id)""",
    "op11_source_divergence": rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
held AS (SELECT id, lang, source, term, count(*) AS n FROM (SELECT id, lang, source, unnest(terms) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM held GROUP BY lang, term HAVING count(*) >= {divergence.LEAST_DOCUMENTS}),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, sum(held.n) AS n FROM held JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    (1 + ({divergence.SCALE}::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * l.v))::BIGINT AS p,
    (1 + ({divergence.SCALE}::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v))::BIGINT AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
compared AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
valued AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN compared c ON c.lang = a.lang AND c.source = a.source AND c.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM valued)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {divergence.RANKS}""",
    "op12_url_trie": rf"""
WITH u AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rule_host, rule_path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
seen AS (SELECT DISTINCT host, path FROM u),
best AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM seen JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN best USING (host, path)""",
    "op13_prefix_trie": """
WITH t AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS size,
    substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS key
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS pos FROM t),
names AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
rebuilt AS (
  SELECT n.conv_id, pos, key, size FROM names n JOIN placed p ON p.conv_id = n.base AND pos <= h
  UNION ALL
  SELECT conv_id, pos, key, size FROM names JOIN placed USING (conv_id) WHERE pos > h),
members AS (
  SELECT conv_id, 0 AS depth, '' AS node, 0 AS size FROM names
  UNION ALL
  SELECT conv_id, row_number() OVER w, string_agg(key, '') OVER w, size FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
ranked AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM members),
nodes AS (
  SELECT node, min(conv_id) AS conv_id, min(depth) AS depth, min(size) AS size, count(*) AS n,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM ranked GROUP BY node),
linked AS (
  SELECT c.*, p.conv_id AS parent, (SELECT count(*) FROM nodes k WHERE k.depth = c.depth + 1 AND left(k.node, length(k.node) - 32) = c.node) AS n_children
  FROM nodes c LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.node = left(c.node, length(c.node) - 32)),
sums AS (
  SELECT m.node, sum((u.n - 1) * u.size) AS saved, count(*) FILTER (u.n_children = 0) AS leaves
  FROM linked u JOIN members m ON m.conv_id = u.conv_id AND m.depth <= u.depth GROUP BY m.node)
SELECT conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n::BIGINT AS n_convs, n_children::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM linked JOIN sums USING (node)""",
}

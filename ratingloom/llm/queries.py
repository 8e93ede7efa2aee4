"""The registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import bpe, decontaminate, langid, linededup, minhash, pu, quality, reputation, sharding, toolchat
from ratingloom.llm.common import table
from ratingloom.llm.corpus_queries import ORACLES as CORPUS_ORACLES
from ratingloom.llm.corpus_queries import QUERIES as CORPUS_QUERIES


URL_RULES = (
    reputation.UrlRule("net", "/", "block"),
    reputation.UrlRule("example.net", "/en/", "allow"),
    reputation.UrlRule("example.com", "/de/", "block"),
    reputation.UrlRule("org", "/fr/", "allow"),
)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.find_hits(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, carry=["doc_id"])
    return judged.select("doc_id", *quality.MEASURES, "kept")


def _fold(doc_id: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(_fold("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    answer = langid.predicted(docs, model)
    found = docs.select("doc_id", held_out.alias("held_out"), answer.alias("answer"))
    return found.select("doc_id", "held_out", "answer.lang_pred", "answer.score")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(_fold("doc_id", 5) == 0, F.lit(False))
    trusted = table(spark, sf_dir, "labels").where(~held_out & (F.col("quality") == 1))
    rows = pu.featured(docs)
    model = pu.fit_features(rows, trusted.select("doc_id"))
    scores = rows.select("doc_id", held_out.alias("held_out"), pu.score_features(rows, model).alias("score"))
    return scores.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


# Words that spam pages name themselves or their site by.
SPAM_WORDS = ("adult", "casino", "pills", "spam")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is bad if its address or markup holds a spam word, or its text more than one
    symbol for ten words."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = F.regexp_replace("html", "<[^>]*>", " ")
    symbols = F.regexp_count(text, F.lit("[#*$%&|<>!]"))
    marked = F.concat_ws(" ", F.lower("url"), F.lower("html")).rlike("|".join(SPAM_WORDS))
    bad = marked | (10 * symbols > F.size(quality.split_words(text)))
    judged = reputation.judge_urls(pages, URL_RULES, bad)
    return judged.select("page_id", "host", "path", "rule", "verdict", "n", "bad", "lower_bound")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode_documents(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), 24, carry=["doc_id"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


TOOLS: dict[str, toolchat.Schema] = {
    "answer": {"question": ("string", True), "turn": ("integer", True), "brief": ("boolean", False)}
}


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as tool use: a user's turn is a call of ``answer``, the assistant's next turn
    its result. A call depends on the one two turns before; a turn that fits neither part stays a
    message. A question of fewer than five words asks for a brief answer with a word for the flag,
    which the schema refuses.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    name = lambda back: F.concat(F.lit("t"), (F.col("turn") - back).cast("string"))
    short = F.size(quality.split_words(F.col("text"))) < 5
    question = F.struct(
        F.col("text").alias("question"),
        F.col("turn").alias("turn"),
        F.when(short, F.lit("yes")).alias("brief"),
    )
    calls = turns.where("role = 'user'").select(
        "conv_id",
        "turn",
        name(0).alias("call_id"),
        F.lit("answer").alias("name"),
        F.to_json(question).alias("arguments"),
        F.array(name(2)).alias("depends_on"),
        F.lit(None).cast("string").alias("content"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", "turn", name(1).alias("call_id"), F.col("text").alias("content")
    )
    others = turns.where("role IS NULL OR role NOT IN ('user', 'assistant')").select(
        "conv_id", "turn", "role", F.col("text").alias("content")
    )
    return toolchat.format_messages(others, calls, results, TOOLS)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id",
        "n_lines",
        "n_removed_lines",
        "n_removed_words",
        F.sha2("text", 256).alias("text_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality_rules": op2_quality_rules,
    "op3_language_id": op3_language_id,
    "op4_url_filters": op4_url_filters,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_sharding": op7_sharding,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_minhash": op9_minhash,
    "op10_line_dedup": op10_line_dedup,
} | CORPUS_QUERIES

DECONTAMINATION_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item, n, array_to_string(ws[p : p + n - 1], ' ') AS k FROM (
  SELECT item, ws, least(10, len(ws)) AS n,
    unnest(generate_series(1, len(ws) - least(10, len(ws)) + 1)) AS p FROM iw WHERE len(ws) > 0)),
g AS (SELECT doc_id, p, n, array_to_string(ws[p : p + n - 1], ' ') AS k FROM (
  SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS p
  FROM dw JOIN (SELECT DISTINCT n FROM win) ON len(ws) >= n)),
h AS (SELECT doc_id, p, n, item FROM g JOIN win USING (n, k)),
c AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (
  SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS w FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
"""

# One text's whole-window repeats are counted as positions with an equal window elsewhere
# in the text; the words they cover follow from the gaps between those positions.
QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
u AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
k AS (
  SELECT doc_id, p, word = lag(word) OVER o AS stutter,
    CASE WHEN lead(word, 7) OVER o IS NOT NULL THEN concat_ws(' ', word, lead(word, 1) OVER o,
      lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o, lead(word, 5) OVER o,
      lead(word, 6) OVER o, lead(word, 7) OVER o) END AS g
  FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c
  FROM k WHERE g IS NOT NULL) WHERE c >= 2),
c AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n FROM (SELECT doc_id,
  least(8, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p), 8)) AS n FROM r) GROUP BY 1),
s AS (SELECT doc_id, count(*) FILTER (stutter) AS n FROM k GROUP BY 1),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)),
  lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (
  SELECT w.doc_id, t, len(ls) AS n_lines, coalesce(s.n, 0) AS stutters,
    CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words
  FROM w JOIN l USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN s USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words
    OR word_chars < 3 * n_words OR word_chars > 12 * n_words
    OR 2 * n_dup_lines > n_lines
    OR 5 * len(regexp_extract_all(t, '!')) > n_words
    OR 2 * len(regexp_extract_all(t, '\p{Lu}')) > len(regexp_extract_all(t, '\p{L}'))
    OR 5 * stutters > n_words) AS kept
FROM b
"""

# JSON strings are built by hand: canonical form has sorted keys and escapes only what it must.
CHAT_SQL = r"""
WITH RECURSIVE t AS (SELECT conv_id, turn, role, text, 't' || turn AS own, 't' || (turn - 1) AS asked,
  CASE WHEN text IS NULL THEN 'null' ELSE CAST(to_json(text) AS VARCHAR) END AS content,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) < 5 AS short FROM conversations),
calls AS (SELECT * FROM t WHERE role = 'user'),
known AS (SELECT conv_id, own, min(turn) AS first_turn FROM calls GROUP BY 1, 2),
lv AS (
  SELECT conv_id, first_turn AS turn, 0 AS level FROM known k WHERE NOT EXISTS (
    SELECT 1 FROM known p WHERE p.conv_id = k.conv_id AND p.first_turn = k.first_turn - 2)
  UNION ALL SELECT k.conv_id, k.first_turn, level + 1 FROM lv JOIN known k
    ON k.conv_id = lv.conv_id AND k.first_turn = lv.turn + 2),
answered AS (SELECT DISTINCT conv_id, asked FROM t WHERE role = 'assistant'),
a AS (SELECT *, '{' || CASE WHEN short THEN '"brief":"yes",' ELSE '' END
  || CASE WHEN text IS NULL THEN '' ELSE '"question":' || content || ',' END
  || '"turn":' || turn || '}' AS arguments FROM calls)
SELECT conv_id, turn, 'call' AS kind, own AS call_id, level,
  CASE WHEN asked_.asked IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
  concat_ws('; ', CASE WHEN short THEN 'brief is not boolean' END,
    CASE WHEN text IS NULL THEN 'missing question' END) AS arguments_error,
  '{"content":null,"role":"assistant","tool_calls":[{"function":{"arguments":'
    || CAST(to_json(arguments) AS VARCHAR) || ',"name":"answer"},"id":"' || own
    || '","type":"function"}]}' AS json
FROM a JOIN lv USING (conv_id, turn)
LEFT JOIN answered asked_ ON asked_.conv_id = a.conv_id AND asked_.asked = a.own
UNION ALL
SELECT t.conv_id, t.turn, 'result', t.asked, lv.level, CASE WHEN lv.level IS NULL THEN 'orphan' ELSE 'linked' END,
  NULL, '{"content":' || content || ',"role":"tool","tool_call_id":"' || t.asked || '"}'
FROM t LEFT JOIN lv ON lv.conv_id = t.conv_id AND lv.turn = t.turn - 1 WHERE role = 'assistant'
UNION ALL
SELECT conv_id, turn, 'message', NULL, NULL, NULL, NULL,
  '{"content":' || content || ',"role":"' || role || '"}' FROM t WHERE role NOT IN ('user', 'assistant')
"""

_LEVEL = """
{name}_k AS (SELECT 1 / least(0.5, greatest(0.0001, coalesce(
    (sum(n * (bad / n - prior) * (bad / n - prior)) FILTER (n > 0) - sum(prior * (1 - prior)) FILTER (n > 0))
    / nullif(sum(prior * (1 - prior) * (n - 1)) FILTER (n > 0), 0), 0))) - 1 AS k FROM {name})"""

REPUTATION_SQL = (
    r"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    regexp_replace(html, '<[^>]*>', ' ', 'g') AS t, url, html FROM pages),
o AS (SELECT *, regexp_matches(concat_ws(' ', lower(url), lower(html)), 'adult|casino|pills|spam')
    OR 10 * len(regexp_extract_all(t, '[#*$%&|<>!]'))
    > len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS bad FROM p),
hosts AS (SELECT host, count(bad) AS n, count(*) FILTER (bad) AS bad,
    array_to_string(string_split(host, '.')[-2:], '.') AS domain,
    string_split(host, '.')[-1] AS suffix FROM o GROUP BY host),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad,
    (SELECT sum(bad) / sum(n) FROM hosts) AS prior FROM hosts GROUP BY suffix),"""
    + _LEVEL.format(name="suffixes")
    + """,
domains AS (SELECT h.domain, h.n, h.bad, (s.bad + k * s.prior) / (s.n + k) AS prior
  FROM (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1, 2) h
  JOIN suffixes s USING (suffix), suffixes_k),"""
    + _LEVEL.format(name="domains")
    + """,
units AS (SELECT h.host, h.n, h.bad, (d.bad + k * d.prior) / (d.n + k) AS prior
  FROM hosts h JOIN domains d USING (domain), domains_k),"""
    + _LEVEL.format(name="units")
    + """,
means AS (SELECT host, n, bad, (bad + k * prior) / (n + k) AS mean, n + k AS weight FROM units, units_k),
bounds AS (SELECT host, n, bad, greatest(0, mean - 1.96 * sqrt(mean * (1 - mean) / (weight + 1))) AS lower_bound
  FROM means),
r AS (SELECT page_id, host, path, n, bad, lower_bound,
  lower_bound > 2 * (SELECT sum(bad) / sum(n) FROM hosts) AS blocked, CASE
  WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p JOIN bounds USING (host))
SELECT page_id, host, path, rule, n, bad, lower_bound, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow' WHEN blocked THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
)

ORACLES: dict[str, str] = {
    "op1_decontamination": DECONTAMINATION_SQL,
    "op2_quality_rules": QUALITY_SQL,
    "op4_url_filters": REPUTATION_SQL,
    "op8_chat_formatting": CHAT_SQL,
} | CORPUS_ORACLES

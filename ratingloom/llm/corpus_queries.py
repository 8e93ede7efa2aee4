"""Queries over a whole corpus (search, manifest, vectors) and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import manifest, search, vectors
from ratingloom.llm.common import table

LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.search(docs, table(spark, sf_dir, "benchmark"), k=10)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tampered row has its text's A-Z lower-cased; its leaf is folded with the original witness."""
    docs = table(spark, sf_dir, "documents").select(*LEAF_FIELDS)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    fields: list[Column] = [lower if name == "text" else F.col(name) for name in LEAF_FIELDS]
    touched = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs = docs.withColumn("tampered", F.when(touched, manifest.leaf_hash(fields)))
    rows = manifest.manifest(docs, LEAF_FIELDS, group="source", order="doc_id", carry=["tampered"])
    found = rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(manifest.witness_text(F.col("witness")), 256).alias("proof_sha256"),
        manifest.folded(F.coalesce("tampered", "leaf"), F.col("witness")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), cosine=0.95)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op11_lexical_search": op11_lexical_search,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_vector_dedup": op13_vector_dedup,
}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SEARCH_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, row_number() OVER () AS q, {_WORDS} AS ws FROM benchmark),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_words FROM d WHERE len(ws) > 0),
iw AS (SELECT q, item_id, w, count(*) AS times FROM (SELECT q, item_id, unnest(ws) AS w FROM i) GROUP BY ALL),
tf AS (SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(ws) AS w FROM d)
  WHERE w IN (SELECT w FROM iw) GROUP BY ALL),
wt AS (SELECT w, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS wt
  FROM (SELECT w, count(*) AS df FROM tf GROUP BY w), s),
m AS (SELECT r, doc_id, 100 - 75 + (75 * len(ws) * n_docs) // n_words AS m FROM d, s WHERE len(ws) > 0),
sc AS (SELECT q, item_id, r, doc_id,
    CAST(sum(times * wt * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM iw JOIN tf USING (w) JOIN wt USING (w) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0)
WHERE rank <= 10
"""


def _framed(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _climb(tree: str, leaves: str) -> str:
    """Every node of the trees: grp, level, pos, digest and n, the nodes of its level."""
    return f"""{tree} AS (
  SELECT grp, 0 AS level, pos, digest, n FROM {leaves}
  UNION ALL
  SELECT grp, level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (n + 15) // 16
  FROM {tree} WHERE n > 1 GROUP BY grp, level, pos // 16, n)"""


def _fold(walk: str, start: str, tree: str) -> str:
    """From each start up to the root: the siblings passed, and the digest recomputed on the way."""
    return f"""{walk} AS (
  SELECT * FROM {start}
  UNION ALL
  SELECT f.r, f.doc_id, f.grp, f.level + 1, f.pos // 16, (f.n + 15) // 16,
    f.proof || coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos <> f.pos), ''),
    sha256(coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos < f.pos), '') || f.acc
      || coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos > f.pos), ''))
  FROM {walk} f JOIN {tree} t ON t.grp = f.grp AND t.level = f.level AND t.pos // 16 = f.pos // 16
  WHERE f.n > 1 GROUP BY f.r, f.doc_id, f.grp, f.level, f.pos, f.n, f.proof, f.acc)"""


_FIELDS = [_framed(f) for f in LEAF_FIELDS]
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# CRC-32 bit by bit: each byte of the decimal id is mixed in, then eight shifts (marked -1) follow.
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
    string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END),
  CAST(4294967295 AS BIGINT))"""

MANIFEST_SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS grp,
    sha256({' || '.join(_FIELDS)}) AS digest,
    CASE WHEN ({_CRC}) % 5 = 0 THEN sha256({' || '.join(_FIELDS[:-1])} || {_framed(_LOWERED)}) END AS tampered
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
  count(*) OVER (PARTITION BY grp) AS n FROM hashed),
{_climb('tree', 'leaves')},
subroots AS (SELECT '' AS grp, grp AS source, digest, row_number() OVER (ORDER BY grp) - 1 AS pos,
  count(*) OVER () AS n FROM tree WHERE n = 1),
{_climb('top', 'subroots')},
own AS (SELECT r, doc_id, grp, 0 AS level, pos, n, '' AS proof, coalesce(tampered, digest) AS acc FROM leaves),
{_fold('up', 'own', 'tree')},
joined AS (SELECT up.r, up.doc_id, '' AS grp, 0 AS level, s.pos, s.n, up.proof, up.acc
  FROM up JOIN subroots s ON s.source = up.grp WHERE up.n = 1),
{_fold('over', 'joined', 'top')}
SELECT leaves.doc_id, leaves.digest AS leaf, subroots.digest AS subroot, top.digest AS root,
  sha256(over.proof) AS proof_sha256, over.acc AS folded_root, over.acc = top.digest AS verified
FROM leaves JOIN subroots ON subroots.source = leaves.grp JOIN top ON top.n = 1
JOIN over ON over.r = leaves.r AND over.n = 1
"""

VECTOR_SQL = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
near AS (SELECT a.r, b.r AS other FROM usable a JOIN usable b ON a.r <> b.r
  AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= 0.95),
reached AS (SELECT r, r AS other FROM v
  UNION SELECT reached.r, near.other FROM reached JOIN near ON near.r = reached.other),
c AS (SELECT reached.r, min(o.vec_id) AS component_id FROM reached JOIN v o ON o.r = reached.other GROUP BY 1),
n AS (SELECT r, count(*) AS n_links FROM near GROUP BY r)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c USING (r) LEFT JOIN n USING (r)
"""

ORACLES: dict[str, str] = {
    "op11_lexical_search": SEARCH_SQL,
    "op12_merkle_manifest": MANIFEST_SQL,
    "op13_vector_dedup": VECTOR_SQL,
}

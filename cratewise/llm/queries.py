"""The operators as queries over the given tables, and SQL for those that it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cratewise.llm.archives import archived_pages
from cratewise.llm.centroids import lookup_clusters
from cratewise.llm.decontam import contamination
from cratewise.llm.line_dedup import drop_repeated_lines
from cratewise.llm.ngram_join import jaccard_components
from cratewise.llm.packing import pack
from cratewise.llm.pii import personal_data
from cratewise.llm.quality import quality
from cratewise.llm.secrets import find_secrets
from cratewise.llm.sharding import shard_documents
from cratewise.llm.token_counts import count_tokens
from cratewise.llm.toxicity import fit, score_toxicity
from cratewise.llm.turns import repaired_conversations

VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_hilbert(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(_table(spark, folder, "documents"))


def op2_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeated_lines(_table(spark, folder, "documents")).select("doc_id", "lines", "lines_gone", "text")


def op3_wu_manber(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op4_block_max(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return score_toxicity(docs, fit(docs, _table(spark, folder, "labels")))


def op5_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(_table(spark, folder, "documents"))


def op6_markov(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(_table(spark, folder, "documents"))


def op7_contexts(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(_table(spark, folder, "documents"))


def op8_weak_votes(spark: SparkSession, folder: str) -> DataFrame:
    return quality(_table(spark, folder, "documents"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = count_tokens(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))
    return counts.withColumn("over_limit", counts["n_tokens"] > 2048)


def op10_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op11_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return lookup_clusters(_table(spark, folder, "embeddings"))


def op12_auction(spark: SparkSession, folder: str) -> DataFrame:
    return repaired_conversations(_table(spark, folder, "conversations"))


def op13_zip(spark: SparkSession, folder: str) -> DataFrame:
    return archived_pages(_table(spark, folder, "pages"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_hilbert, op2_winnowing, op3_wu_manber, op4_block_max, op5_ngram_jaccard, op6_markov, op7_contexts, op8_weak_votes,
        op9_token_counts, op10_best_fit, op11_lookup, op12_auction, op13_zip,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW_TEXT = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORDS = r"[^\x20\x09-\x0D]+"

OP3_SQL = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all({_LOW_TEXT}, '{_LETTERS}') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all({_LOW_TEXT}, '{_LETTERS}') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS m FROM item WHERE len(w) > 0),
pattern AS (SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS s FROM sized)),
place AS (SELECT doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') AS gram
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM doc, (SELECT DISTINCT m FROM sized) WHERE len(w) >= m)),
found AS (SELECT doc_id, m, s, item_id FROM place JOIN pattern USING (m, gram)),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + m)) AS at FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

OP5_SQL = rf"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_LOW_TEXT}, '{_WORDS}') AS w FROM documents),
gram AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[s:s + 4], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM doc WHERE len(w) > 0)),
sized AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
both_have AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM gram x JOIN gram y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_have JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least_id AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a),
copy_count AS (SELECT doc_id, count(*) OVER (PARTITION BY grams) AS copies FROM (SELECT doc_id, list(g ORDER BY g) AS grams FROM gram GROUP BY doc_id))
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(copies, 1) AS BIGINT) AS copies
FROM doc JOIN least_id USING (doc_id) LEFT JOIN sized USING (doc_id) LEFT JOIN copy_count USING (doc_id)"""

OP2_SQL = r"""
WITH line AS (SELECT doc_id, i - 1 AS line, content, len(regexp_extract_all(content, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS content, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
placed AS (SELECT *, CAST(sum(words) OVER (PARTITION BY doc_id ORDER BY line) AS BIGINT) AS upto FROM line WHERE words > 0),
ahead AS (SELECT doc_id, min(line) OVER f AS a, max(line) OVER f AS b, sum(words) OVER f AS n, list(content) OVER f AS run
  FROM (SELECT *, upto - words AS before FROM placed)
  WINDOW f AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 24 FOLLOWING)),
behind AS (SELECT doc_id, min(line) OVER f AS a, max(line) OVER f AS b, sum(words) OVER f AS n, list(content) OVER f AS run
  FROM placed WINDOW f AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 24 PRECEDING AND CURRENT ROW)),
run AS (SELECT DISTINCT doc_id, a, b, run FROM (SELECT * FROM ahead UNION ALL SELECT * FROM behind) WHERE n >= 25),
later AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, a) AS nth FROM run),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS line FROM later WHERE nth > 1),
kept AS (SELECT doc_id, count(*) AS lines, count(*) FILTER (gone.line IS NOT NULL) AS lines_gone,
  string_agg(content, chr(10) ORDER BY line.line) FILTER (gone.line IS NULL) AS text FROM line LEFT JOIN gone USING (doc_id, line) GROUP BY doc_id)
SELECT doc_id, lines, lines_gone, coalesce(text, '') AS text FROM kept"""

OP13_SQL = """
SELECT page_id, payload_bytes, payload_digest, CASE WHEN nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN nth > 1 THEN lead_id END AS refers_to
FROM (SELECT page_id, size AS payload_bytes, sha256(payload) AS payload_digest,
    CASE WHEN size >= 100 THEN row_number() OVER same ELSE 1 END AS nth, first_value(page_id) OVER same AS lead_id
  FROM (SELECT page_id, coalesce(html, '') AS payload, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS size FROM pages)
  WINDOW same AS (PARTITION BY payload ORDER BY page_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""

_ROUND = """
near{i} AS MATERIALIZED (SELECT r, c, s FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY s, c) AS nth
  FROM (SELECT r, c, CAST(sum((cell.x - mid{i}.x) * (cell.x - mid{i}.x)) AS BIGINT) AS s FROM cell JOIN mid{i} USING (d) GROUP BY r, c)) WHERE nth = 1)"""
_MOVE = """,
mid{j} AS MATERIALIZED (SELECT c, d, coalesce(y, x) AS x FROM mid{i} LEFT JOIN (
  SELECT c, d, CAST((total - ((total % n) + n) % n) // n AS BIGINT) AS y FROM (
    SELECT c, d, CAST(sum(x) AS BIGINT) AS total, count(*) AS n FROM cell JOIN near{i} USING (r) GROUP BY c, d)) USING (c, d)),"""
OP11_SQL = (
    """
WITH part AS MATERIALIZED (SELECT r, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d
  FROM (SELECT vec_id, embedding, row_number() OVER () AS r FROM embeddings)),
kept AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id FROM part GROUP BY r HAVING count(*) = 64 AND count(x) = 64 AND bool_and(isfinite(x))),
cell AS MATERIALIZED (SELECT r, d, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM part JOIN kept USING (r)),
named AS MATERIALIZED (SELECT r, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR))) AS c FROM kept),
mid0 AS MATERIALIZED (SELECT c, d, x FROM named JOIN cell USING (r) WHERE c <= 40),"""
    + "".join(_ROUND.format(i=i) + _MOVE.format(i=i, j=i + 1) for i in range(5)) + _ROUND.format(i=5) + """
SELECT vec_id, CAST(c - 1 AS INTEGER) AS cluster, s AS distance, CAST(sum(s) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(s) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near5 JOIN kept USING (r) JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM mid5 GROUP BY c) USING (c)"""
)

ORACLES: dict[str, str] = {
    "op11_lookup": OP11_SQL, "op13_zip": OP13_SQL,
    "op2_winnowing": OP2_SQL, "op3_wu_manber": OP3_SQL, "op5_ngram_jaccard": OP5_SQL,
}

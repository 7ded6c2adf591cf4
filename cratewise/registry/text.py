"""Text functions over documents, comments, names and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratewise.functions import text as tx
from cratewise.functions.html import unescape_html
from cratewise.functions.labels import track_label
from cratewise.operators import explode as ex
from cratewise.registry.base import (
    COMMENT, WS, comments, query, s_clean, s_html, s_links, s_name_tokens, s_punct, s_strip, s_tokens,
)
from cratewise.session import spread

# All long texts and all made comments: (kind, id, text).
TEXTS_SQL = f"""SELECT 'doc' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'turn', conv_id * 1000 + turn, text FROM conversations
  UNION ALL SELECT 'part', p_partkey, {COMMENT} FROM part"""


def texts(t):
    docs = spread(t.documents).select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), "text")
    turns = t.conversations.select(F.lit("turn").alias("kind"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    parts = comments(t).select(F.lit("part").alias("kind"), F.col("comment_id").alias("id"), F.col("raw_comment").alias("text"))
    return docs.unionByName(turns).unionByName(parts)


def _mapped(name, function, sql):
    query(name, f"SELECT kind, id, {sql('text')} AS result FROM ({TEXTS_SQL}) t")(
        lambda t: texts(t).select("kind", "id", function("text").alias("result"))
    )


_mapped("clean_text", tx.clean_comment, s_clean)
_mapped("remove_links", tx.remove_links, s_links)
_mapped("clean_punctuation", tx.clean_punctuation, s_punct)

query("html_unescape", f"SELECT page_id, {s_html('html')} AS decoded FROM pages")(
    lambda t: spread(t.pages).select("page_id", unescape_html("html").alias("decoded"))
)

NAME = "'  ' || p_name || '   (' || p_type || ') &amp; ' || p_brand || ' http://x.io/' || p_name"

query("name_tokens", f"""SELECT p_partkey, {s_name_tokens(NAME)} AS part_tokens, NULL AS lang, 'part' AS kind FROM part
  UNION ALL SELECT doc_id, {s_name_tokens('text')}, lang, 'doc' FROM documents""")(
    lambda t: t.part.select("p_partkey", tx.name_tokens(F.expr(NAME)).alias("part_tokens"),
                            F.lit(None).cast("string").alias("lang"), F.lit("part").alias("kind"))
    .union(spread(t.documents).select("doc_id", tx.name_tokens("text"), "lang", F.lit("doc")))
)

query("tokenize", f"""SELECT kind, id, CAST(len(w) AS BIGINT) AS n, array_to_string(w, '|') AS tokens
  FROM (SELECT kind, id, {s_tokens('text')} AS w FROM ({TEXTS_SQL}) t) x""")(
    lambda t: texts(t).withColumn("w", tx.tokenize("text")).select(
        "kind", "id", F.size("w").cast("long").alias("n"), F.array_join("w", "|").alias("tokens"))
)

# The stored text form is written from the tokens and read back; beside it a
# broken list per document, which reads as empty.
query("parse_tokens", f"""SELECT doc_id, CAST(len(w) AS BIGINT) AS n, array_to_string(w, '|') AS tokens, CAST(0 AS BIGINT) AS n_broken
  FROM (SELECT doc_id, {s_tokens(s_clean('text'))} AS w FROM documents) x""")(
    lambda t: spread(t.documents).select(
        "doc_id",
        tx.parse_tokens(tx.format_tokens(tx.tokenize(tx.clean_comment("text"), clean=True))).alias("w"),
        tx.parse_tokens(F.concat(F.lit("['"), "lang")).alias("broken"),
    ).select(
        "doc_id", F.size("w").cast("long").alias("n"), F.array_join("w", "|").alias("tokens"),
        F.size("broken").cast("long").alias("n_broken"))
)

FLAIR = "'[FRESH ' || p_brand || ']   ' || p_name || ' [' || p_type || '] '"

query("strip_flair", f"""SELECT p_partkey, {s_strip(f"regexp_replace({FLAIR}, '^\\[.*?\\][{WS}]*', '')")} AS title FROM part""")(
    lambda t: t.part.select("p_partkey", tx.strip_flair(F.expr(FLAIR)).alias("title"))
)

query("split_comments", f"""SELECT kind, id, i - 1 AS part_pos, part FROM (
    SELECT kind, id, unnest(parts) AS part, CAST(generate_subscripts(parts, 1) AS INTEGER) AS i FROM (
      SELECT kind, id, list_filter(list_transform(
        regexp_split_to_array(regexp_replace(text, '(\\))[{WS}]+([A-Z])', '\\1\n\\2', 'g'), '\n+'),
        lambda p: {s_strip('p')}), lambda p: p <> '') AS parts
      FROM ({TEXTS_SQL}) t) a) b""")(
    lambda t: ex.explode_parts(texts(t), "text").withColumnRenamed("text", "part").select("kind", "id", "part_pos", "part")
)

query("track_label", """SELECT p_partkey, CASE WHEN length(p_name || ' ' || p_type || ' edition') > 22
    THEN substr(p_name || ' ' || p_type || ' edition', 1, 22) || '…' ELSE p_name || ' ' || p_type || ' edition' END
  || chr(10) || '(' || p_brand || ')' AS label FROM part""")(
    lambda t: t.part.select(
        "p_partkey", track_label(F.concat_ws(" ", "p_name", "p_type", F.lit("edition")), "p_brand").alias("label"))
)

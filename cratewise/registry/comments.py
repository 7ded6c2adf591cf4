"""Cleaning, generation, classification, extraction and sentiment of comments."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratewise import schemas
from cratewise.functions.nlp import CONTRAST_MARKERS, with_classification, with_entities
from cratewise.functions.once import with_once
from cratewise.functions.sentiment import lookup_valence, score_sentiment, sentiment_label
from cratewise.functions.text import WORD, WS, clean_comment, tokenize
from cratewise.operators import clean as cl
from cratewise.operators import dedup as dd
from cratewise.operators import explode as ex
from cratewise.operators import metrics as m
from cratewise.operators.quality import enforce_schema
from cratewise.operators.report import Steps
from cratewise.plans.comments import silver_comments
from cratewise.registry.base import (
    COMMENT, COMMENTS_SQL, COMPUTED_AT, DOC_STAMP, comments, query, s_clean, s_round, s_strip, s_tokens, s_words,
)
from cratewise.registry.text import TEXTS_SQL, texts
from cratewise.schemas import BOOL, DOUBLE, LONG, STRING, StructField, StructType
from cratewise.session import materialize, spread, work_path
from cratewise.sources.published import publish, read_published

# --- null words, coercion, filters ---------------------------------------------------

RAW_POST = f"""p_partkey AS id,
  CASE p_partkey % 7 WHEN 0 THEN ' NULL ' WHEN 1 THEN 'None' WHEN 2 THEN '' ELSE p_brand END AS title,
  {COMMENT} AS comment,
  CASE p_partkey % 5 WHEN 0 THEN CAST(p_size AS STRING) || '.7' WHEN 1 THEN '' WHEN 2 THEN 'abc'
    WHEN 3 THEN NULL ELSE CAST(p_size AS STRING) END AS score"""
NULL_WORDS = "('null', 'none', 'nan', '', '[deleted]', '[removed]')"


def raw_posts(t):
    return t.part.selectExpr(*RAW_POST_COLUMNS)


# The same four columns as separate expressions for Spark.
RAW_POST_COLUMNS = [
    "p_partkey AS id",
    "CASE p_partkey % 7 WHEN 0 THEN ' NULL ' WHEN 1 THEN 'None' WHEN 2 THEN '' ELSE p_brand END AS title",
    f"{COMMENT} AS comment",
    "CASE p_partkey % 5 WHEN 0 THEN CAST(p_size AS STRING) || '.7' WHEN 1 THEN '' WHEN 2 THEN 'abc' "
    "WHEN 3 THEN NULL ELSE CAST(p_size AS STRING) END AS score",
]


def s_null(c):
    return f"CASE WHEN lower({s_strip(c)}) IN {NULL_WORDS} THEN NULL ELSE {c} END"


query("normalize_nulls", f"""SELECT id, {s_null('title')} AS title, {s_null('comment')} AS comment,
  {s_null('score')} AS score FROM (SELECT {RAW_POST} FROM part) p""")(
    lambda t: cl.normalize_nulls(raw_posts(t))
)

query("require_fields", f"""SELECT id, title, comment FROM (SELECT id, {s_null('title')} AS title,
  {s_null('comment')} AS comment FROM (SELECT {RAW_POST} FROM part) p) q
  WHERE title IS NOT NULL AND comment IS NOT NULL""")(
    lambda t: cl.require(cl.normalize_nulls(raw_posts(t)), ["title", "comment"]).select("id", "title", "comment")
)

query("coerce_score", f"""SELECT id, CAST(trunc(coalesce(TRY_CAST(score AS DOUBLE), 0)) AS BIGINT) AS score
  FROM (SELECT {RAW_POST} FROM part) p""")(
    lambda t: raw_posts(t).select("id", cl.coerce_score("score").alias("score"))
)

BLANK = f"CASE WHEN p_partkey % 4 = 0 THEN '  ' || chr(9) || chr(10) WHEN p_partkey % 4 = 1 THEN NULL ELSE {COMMENT} END"
query("blank_filter", f"""SELECT p_partkey, raw_comment FROM (SELECT p_partkey, {BLANK} AS raw_comment FROM part) p
  WHERE raw_comment IS NOT NULL AND {s_strip('raw_comment')} <> ''""")(
    lambda t: cl.drop_blank(t.part.select("p_partkey", F.expr(BLANK).alias("raw_comment")), "raw_comment")
)

HIT = " OR ".join(f"contains(lower(text), '{k}')" for k in cl.REACTION_KEYWORDS)
query("keyword_filter", f"SELECT kind, id, ({HIT}) AS is_reaction FROM ({TEXTS_SQL}) t")(
    lambda t: texts(t).select("kind", "id", cl.is_reaction("text").alias("is_reaction"))
)

# --- row generation ------------------------------------------------------------------

# A post per part; its comments hold a made one, a blank, a two-line one and a null.
POSTS_SQL = f"""SELECT p_brand AS file, p_partkey AS post_id, p_brand AS title, p_size AS score,
  [{COMMENT}, ' ', p_type || chr(10) || p_name, NULL] AS comments FROM part"""


def posts(t):
    return t.part.select(
        F.col("p_brand").alias("file"), F.col("p_partkey").alias("post_id"), F.col("p_brand").alias("title"),
        F.col("p_size").alias("score"),
        F.array(F.expr(COMMENT), F.lit(" "), F.expr("p_type || chr(10) || p_name"), F.lit(None)).alias("comments"),
    )


EXPLODED_SQL = f"""SELECT file, post_id, title, CAST(i - 1 AS INTEGER) AS comment_pos, raw_comment,
    row_number() OVER (ORDER BY post_id, i) - 1 AS raw_comment_id
  FROM (SELECT file, post_id, title, unnest(comments) AS raw_comment, generate_subscripts(comments, 1) AS i
    FROM ({POSTS_SQL}) p) e WHERE raw_comment IS NOT NULL AND {s_strip('raw_comment')} <> ''"""


def exploded(t):
    return ex.number_comments(posts(t))


query("explode_comments", EXPLODED_SQL)(
    lambda t: exploded(t).select("file", "post_id", "title", "comment_pos", "raw_comment", "raw_comment_id")
)

PARTS_SQL = f"""SELECT title, raw_comment_id, i - 1 AS part_pos, {s_clean('part')} AS clean_comment FROM (
  SELECT title, raw_comment_id, unnest(parts) AS part, CAST(generate_subscripts(parts, 1) AS INTEGER) AS i FROM (
    SELECT title, raw_comment_id, list_filter(list_transform(
      regexp_split_to_array(regexp_replace(raw_comment, '(\\))[{WS}]+([A-Z])', '\\1\n\\2', 'g'), '\n+'),
      lambda p: {s_strip('p')}), lambda p: p <> '') AS parts FROM ({EXPLODED_SQL}) e) a) b"""


@query("dedup_comments", f"""SELECT 'per title' AS rule, title, clean_comment, min_by(raw_comment_id, raw_comment_id * 100 + part_pos) AS raw_comment_id,
    min_by(part_pos, raw_comment_id * 100 + part_pos) AS part_pos FROM ({PARTS_SQL}) x GROUP BY title, clean_comment
  UNION ALL SELECT 'overall', min_by(title, raw_comment_id * 100 + part_pos), clean_comment, min(raw_comment_id),
    min_by(part_pos, raw_comment_id * 100 + part_pos) FROM ({PARTS_SQL}) x GROUP BY clean_comment""")
def dedup_comments(t):
    parts = ex.explode_parts(exploded(t), "raw_comment").select(
        "title", "raw_comment_id", "part_pos", clean_comment("raw_comment").alias("clean_comment")
    )
    order = ["raw_comment_id", "part_pos"]

    def first(rule, keys):
        kept = dd.dedup_first(parts, keys, order)
        return kept.select(F.lit(rule).alias("rule"), "title", "clean_comment", "raw_comment_id", "part_pos")

    return first("per title", ["title", "clean_comment"]).unionByName(first("overall", ["clean_comment"]))


# --- classification and extraction -----------------------------------------------------

MARKERS = ", ".join(f"'{w}'" for w in CONTRAST_MARKERS)
S_DASH = f"^[{WS}]*([^\\n]+?)[{WS}]*-[{WS}]*([^\\n]+?)[{WS}]*$"
S_BY = f"^[{WS}]*([^\\n]+?)[{WS}]+by[{WS}]+([^\\n]+?)[{WS}]*$"
S_COLON = f"^[{WS}]*([^\\n]+?)[{WS}]*:[{WS}]*([^\\n]+?)[{WS}]*$"


# The comment job reports what each of its steps let through; it publishes only if no required field is null.
@query("comment_run_report", f"""WITH parts AS (SELECT * FROM ({PARTS_SQL}) x), found AS (
    SELECT 0 AS step, 'comments' AS name, (SELECT count(*) FROM ({EXPLODED_SQL}) e) AS n
    UNION ALL SELECT 1, 'parts', (SELECT count(*) FROM parts)
    UNION ALL SELECT 2, 'unique', (SELECT count(*) FROM (SELECT DISTINCT title, clean_comment FROM parts) u)
    UNION ALL SELECT 3, 'kept', (SELECT count(*) FROM (SELECT DISTINCT title, clean_comment FROM parts WHERE {s_strip('clean_comment')} <> '') k)
    UNION ALL SELECT 4, 'published', (SELECT count(*) FROM (SELECT DISTINCT title, clean_comment FROM parts WHERE {s_strip('clean_comment')} <> '') k))
  SELECT CAST(step AS INTEGER) AS step, name, n AS "rows", CAST(coalesce(lag(n) OVER (ORDER BY step) - n, 0) AS BIGINT) AS removed, CAST(0 AS BIGINT) AS nulls
  FROM found""")
def comment_run_report(t):
    steps, folder = Steps(), work_path(t.spark, "comments-published")
    silver = silver_comments(posts(t).withColumn("file_stamp", F.lit("20240301_000000")), COMPUTED_AT, steps=steps)

    def gate(counts):
        nulls = [c for c, n in counts.items() if c.startswith("nulls_") and n]
        return f"null in {nulls}" if nulls or not counts["rows_out"] else None

    publish(silver, folder, F.left("ingested_at", F.lit(10)), lambda df: df, gate, required=schemas.required(schemas.COMMENTS))
    steps.see("published", read_published(t.spark, folder, schemas.COMMENTS), ["title"]).write.format("noop").mode("overwrite").save()
    return steps.report(t.spark)


def s_group(x, pattern, g, flags=""):
    return f"regexp_extract({x}, '{flags}{pattern}', {g})"


def s_fits(x, pattern, left, right):
    return (
        f"regexp_matches({x}, '{pattern}') AND {s_words(s_group(x, pattern, 1))} <= {left} "
        f"AND {s_words(s_group(x, pattern, 2))} <= {right}"
    )


def classified_sql(source):
    """``source`` yields (kind, id, text); adds the classification columns."""
    return f"""SELECT *, CASE WHEN p AND o THEN 'mixed' WHEN p THEN 'recommendation' WHEN o THEN 'opinion' ELSE 'other' END AS comment_type,
    CASE WHEN word_count = 0 THEN 0.0 ELSE greatest(0, least(100,
      CASE WHEN p THEN 45 ELSE 0 END
      + CASE WHEN word_count <= 5 THEN 25 WHEN word_count <= 10 THEN 15 WHEN word_count > 20 THEN -15 ELSE 0 END
      + CASE WHEN has_contrast THEN -20 ELSE 0 END + CASE WHEN p AND o THEN -10 ELSE 0 END
      + CASE WHEN len(regexp_extract_all(c, '[^{WORD}{WS}]')) > 5 THEN -10 ELSE 0 END
      + CASE WHEN word_count < 2 THEN -20 ELSE 0 END)) / 100.0 END AS confidence
  FROM (SELECT *, pattern_type IS NOT NULL AS p, has_contrast OR word_count > 6 AS o FROM (
    SELECT *, CAST(len(w) AS BIGINT) AS word_count, list_has_any(w, [{MARKERS}]) AS has_contrast,
      CASE WHEN {s_fits('c', S_DASH, 8, 8)} THEN 'dash' WHEN {s_fits('c', S_BY, 10, 5)} THEN 'by'
        WHEN {s_fits('c', S_COLON, 5, 10)} THEN 'colon' END AS pattern_type
    FROM (SELECT *, {s_tokens('c')} AS w FROM (SELECT *, lower({s_strip('text')}) AS c FROM ({source}) s) s1) s2) s3) s4"""


CLASS_COLUMNS = "kind, id, word_count, has_contrast, pattern_type, p AS has_music_pattern, comment_type, CAST(confidence AS DOUBLE) AS confidence"


@query("classify_comment", f"SELECT {CLASS_COLUMNS} FROM ({classified_sql(TEXTS_SQL)}) x")
def classify_comment(t):
    return with_classification(texts(t), "text").select(
        "kind", "id", "word_count", "has_contrast", "pattern_type", "has_music_pattern", "comment_type", "confidence"
    )


def extracted_sql(source, bounded=False):
    x = s_strip("text")
    dash, by, colon = ([s_group("x", p, g) for g in (1, 2)] for p in (S_DASH, S_BY.replace("by", "[bB][yY]"), S_COLON))
    by_max, colon_max = (9, 10) if bounded else (7, 8)

    def between(words, high):
        return f"CASE WHEN {s_words(words)} BETWEEN 1 AND {high} THEN 2 ELSE 0 END"

    dash_points = (
        f"2 + {between(dash[0], 4)} + {between(dash[1], 6)} "
        f"+ CASE WHEN length({dash[0]}) < 40 AND length({dash[1]}) < 60 THEN 2 ELSE 0 END"
    )
    by_points = (
        f"3 + {between(by[1], 4)} + {between(by[0], 8)} "
        f"+ CASE WHEN length({by[0]}) < 80 AND length({by[1]}) < 40 THEN 2 ELSE 0 END"
    )
    colon_points = (
        f"3 + {between(colon[0], 4)} + {between(colon[1], 8)} "
        f"+ CASE WHEN {colon[0]} = lower({colon[0]}) AND regexp_matches({colon[0]}, '\\p{{Ll}}') THEN 0 ELSE 1 END "
        f"+ CASE WHEN length({colon[1]}) < 80 THEN 2 ELSE 0 END"
    )
    return f"""SELECT *, CASE pattern_type WHEN 'dash' THEN CASE WHEN points >= 6 THEN {dash[0]} END
        WHEN 'by' THEN {by[1]} WHEN 'colon' THEN {colon[0]} END AS artist,
      CASE pattern_type WHEN 'dash' THEN CASE WHEN points >= 6 THEN {dash[1]} END
        WHEN 'by' THEN {by[0]} WHEN 'colon' THEN {colon[1]} END AS song,
      round(coalesce(points / CASE pattern_type WHEN 'dash' THEN 8.0 WHEN 'by' THEN {by_max}.0 ELSE {colon_max}.0 END, 0.0), 2) AS extract_confidence
    FROM (SELECT *, CASE pattern_type WHEN 'dash' THEN {dash_points} WHEN 'by' THEN {by_points}
        WHEN 'colon' THEN {colon_points} END AS points
      FROM (SELECT *, {x} AS x FROM ({source}) s5) s6) s7"""


def _entity_sql(bounded):
    return f"""SELECT {bounded} AS bounded, kind, id, pattern_type, artist, song, CAST(extract_confidence AS DOUBLE) AS extract_confidence
      FROM ({extracted_sql(classified_sql(TEXTS_SQL), bounded)}) y"""


@query("extract_entities", f"{_entity_sql(False)} UNION ALL {_entity_sql(True)}")
def extract_entities(t):
    marked = with_classification(texts(t), "text")

    def found(bounded):
        return with_entities(marked, "text", bounded=bounded).select(
            F.lit(bounded).alias("bounded"), "kind", "id", "pattern_type", "artist", "song", "extract_confidence"
        )

    return found(False).unionByName(found(True))


# --- sentiment -----------------------------------------------------------------------

# A lexicon of words that the given tables contain.
LEXICON = {
    "hot": 1.9, "cold": -1.5, "red": 1.1, "blue": -0.7, "economy": -1.2, "promo": 2.0, "standard": 0.4,
    "the": 0.3, "of": -0.2, "und": 0.8, "des": -0.5, "with": 1.2, "was": -2.1, "que": 0.9, "more": 1.5,
}
BOOSTERS = {"gear": 0.293, "bolt": -0.293, "and": 0.293, "la": -0.293}
NEGATIONS = ["by", "not", "widget", "a", "der", "is"]


def _values(pairs):
    return "(VALUES " + ", ".join(pairs) + ")"


LEX_SQL = _values(f"('{w}', CAST({v} AS DOUBLE))" for w, v in LEXICON.items())
BOOST_SQL = _values(f"('{w}', CAST({v} AS DOUBLE))" for w, v in BOOSTERS.items())
NEG_SQL = "(" + ", ".join(f"'{w}'" for w in NEGATIONS) + ")"


def compound_sql(source, key="id"):
    """``source`` yields (key, clean); gives (key, compound) of every row."""
    steps = "l.v"
    for k, damping in ((1, 1.0), (2, 0.95), (3, 0.9)):
        idle = f"(p{k} IS NULL OR l{k}.t IS NOT NULL)"
        steps = f"({steps} + CASE WHEN {idle} THEN 0.0 ELSE coalesce(b{k}.s, 0.0) * CAST({damping} AS DOUBLE) * sign(l.v) END)"
        steps = f"({steps} * CASE WHEN {idle} OR p{k} NOT IN {NEG_SQL} THEN CAST(1 AS DOUBLE) ELSE CAST(-0.74 AS DOUBLE) END)"
    joins = " ".join(
        f"LEFT JOIN {LEX_SQL} l{k}(t, v) ON l{k}.t = n.p{k} LEFT JOIN {BOOST_SQL} b{k}(t, s) ON b{k}.t = n.p{k}"
        for k in (1, 2, 3)
    )
    return f"""SELECT src.{key}, round(coalesce(x / sqrt(x * x + 15), 0.0), 4) AS compound FROM ({source}) src LEFT JOIN (
      SELECT {key}, sum(val * CASE WHEN b = 0 OR i = b THEN 1.0 WHEN i < b THEN 0.5 ELSE 1.5 END) AS x FROM (
        SELECT n.{key}, n.i, n.b, {steps} AS val FROM (
          SELECT *, lag(t, 1) OVER w AS p1, lag(t, 2) OVER w AS p2, lag(t, 3) OVER w AS p3,
            coalesce(min(CASE WHEN t = 'but' THEN i END) OVER (PARTITION BY {key}), 0) AS b
          FROM (SELECT {key}, unnest(ws) AS t, generate_subscripts(ws, 1) AS i
            FROM (SELECT {key}, {s_tokens('clean')} AS ws FROM ({source}) s) s1) s2
          WINDOW w AS (PARTITION BY {key} ORDER BY i)) n
        JOIN {LEX_SQL} l(t, v) ON l.t = n.t {joins}) s3 GROUP BY {key}) s4 ON s4.{key} = src.{key}"""


def lexicon(t):
    return t.spark.createDataFrame(list(LEXICON.items()), "token string, valence double")


def with_tokens(df, text="text"):
    cleaned = with_once(df, clean=clean_comment(text))
    return with_once(cleaned, tokens=tokenize("clean", clean=True))


def scored(t, df, text="text"):
    return score_sentiment(with_tokens(df, text), "tokens", lexicon(t), NEGATIONS, BOOSTERS)


ALL_SQL = f"SELECT kind || CAST(id AS VARCHAR) AS id, {s_clean('text')} AS clean FROM ({TEXTS_SQL}) t"


def all_texts(t):
    return texts(t).select(F.concat("kind", F.col("id").cast("string")).alias("id"), "text")


query("sentiment_score", compound_sql(ALL_SQL))(
    lambda t: scored(t, all_texts(t)).select("id", "compound")
)
query("sentiment_score_by_join", compound_sql(ALL_SQL))(
    lambda t: scored(t, all_texts(t)).select("id", "compound")
)

query("lexicon_lookup", f"""SELECT id, t AS token, v AS valence, count(*) AS n FROM (
    SELECT id, unnest({s_tokens('clean')}) AS t FROM ({ALL_SQL}) a) b JOIN {LEX_SQL} l(w, v) ON l.w = b.t
  GROUP BY id, t, v""")(
    lambda t: lookup_valence(
        ex.explode_tokens(with_tokens(all_texts(t)).select("id", "tokens"), "tokens", "token").drop("tokens"),
        lexicon(t),
    ).groupBy("id", "token", "valence").agg(F.count("*").alias("n"))
)

LABEL = "CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END"
query("sentiment_label", f"SELECT id, {LABEL} AS sentiment FROM ({compound_sql(ALL_SQL)}) x")(
    lambda t: scored(t, all_texts(t)).select("id", sentiment_label("compound").alias("sentiment"))
)

# --- the annotated comment table behind the metrics --------------------------------------

# Documents and part comments as one annotated table: id, day stamp, tokens,
# type, confidence, artist, compound, sentiment.
STAMPED_SQL = f"""SELECT 'doc' || CAST(doc_id AS VARCHAR) AS id, 'doc' AS kind, {DOC_STAMP} AS ingested_at, {s_clean('text')} AS text FROM documents
  UNION ALL SELECT 'part' || CAST(comment_id AS VARCHAR), 'part', ingested_at, {s_clean('raw_comment')} FROM ({COMMENTS_SQL}) c"""
ANNOTATED_SQL = f"""SELECT a.*, compound, {LABEL} AS sentiment FROM ({extracted_sql(classified_sql(STAMPED_SQL))}) a
  JOIN ({compound_sql(f"SELECT id, text AS clean FROM ({STAMPED_SQL}) st")}) c ON c.id = a.id"""


def stamped(t):
    docs = spread(t.documents).select(
        F.concat(F.lit("doc"), "doc_id").alias("id"), F.expr(DOC_STAMP).alias("ingested_at"), "text"
    )
    parts = comments(t).select(
        F.concat(F.lit("part"), "comment_id").alias("id"), "ingested_at", F.col("raw_comment").alias("text")
    )
    return docs.unionByName(parts)


def ready(t):
    """The scored comments as the metrics get them: written once, narrow."""
    return materialize(rated(t).select("ingested_at", "tokens", "compound", "sentiment"), "rated")


def classified(t):
    return with_classification(with_tokens(stamped(t)), "clean", "tokens")


def rated(t):
    return scored(t, stamped(t)).withColumn("sentiment", sentiment_label("compound"))


def annotated(t):
    rows = with_classification(scored(t, stamped(t)), "clean", "tokens")
    return with_entities(rows, "clean").withColumn("sentiment", sentiment_label("compound"))


def metric_sql(kind, dim1, dim2, count, pct, score, date, source):
    return f"""SELECT '{kind}' AS metric_type, CAST({dim1} AS VARCHAR) AS dim1, {dim2} AS dim2, CAST({count} AS BIGINT) AS record_count,
      {s_round(pct, 2)} AS pct, {s_round(score)} AS avg_score, CAST({date} AS VARCHAR) AS data_date,
      '{COMPUTED_AT}' AS computed_at FROM {source}"""


LATEST = f"(SELECT max(ingested_at)[1:10] FROM ({STAMPED_SQL}) st2)"


def _dist_sql(kind, column, score):
    groups = f"(SELECT {column} AS g, count(*) AS cnt, avg({score}) AS s, count(*) / sum(count(*)) OVER () * 100 AS pct FROM ({ANNOTATED_SQL}) an GROUP BY {column}) gr"
    return metric_sql(kind, "g", "'community'", "cnt", "pct", "s", LATEST, groups)


query("sentiment_dist", _dist_sql("sentiment_dist", "sentiment", "compound"))(
    lambda t: m.sentiment_dist(rated(t), "community", COMPUTED_AT)
)
query("comment_type_dist", _dist_sql("comment_type_dist", "comment_type", "confidence"))(
    lambda t: m.comment_type_dist(classified(t), "community", COMPUTED_AT)
)


def _trend_sql(date):
    groups = f"(SELECT {date} AS d, count(*) AS cnt, avg(compound) AS s FROM ({ANNOTATED_SQL}) an GROUP BY 1) gr"
    return metric_sql("sentiment_trend", "d", "'community'", "cnt", "0", "s", "d", groups)


DAY = "CAST(ingested_at[1:10] AS DATE)"


@query("sentiment_trend", f"""SELECT 'day' AS grain, * FROM ({_trend_sql(DAY)}) a
  UNION ALL SELECT 'week', * FROM ({_trend_sql(f"CAST(date_trunc('week', {DAY}) AS DATE)")}) b""")
def sentiment_trend(t):
    rows = ready(t)
    by = [m.sentiment_trend(rows, "community", COMPUTED_AT, grain).select(F.lit(grain).alias("grain"), "*") for grain in ("day", "week")]
    return m.union_rows(*by)


def _top_sql(kind, tokens, k):
    groups = f"""(SELECT *, cnt / sum(cnt) OVER () * 100 AS pct FROM (SELECT g, count(*) AS cnt, avg(compound) AS s
      FROM ({tokens}) tk GROUP BY g ORDER BY cnt DESC, g LIMIT {k}) lim) gr"""
    return metric_sql(kind, "g", "'community'", "cnt", "pct", "s", LATEST, groups)


STOP_SQL = ", ".join(f"'{w}'" for w in m.STOP_WORDS)
KEYWORDS_SQL = f"""SELECT g, compound FROM (SELECT unnest(w) AS g, compound FROM ({ANNOTATED_SQL}) an) un
  WHERE length(g) > 2 AND g NOT IN ({STOP_SQL})"""
TOP_KEYWORDS_SQL = _top_sql("top_keyword", KEYWORDS_SQL, 25)
BUCKET_SQL = "CASE WHEN avg_score >= 0.05 THEN 'positive' WHEN avg_score <= -0.05 THEN 'negative' ELSE 'neutral' END"


@query("top_keywords", f"SELECT *, {BUCKET_SQL} AS bucket FROM ({TOP_KEYWORDS_SQL}) tk")
def top_keywords(t):
    from cratewise.functions.labels import sentiment_bucket

    return m.top_keywords(ready(t), "community", COMPUTED_AT).withColumn("bucket", sentiment_bucket("avg_score"))


@query("top_keywords_stop_table", TOP_KEYWORDS_SQL)
def top_keywords_stop_table(t):
    stop = t.spark.createDataFrame([(w,) for w in m.STOP_WORDS], "word string")
    return m.top_keywords(ready(t), "community", COMPUTED_AT, stop)


MENTIONS_SQL = f"SELECT artist AS g, compound FROM ({ANNOTATED_SQL}) an WHERE artist IS NOT NULL AND artist NOT IN ('unknown', '')"
TOP_MENTIONS_SQL = _top_sql("community_artist", MENTIONS_SQL, 20)
query("top_mentions", TOP_MENTIONS_SQL)(
    lambda t: m.top_mentions(
        materialize(annotated(t).select("ingested_at", "artist", "compound"), "annotated"), "community", COMPUTED_AT)
)

# --- schema enforcement ------------------------------------------------------------------

TARGET = StructType([
    StructField("id", LONG, False),
    StructField("title", STRING, False),
    StructField("score", DOUBLE, False),
    StructField("comment", STRING, True),
    StructField("cheap", BOOL, False),
])


@query("enforce_schema", f"""SELECT id, title, score, coalesce(comment, 'unknown') AS comment, cheap,
    title IS NOT NULL AND score IS NOT NULL AND cheap IS NOT NULL AS ok
  FROM (SELECT id, {s_null('title')} AS title, TRY_CAST(score AS DOUBLE) AS score, {s_null('comment')} AS comment,
    p_retailprice < 950 AS cheap FROM (SELECT {RAW_POST}, p_retailprice FROM part) p) q""")
def enforce(t):
    raw = t.part.selectExpr(*RAW_POST_COLUMNS, "CAST(p_retailprice < 950 AS STRING) AS cheap", "p_type AS helper")
    good, rejects = enforce_schema(cl.normalize_nulls(raw), TARGET, mode="rejects")
    return good.withColumn("ok", F.lit(True)).unionByName(rejects.withColumn("ok", F.lit(False)))


FILLED = """p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END AS brand,
  CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_type END AS kind"""


@query("fill_unknown", f"""SELECT p_partkey, coalesce(brand, 'unknown') AS brand, coalesce(kind, 'unknown') AS kind,
    count(*) FILTER (brand IS NULL) OVER () AS brand_filled,
    count(*) FILTER (kind IS NULL) OVER () AS kind_filled FROM (SELECT {FILLED} FROM part) p""")
def fill_unknown(t):
    raw = t.part.selectExpr(
        "p_partkey", "CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END AS brand",
        "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_type END AS kind",
    )
    counts = cl.fill_counts(raw, ["brand", "kind"])
    filled = cl.fill_unknown(raw, ["brand", "kind"])

    def of(field):
        return counts.filter(F.col("field") == field).select("filled").scalar()

    return filled.withColumns({"brand_filled": of("brand"), "kind_filled": of("kind")})

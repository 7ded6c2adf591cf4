"""Daily shares, rankings, volumes, distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratewise.functions import sentiment
from cratewise.functions.nlp import with_entities
from cratewise.operators import metrics as m
from cratewise.plans import gold
from cratewise.registry.base import COMPUTED_AT, SNAPSHOT_SQL, query, s_round, snapshots
from cratewise.registry.comments import (
    ANNOTATED_SQL, BOOST_SQL, DAY, NEG_SQL, STAMPED_SQL, TOP_KEYWORDS_SQL, TOP_MENTIONS_SQL, _values, classified, lexicon,
    metric_sql, rated, ready,
)
from cratewise.registry.comments import _dist_sql as dist_sql
from cratewise.registry.comments import _trend_sql as trend_sql
from cratewise.session import materialize

# Track snapshots out of the line items: (part, supplier, ship day).
TRACK_SQL = """SELECT 'part_' || CAST(l_partkey AS VARCHAR) AS name, 'supplier_' || CAST(l_suppkey AS VARCHAR) AS artist_name,
  CAST(floor(l_extendedprice) AS BIGINT) AS playcount, CAST(floor(l_quantity) AS BIGINT) AS listeners,
  strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS ingested_at FROM lineitem"""


def track_snapshots(t):
    return t.lineitem.select(
        F.concat(F.lit("part_"), "l_partkey").alias("name"),
        F.concat(F.lit("supplier_"), "l_suppkey").alias("artist_name"),
        F.floor("l_extendedprice").cast("long").alias("playcount"),
        F.floor("l_quantity").cast("long").alias("listeners"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"),
    )


def _daily_sql(source, keys, share, kind, dim2):
    names = ", ".join(keys)
    groups = f"""(SELECT *, {share} / sum({share}) OVER (PARTITION BY d) * 100 AS pct FROM (
      SELECT {names}, CAST(ingested_at[1:10] AS DATE) AS d, max(listeners) AS listeners, max(playcount) AS playcount
      FROM ({source}) s GROUP BY ALL) g1) gr"""
    return metric_sql(kind, keys[0], dim2, "playcount", "coalesce(pct, 0)", "listeners", "d", groups)


query("daily_share_artists", _daily_sql(SNAPSHOT_SQL, ["name"], "listeners", "top_artist", "'chart'"))(
    lambda t: m.daily_share(snapshots(t), ["name"], "listeners", "top_artist", COMPUTED_AT, dim2="chart")
)
query("daily_share_tracks", _daily_sql(TRACK_SQL, ["name", "artist_name"], "playcount", "top_track", "artist_name"))(
    lambda t: m.daily_share(track_snapshots(t), ["name", "artist_name"], "playcount", "top_track", COMPUTED_AT)
)


def _peak_sql(source, keys, metric, kind, dim2):
    names = ", ".join(keys)
    groups = f"""(SELECT *, {metric} / sum({metric}) OVER () * 100 AS pct FROM (
      SELECT {names}, max(listeners) AS listeners, max(playcount) AS playcount FROM ({source}) s GROUP BY ALL
      ORDER BY {metric} DESC, {names} LIMIT 20) g1) gr"""
    date = f"(SELECT max(ingested_at)[1:10] FROM ({source}) s2)"
    return metric_sql(kind, keys[0], dim2, "playcount", "pct", "listeners", date, groups)


@query("topn_peak_share", f"""SELECT * FROM ({_peak_sql(SNAPSHOT_SQL, ['name'], 'listeners', 'top_artist', "'chart'")}) a
  UNION ALL SELECT * FROM ({_peak_sql(TRACK_SQL, ['name', 'artist_name'], 'playcount', 'top_track', 'artist_name')}) b""")
def topn_peak_share(t):
    artists = m.topn_peak_share(snapshots(t), ["name"], "listeners", "top_artist", COMPUTED_AT, dim2="chart")
    tracks = m.topn_peak_share(track_snapshots(t), ["name", "artist_name"], "playcount", "top_track", COMPUTED_AT)
    return artists.unionByName(tracks)


VOLUME_SQL = " UNION ALL ".join(
    f"SELECT * FROM ({metric_sql('volume_trend', 'd', repr(name), 'cnt', '0', '0', 'd', f'(SELECT CAST(ingested_at[1:10] AS DATE) AS d, count(*) AS cnt FROM ({source}) s GROUP BY 1) gr')}) v"
    for name, source in (("artists", SNAPSHOT_SQL), ("tracks", TRACK_SQL))
)


def volumes(t):
    return m.volume_trend({"artists": snapshots(t), "tracks": track_snapshots(t)}, COMPUTED_AT)


query("volume_trend", VOLUME_SQL)(volumes)

query("volume_by_source", f"SELECT dim2 AS source, CAST(sum(record_count) AS BIGINT) AS total_records FROM ({VOLUME_SQL}) v GROUP BY 1")(
    lambda t: m.volume_by_source(volumes(t))
)

query("value_counts", """SELECT 'lang' AS field, lang AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 2) AS pct
    FROM documents GROUP BY lang
  UNION ALL SELECT 'partkey', CAST(l_partkey AS VARCHAR), count(*), round(count(*) / sum(count(*)) OVER () * 100, 2)
    FROM lineitem GROUP BY l_partkey""")(
    lambda t: m.value_counts(t.documents, "lang").select(F.lit("lang").alias("field"), "*").unionByName(
        m.value_counts(t.lineitem.select(F.col("l_partkey").cast("string")), "l_partkey").select(F.lit("partkey").alias("field"), "*"))
)

query("distinct_counts", """SELECT count(DISTINCT user_id) AS user_id, count(DISTINCT event_type) AS event_type,
    count(DISTINCT props) AS props FROM events""")(
    lambda t: m.distinct_counts(t.events, ["user_id", "event_type", "props"])
)


def _histogram_sql(source, value, bins, by):
    return f"""SELECT CAST("by" AS VARCHAR) AS "by", bin, round(a + (z - a) / {bins} * bin, 4) AS low,
      round(a + (z - a) / {bins} * (bin + 1), 4) AS high, count(*) AS n FROM (
        SELECT "by", a, z, least(CAST(floor((v - a) * {bins} / (z - a)) AS BIGINT), {bins - 1}) AS bin
        FROM (SELECT "by", v, CASE WHEN a = z THEN a - 0.5 ELSE a END AS a, CASE WHEN a = z THEN z + 0.5 ELSE z END AS z
          FROM (SELECT {by} AS "by", CAST({value} AS DOUBLE) AS v, min(CAST({value} AS DOUBLE)) OVER (PARTITION BY {by}) AS a,
            max(CAST({value} AS DOUBLE)) OVER (PARTITION BY {by}) AS z FROM {source}) h0) h1) h2 GROUP BY "by", bin, a, z"""


@query("histogram", f"""SELECT 'length' AS chart, * FROM ({_histogram_sql('documents', 'length(text)', 40, 'lang')}) a
  UNION ALL SELECT 'value', * FROM ({_histogram_sql('events', 'value', 30, "'all'")}) b""")
def histogram(t):
    lengths = t.documents.select("lang", F.length("text").alias("length"))
    return m.union_rows(
        m.histogram(lengths, "length", 40, by="lang").select(F.lit("length").alias("chart"), "*"),
        m.histogram(t.events, "value", 30).select(F.lit("value").alias("chart"), "*"),
    )


# --- the headline ---------------------------------------------------------------------------

HEADLINE_SQL = f"""SELECT * FROM ({dist_sql('sentiment_dist', 'sentiment', 'compound')}) a UNION ALL SELECT * FROM ({TOP_KEYWORDS_SQL}) b
  UNION ALL SELECT * FROM ({_peak_sql(SNAPSHOT_SQL, ['name'], 'playcount', 'top_artist_lastfm', "'chart'")}) c"""


@query("narrative_card", f"""WITH h AS ({HEADLINE_SQL}) SELECT
    (SELECT CAST(sum(record_count) AS BIGINT) FROM h WHERE metric_type = 'sentiment_dist') AS comments,
    (SELECT {s_round("max(pct)", 1)} FROM h WHERE metric_type = 'sentiment_dist' AND dim1 = 'positive') AS positive_pct,
    (SELECT {s_round("max(avg_score)", 3)} FROM h WHERE metric_type = 'sentiment_dist' AND dim1 = 'positive') AS positive_score,
    (SELECT {s_round("max(pct)", 1)} FROM h WHERE metric_type = 'sentiment_dist' AND dim1 = 'negative') AS negative_pct,
    (SELECT dim1 FROM h WHERE metric_type = 'top_artist_lastfm' ORDER BY avg_score DESC, dim1 DESC LIMIT 1) AS leader,
    (SELECT CAST(floor(max(avg_score) / 1e6) AS BIGINT) FROM h WHERE metric_type = 'top_artist_lastfm') AS leader_millions,
    (SELECT string_agg(dim1, ', ' ORDER BY record_count DESC, dim1) FROM (SELECT * FROM h WHERE metric_type = 'top_keyword'
      ORDER BY record_count DESC, dim1 LIMIT 3) k) AS keywords""")
def narrative_card(t):
    comments = ready(t)
    return m.narrative(m.union_rows(
        m.sentiment_dist(comments, "community", COMPUTED_AT),
        m.top_keywords(comments, "community", COMPUTED_AT),
        m.topn_peak_share(snapshots(t), ["name"], "playcount", "top_artist_lastfm", COMPUTED_AT, dim2="chart"),
    ))


query("sentiment_summary", f"""SELECT dim2 AS source, dim1 AS sentiment, record_count AS n, avg_score AS avg
  FROM ({dist_sql('sentiment_dist', 'sentiment', 'compound')}) a""")(
    lambda t: m.sentiment_summary(m.sentiment_dist(rated(t), "community", COMPUTED_AT))
)

# --- the whole gold plan ---------------------------------------------------------------------

DEFAULT_BOOST_SQL = _values(f"('{w}', CAST({v} AS DOUBLE))" for w, v in sentiment.BOOSTERS.items())
DEFAULT_NEG_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in sentiment.NEGATIONS) + ")"


def _volume_sql(name, source):
    groups = f"(SELECT CAST(ingested_at[1:10] AS DATE) AS d, count(*) AS cnt FROM ({source}) s GROUP BY 1) gr"
    return metric_sql("volume_trend", "d", f"'{name}'", "cnt", "0", "0", "d", groups)


STORY_PARTS = [
    dist_sql("sentiment_dist", "sentiment", "compound"), dist_sql("comment_type_dist", "comment_type", "confidence"),
    trend_sql(DAY), TOP_KEYWORDS_SQL, TOP_MENTIONS_SQL, _volume_sql(gold.COMMENT_SOURCE, STAMPED_SQL),
    _daily_sql(SNAPSHOT_SQL, ["name"], "listeners", gold.ARTIST_METRIC, f"'{gold.CHART_SOURCE}'"),
    _volume_sql(gold.ARTIST_SOURCE, SNAPSHOT_SQL),
    _daily_sql(TRACK_SQL, ["name", "artist_name"], "playcount", gold.TRACK_METRIC, "artist_name"),
    _volume_sql(gold.TRACK_SOURCE, TRACK_SQL),
]
# The plan scores with the default degree words and negations and names its own source.
STORY_SQL = (
    " UNION ALL ".join(f"SELECT * FROM ({part}) s{i}" for i, part in enumerate(STORY_PARTS))
    .replace(BOOST_SQL, DEFAULT_BOOST_SQL).replace(NEG_SQL, DEFAULT_NEG_SQL).replace("'community", f"'{gold.COMMENT_SOURCE}")
)


@query("storytelling", STORY_SQL)
def storytelling(t):
    """Documents and part comments, artist and track snapshots through the gold plan."""
    comments = with_entities(classified(t), "clean")
    return gold.storytelling(COMPUTED_AT, comments, snapshots(t), track_snapshots(t), lexicon(t))


CONFIDENCE_SQL = _histogram_sql(f"({ANNOTATED_SQL}) an", "confidence", 20, "comment_type")
query("histogram_confidence", CONFIDENCE_SQL)(
    lambda t: m.histogram(
        materialize(classified(t).select("comment_type", "confidence"), "classified"), "confidence", 20, by="comment_type")
)

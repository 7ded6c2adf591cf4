"""Silver tables to the two gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cratewise.functions.sentiment import score_sentiment, sentiment_label
from cratewise.operators import metrics as m
from cratewise.operators.quality import governance_report
from cratewise.session import materialize

# Per source the numeric and the text columns that are measured.
MEASURED = {
    "reddit": (["word_count", "score", "confidence", "extract_confidence"], ["clean_comment", "raw_comment"]),
    "lastfm_artists": (["playcount", "listeners"], ["name"]),
    "lastfm_tracks": (["playcount", "listeners", "duration_sec"], ["name", "artist_name"]),
}

# Names that the metric rows carry.
COMMENT_SOURCE, CHART_SOURCE = "reddit", "lastfm"
ARTIST_SOURCE, TRACK_SOURCE = "lastfm_artists", "lastfm_tracks"
ARTIST_METRIC, TRACK_METRIC = "top_artist_lastfm", "top_track_lastfm"


def governance(sources: dict[str, DataFrame], computed_at: str, measured=MEASURED) -> DataFrame:
    """KPI rows of every given source; an empty source adds none."""
    return m.union_rows(*[
        governance_report(df, name, *measured[name], computed_at) for name, df in sources.items()
    ])


def comment_metrics(comments: DataFrame, lexicon: DataFrame, computed_at: str, source=COMMENT_SOURCE) -> DataFrame:
    """Comments are scored once; the six metrics read the narrow result."""
    scored = score_sentiment(comments, "tokens", lexicon)
    slim = scored.select(
        "ingested_at", "tokens", "comment_type", "confidence", "artist", "compound",
        sentiment_label("compound").alias("sentiment"),
    )
    ready = materialize(slim, "scored")
    return m.union_rows(
        m.sentiment_dist(ready, source, computed_at),
        m.sentiment_trend(ready, source, computed_at),
        m.comment_type_dist(ready, source, computed_at),
        m.top_keywords(ready, source, computed_at),
        m.volume_trend({source: ready}, computed_at),
        m.top_mentions(ready, source, computed_at),
    )


def artist_metrics(artists: DataFrame, computed_at: str) -> DataFrame:
    return m.union_rows(
        m.daily_share(artists, ["name"], "listeners", ARTIST_METRIC, computed_at, dim2=CHART_SOURCE),
        m.volume_trend({ARTIST_SOURCE: artists}, computed_at),
    )


def track_metrics(tracks: DataFrame, computed_at: str) -> DataFrame:
    return m.union_rows(
        m.daily_share(tracks, ["name", "artist_name"], "playcount", TRACK_METRIC, computed_at),
        m.volume_trend({TRACK_SOURCE: tracks}, computed_at),
    )


def storytelling(
    computed_at: str,
    comments: DataFrame | None = None,
    artists: DataFrame | None = None,
    tracks: DataFrame | None = None,
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """Metric rows of the sources that are given, each on its own."""
    parts = []
    if comments is not None:
        parts.append(comment_metrics(comments, lexicon, computed_at))
    if artists is not None:
        parts.append(artist_metrics(artists, computed_at))
    if tracks is not None:
        parts.append(track_metrics(tracks, computed_at))
    if not parts:
        raise ValueError("no source given")
    return m.union_rows(*parts)

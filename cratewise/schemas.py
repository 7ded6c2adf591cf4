"""Declared schemas of every table. Nullable field = optional field."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

UNKNOWN = "unknown"


def _field(name, dtype, optional=False):
    return StructField(name, dtype, nullable=optional)


STRING, LONG, DOUBLE, BOOL = StringType(), LongType(), DoubleType(), BooleanType()

ARTISTS = StructType([
    _field("name", STRING),
    _field("name_tokens", STRING),
    _field("playcount", LONG),
    _field("listeners", LONG),
    _field("mbid", STRING, optional=True),
    _field("ingested_at", STRING),
])

TRACKS = StructType([
    _field("name", STRING),
    _field("name_tokens", STRING),
    _field("duration_sec", LONG),
    _field("playcount", LONG),
    _field("listeners", LONG),
    _field("mbid", STRING, optional=True),
    _field("artist_name", STRING),
    _field("artist_name_tokens", STRING),
    _field("artist_mbid", STRING, optional=True),
    _field("ingested_at", STRING),
])

COMMENTS = StructType([
    _field("post_id", LONG),
    _field("title", STRING),
    _field("score", LONG),
    _field("raw_comment_id", LONG),
    _field("raw_comment", STRING),
    _field("clean_comment", STRING),
    _field("tokens", ArrayType(STRING)),
    _field("comment_type", STRING),
    _field("confidence", DOUBLE),
    _field("has_music_pattern", BOOL),
    _field("pattern_type", STRING, optional=True),
    _field("has_contrast", BOOL),
    _field("word_count", LONG),
    _field("word_count_capped", DOUBLE),
    _field("score_capped", DOUBLE),
    _field("artist", STRING, optional=True),
    _field("song", STRING, optional=True),
    _field("extract_confidence", DOUBLE),
    _field("ingested_at", STRING),
])

GOVERNANCE = StructType([
    _field("source", STRING),
    _field("field_name", STRING),
    _field("kpi_type", STRING),
    _field("value", DOUBLE),
    _field("unit", STRING),
    _field("data_date", STRING),
    _field("computed_at", STRING),
])

STORYTELLING = StructType([
    _field("metric_type", STRING),
    _field("dim1", STRING),
    _field("dim2", STRING, optional=True),
    _field("record_count", LONG),
    _field("pct", DOUBLE),
    _field("avg_score", DOUBLE),
    _field("data_date", STRING),
    _field("computed_at", STRING),
])

# --- raw payloads -----------------------------------------------------------

_IMAGE = ArrayType(StructType([StructField("#text", STRING), StructField("size", STRING)]))

_CHART_META = StructType([
    StructField("ingested_at", STRING),
    StructField("source", STRING),
    StructField("method", STRING),
    StructField("artist_count", LONG),
    StructField("track_count", LONG),
])

_RAW_ARTIST = StructType([
    StructField("name", STRING),
    StructField("playcount", STRING),
    StructField("listeners", STRING),
    StructField("mbid", STRING),
    StructField("url", STRING),
    StructField("streamable", STRING),
    StructField("image", _IMAGE),
])

_RAW_TRACK = StructType([
    StructField("name", STRING),
    StructField("duration", STRING),
    StructField("playcount", STRING),
    StructField("listeners", STRING),
    StructField("mbid", STRING),
    StructField("url", STRING),
    StructField("artist", StructType([
        StructField("name", STRING),
        StructField("mbid", STRING),
        StructField("url", STRING),
    ])),
])


def snapshot_schema(data_key: str, record_key: str, record: StructType) -> StructType:
    """``{_metadata, data: {<data_key>: {<record_key>: [record]}}, error, message}``"""
    records = StructType([StructField(record_key, ArrayType(record))])
    return StructType([
        StructField("_metadata", _CHART_META),
        StructField("data", StructType([StructField(data_key, records)])),
        StructField("error", LONG),
        StructField("message", STRING),
    ])


ARTIST_SNAPSHOT = snapshot_schema("artists", "artist", _RAW_ARTIST)
TRACK_SNAPSHOT = snapshot_schema("tracks", "track", _RAW_TRACK)

# `score` stays text so that an empty score reaches the coercion step.
POSTS = ArrayType(StructType([
    StructField("title", STRING),
    StructField("score", STRING),
    StructField("comments", ArrayType(STRING)),
]))


def required(schema: StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]


def optional(schema: StructType) -> list[str]:
    return [f.name for f in schema if f.nullable]

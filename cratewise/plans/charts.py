"""Chart snapshots to the silver artist and track tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cratewise import schemas
from cratewise.operators.clean import split_invalid
from cratewise.operators.dedup import dedup_daily
from cratewise.operators.quality import enforce_schema
from cratewise.sources.bronze import flatten_artists, flatten_tracks


def _silver(flat: DataFrame, names: list[str], schema, mode: str) -> tuple[DataFrame, DataFrame]:
    valid, rejects = split_invalid(flat, names, "playcount")
    table, unfit = enforce_schema(dedup_daily(valid, names), schema, mode)
    return table, rejects if unfit is None else rejects.unionByName(unfit)


def silver_artists(records: DataFrame, mode: str = "strict") -> tuple[DataFrame, DataFrame]:
    """``(artists, rejects)`` from ``read_snapshots`` records."""
    return _silver(flatten_artists(records), ["name"], schemas.ARTISTS, mode)


def silver_tracks(records: DataFrame, mode: str = "strict") -> tuple[DataFrame, DataFrame]:
    """``(tracks, rejects)`` from ``read_snapshots`` records."""
    return _silver(flatten_tracks(records), ["name", "artist_name"], schemas.TRACKS, mode)

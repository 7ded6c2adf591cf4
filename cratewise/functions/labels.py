"""Small presentation expressions: buckets, labels, scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cratewise.functions.sentiment import sentiment_label

# Display labels of the three sources.
SOURCE_LABELS = {
    "reddit": "Reddit (Scraping)",
    "lastfm_artists": "Last.fm — Artists (API)",
    "lastfm_tracks": "Last.fm — Tracks (API)",
}

# Display labels of the comment types.
TYPE_LABELS = {
    "recommendation": "Recommendation",
    "opinion": "Opinion",
    "mixed": "Mixed",
    "other": "Other",
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def severity(rate) -> Column:
    """Traffic light of a percentage: 0 ok, up to 5 warn, above error."""
    rate = _col(rate)
    return F.when(rate == 0, "ok").when(rate <= 5, "warn").otherwise("error")


def sentiment_bucket(score, t: float = 0.05) -> Column:
    return sentiment_label(score, t)


def known(c) -> Column:
    """Not null, not ``unknown``, not empty."""
    c = _col(c)
    return c.isNotNull() & ~c.isin("unknown", "")


def full_field(source, field) -> Column:
    return F.concat_ws(".", _col(source), _col(field))


def track_label(name, artist, n: int = 22) -> Column:
    """Name cut to ``n`` characters, artist in brackets on a second line."""
    name = _col(name)
    short = F.when(F.length(name) > n, F.concat(F.substring(name, 1, n), F.lit("…"))).otherwise(name)
    return F.concat(short, F.lit("\n("), _col(artist), F.lit(")"))


def millions(c) -> Column:
    return _col(c) / F.lit(1e6)


def kpi_flag(kpi_type, value) -> Column:
    """``high_nulls``, ``compliant``, ``many_outliers`` or null."""
    kpi_type, value = _col(kpi_type), _col(value)
    return (
        F.when((kpi_type == "null_rate") & (value > 5), "high_nulls")
        .when((kpi_type == "schema_compliance") & (value == 100), "compliant")
        .when((kpi_type == "outlier_rate") & (value > 15), "many_outliers")
    )

"""Rule-based comment classification and (artist, song) extraction.

Scores are summed as integers (hundredths, or points out of a maximum), so no
binary rounding error reaches the thresholds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cratewise.functions.once import with_once
from cratewise.functions.text import WORD, WS, strip, tokenize, word_count

# Contrast markers.
CONTRAST_MARKERS = ["but", "however", "although", "though"]

# The three recommendation patterns, two groups each.
_GAP, _ANY = f"[{WS}]*", "([^\\n]+?)"
DASH = f"^{_GAP}{_ANY}{_GAP}-{_GAP}{_ANY}{_GAP}$"
BY = f"^{_GAP}{_ANY}[{WS}]+by[{WS}]+{_ANY}{_GAP}$"
COLON = f"^{_GAP}{_ANY}{_GAP}:{_GAP}{_ANY}{_GAP}$"
BY_ANY_CASE = BY.replace("by", "[bB][yY]")

MOST_WORDS = 17
# What `clean_comment` leaves of the characters that are neither word nor space.
CLEAN_SYMBOLS = "/&-'"
SYMBOL = f"[^{WORD}{WS}]"


def _groups(text: Column, pattern: str) -> tuple[Column, Column]:
    return F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)


def _fits(text: Column, pattern: str, left_words: int, right_words: int) -> Column:
    left, right = _groups(text, pattern)
    return (
        text.rlike(pattern)
        & (word_count(left) <= left_words)
        & (word_count(right) <= right_words)
    )


def pattern_type(text: Column, words: Column) -> Column:
    """First pattern that matches within its word limits, else null.

    The limits leave at most 17 words (8 + a lone dash + 8), so longer text
    never meets a regular expression.
    """
    first = (
        F.when(_fits(text, DASH, 8, 8), "dash")
        .when(_fits(text, BY, 10, 5), "by")
        .when(_fits(text, COLON, 5, 10), "colon")
    )
    return F.when(words <= MOST_WORDS, first)


def has_contrast(tokens: Column) -> Column:
    return F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in CONTRAST_MARKERS]))


def comment_type(has_pattern: Column, contrast: Column, words: Column) -> Column:
    opinion = contrast | (words > 6)
    return (
        F.when(has_pattern & opinion, "mixed")
        .when(has_pattern, "recommendation")
        .when(opinion, "opinion")
        .otherwise("other")
    )


def confidence(symbols: Column, has_pattern: Column, contrast: Column, words: Column) -> Column:
    """``symbols`` is the number of characters that are neither word nor space."""
    points = (
        F.when(has_pattern, 45).otherwise(0)
        + F.when(words <= 5, 25).when(words <= 10, 15).when(words > 20, -15).otherwise(0)
        + F.when(contrast, -20).otherwise(0)
        + F.when(has_pattern & (contrast | (words > 6)), -10).otherwise(0)
        + F.when(symbols > 5, -10).otherwise(0)
        + F.when(words < 2, -20).otherwise(0)
    )
    clamped = F.greatest(F.lit(0), F.least(F.lit(100), points)) / F.lit(100.0)
    return F.when(words == 0, 0.0).otherwise(clamped)


def with_classification(df, text: str, tokens: str | None = None):
    """Add the classification columns of ``text`` to ``df``.

    With ``tokens`` given, ``text`` is a cleaned comment and ``tokens`` its
    tokens; any other text is trimmed, lower-cased and tokenised here.
    """
    if tokens:
        base = df.select("*", F.col(text).alias("_text"), F.col(tokens).alias("_words"))
        kept = F.translate("_text", CLEAN_SYMBOLS, "")
        symbols = F.length("_text") - F.length(kept)
    else:
        base = with_once(df, _text=F.coalesce(F.lower(strip(text)), F.lit("")))
        base = with_once(base, _words=tokenize("_text"))
        symbols = F.regexp_count("_text", F.lit(SYMBOL))
    counted = base.withColumn("word_count", F.size("_words").cast("long"))
    facts = with_once(
        counted,
        has_contrast=has_contrast(F.col("_words")),
        pattern_type=pattern_type(F.col("_text"), F.col("word_count")),
    )
    pattern, contrast, words = (
        F.col(c) for c in ("has_music_pattern", "has_contrast", "word_count")
    )
    marked = facts.withColumn("has_music_pattern", F.col("pattern_type").isNotNull())
    return with_once(
        marked,
        comment_type=comment_type(pattern, contrast, words),
        confidence=confidence(symbols, pattern, contrast, words),
    ).drop("_text", "_words")


# --- extraction -------------------------------------------------------------

# Fixed values per pattern: (points to start with, most words of a song).
START = {"dash": (2, 6), "by": (3, 8), "colon": (3, 8)}
# Points that count as certainty. The literal maxima of "by" and "colon" are
# below the points a comment can reach, so confidence can pass 1; the bounded
# ones are what can be reached.
MAXIMUM = {"dash": 8, "by": 7, "colon": 8}
BOUNDED_MAXIMUM = {"dash": 8, "by": 9, "colon": 10}
DASH_MINIMUM = 6


def _points(condition: Column, points: int) -> Column:
    return F.when(condition, points).otherwise(0)


def _per_pattern(pattern: Column, values: dict) -> Column:
    cases = F
    for name, value in values.items():
        cases = cases.when(pattern == name, value)
    return cases


def with_entities(df, text: str, pattern: str = "pattern_type", bounded: bool = False):
    """Add ``artist``, ``song`` and ``extract_confidence``.

    dash: ``artist - song``, dropped below six points; by: ``song by artist``;
    colon: ``artist: song``. No text or no pattern gives (null, null, 0).
    """
    kind = F.col(pattern)

    def side(group):
        regexes = {"dash": DASH, "by": BY_ANY_CASE, "colon": COLON}
        found = {k: F.regexp_extract("_text", regex, group) for k, regex in regexes.items()}
        return F.nullif(_per_pattern(kind, found), F.lit(""))

    sides = with_once(with_once(df, _text=strip(text)), _left=side(1), _right=side(2))
    swapped = kind == "by"
    named = sides.select(
        "*",
        F.when(swapped, F.col("_right")).otherwise(F.col("_left")).alias("_artist"),
        F.when(swapped, F.col("_left")).otherwise(F.col("_right")).alias("_song"),
    )
    artist, song = F.col("_artist"), F.col("_song")
    short = {
        "dash": (F.length(artist) < 40) & (F.length(song) < 60),
        "by": (F.length(song) < 80) & (F.length(artist) < 40),
        "colon": F.length(song) < 80,
    }
    all_lower = artist.rlike(r"\p{Ll}") & ~artist.rlike(r"[\p{Lu}\p{Lt}]")
    points = (
        _per_pattern(kind, {k: start for k, (start, _) in START.items()})
        + _points(word_count(artist).between(1, 4), 2)
        + _points(word_count(song).between(1, _per_pattern(kind, {k: most for k, (_, most) in START.items()})), 2)
        + _points(_per_pattern(kind, short), 2)
        + _points((kind == "colon") & ~all_lower, 1)
    )
    scored = with_once(named, _points=F.when(artist.isNotNull(), points))
    kept = (kind != "dash") | (F.col("_points") >= DASH_MINIMUM)
    maximum = _per_pattern(kind, {k: float(v) for k, v in (BOUNDED_MAXIMUM if bounded else MAXIMUM).items()})
    return scored.select(
        "*",
        F.when(kept, artist).alias("artist"),
        F.when(kept, song).alias("song"),
        F.coalesce(F.round(F.col("_points") / maximum, 2), F.lit(0.0)).alias("extract_confidence"),
    ).drop("_text", "_left", "_right", "_artist", "_song", "_points")

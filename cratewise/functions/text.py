"""Text cleaning as column expressions.

Java's ``\\s`` and ``\\w`` are ASCII-only. The classes below spell out the
Unicode sets, so the same text gives the same result in Spark, in Python's
``re`` and in an RE2 engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cratewise.functions.html import unescape_html

# Regular-expression character classes (inside brackets).
WS = r"\t-\r\x1c-\x20\x85\p{Z}"
WORD = r"\p{L}\p{N}_"

SPACES = f"[{WS}]+"
TOKEN = f"[^{WS}]+"
LINK = f"http[^{WS}]+|www\\.[^{WS}]+"
PUNCTUATION = f"[^{WORD}{WS}/&\\-']"
PART_BREAK = f"\\n+|(?<=\\))[{WS}]+(?=[A-Z])"
FLAIR = f"^\\[[^\\n]*?\\][{WS}]*"
# A whitespace run that is not already one plain space.
UNEVEN = f"[{WS}&&[^ ]][{WS}]*| [{WS}]+"
# One greedy run from the first to the last visible character: linear even on
# text with very long blank stretches, where `\s+$` would be quadratic.
VISIBLE = f"(?s)[^{WS}].*[^{WS}]|[^{WS}]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Trim any Unicode whitespace (``trim`` only knows the space)."""
    return F.regexp_extract(_col(c), VISIBLE, 0)


def is_blank(c) -> Column:
    """True for null, empty or whitespace-only text."""
    c = _col(c)
    return c.isNull() | ~c.rlike(f"[^{WS}]")


def normalize_text(c) -> Column:
    return F.lower(F.trim(F.regexp_replace(_col(c), UNEVEN, " ")))


def remove_links(c) -> Column:
    """Drop bare links.

    The markdown rule ``[..](http..)`` needs an ``http`` followed by a visible
    character, and none is left after bare links are gone, so one pass does.
    A plain substring test spares most text the regular expression.
    """
    c = _col(c)
    linked = F.contains(c, F.lit("http")) | F.contains(c, F.lit("www."))
    return F.when(linked, F.regexp_replace(c, LINK, "")).otherwise(c)


def clean_punctuation(c) -> Column:
    """Keep word characters, whitespace and ``/ & - '``."""
    return F.regexp_replace(_col(c), PUNCTUATION, "")


def name_tokens(c) -> Column:
    """Names: spaces collapse first, so removals can leave inner double spaces."""
    return strip(remove_links(clean_punctuation(unescape_html(normalize_text(c)))))


def clean_comment(c) -> Column:
    return normalize_text(clean_punctuation(remove_links(unescape_html(c))))


def split_comment(c) -> Column:
    """Parts of a comment: one per line, and after ``)`` before a capital."""
    parts = F.transform(F.split(_col(c), PART_BREAK, -1), strip)
    return F.array_remove(parts, "")


def tokenize(c, clean: bool = False) -> Column:
    """Whitespace tokens; empty text gives an empty array. In ``clean`` text
    the only whitespace is the single space."""
    return F.array_remove(F.split(_col(c), " " if clean else SPACES, -1), "")


def word_count(c) -> Column:
    return F.regexp_count(_col(c), F.lit(TOKEN))


def parse_tokens(c) -> Column:
    """Token lists stored as text (``"['a', 'b']"``); bad text gives ``[]``."""
    as_json = F.regexp_replace(_col(c), r"\\x([0-9a-f]{2})", r"\\u00$1")
    parsed = F.from_json(as_json, "array<string>", {"allowSingleQuotes": "true"})
    return F.coalesce(parsed, F.array().cast("array<string>"))


def format_tokens(tokens) -> Column:
    """The stored text form of a token array, readable by ``parse_tokens``."""
    quoted = F.transform(
        _col(tokens),
        lambda t: F.when(F.contains(t, F.lit("'")), F.concat(F.lit('"'), t, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), t, F.lit("'"))),
    )
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def strip_flair(c) -> Column:
    """Remove one leading ``[...]`` prefix."""
    return strip(F.regexp_replace(_col(c), FLAIR, ""))


def day(c) -> Column:
    """Day of an ISO-8601 text stamp (with or without zone) or a timestamp."""
    return F.substring(_col(c).cast("string"), 1, 10).try_cast("date")

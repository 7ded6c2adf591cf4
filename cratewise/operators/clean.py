"""Row-level cleaning: null normalisation, coercion, filters, projection."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from cratewise import schemas
from cratewise.functions.text import is_blank, strip

# Texts that mean "no value".
NULL_WORDS = ["null", "none", "nan", "", "[deleted]", "[removed]"]

# Title keywords of a reaction post.
REACTION_KEYWORDS = [
    "[fresh", "thoughts", "opinion", "reaction", "first listen", "first impression",
    "what do you think", "how do you feel", "rate", "rating", "rated", "ranked",
    "ranking", "aoty", "album of the year", "underrated", "overrated",
    "disappointing", "masterpiece", "classic", "favorite", "favourite", "best",
    "worst", "slept on", "album", "ep", "mixtape", "discography",
    "unpopular opinion", "hot take",
]


def null_if_word(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.lower(strip(c)).isin(NULL_WORDS), c)


def normalize_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null out text that only says "no value"; other types pass through."""
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    chosen = [c for c in (cols or df.columns) if c in text]
    return df.withColumns({c: null_if_word(c) for c in chosen})


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def coerce_score(c) -> Column:
    """Number, truncated to an integer; unreadable or missing text is 0."""
    c = F.col(c) if isinstance(c, str) else c
    number = strip(c.cast("string")).try_cast("double")
    finite = F.when(~F.isnan(number) & (F.abs(number) < 9.2e18), number)
    return F.coalesce(finite, F.lit(0.0)).cast("long")


def valid_record(names: list[str], metric: str) -> Column:
    filled = reduce(and_, [~is_blank(n) for n in names])
    return filled & F.coalesce(F.col(metric) > 0, F.lit(False))


def split_invalid(df: DataFrame, names: list[str], metric: str) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejects)``: every row lands in exactly one of the two."""
    ok = valid_record(names, metric)
    return df.filter(ok), df.filter(~ok)


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    return df.filter(~is_blank(col))


def is_reaction(title, keywords: list[str] = REACTION_KEYWORDS) -> Column:
    """Case-insensitive substring match against any keyword."""
    title = F.lower(F.col(title) if isinstance(title, str) else title)
    hits = [F.contains(title, F.lit(k)) for k in keywords]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False))


def fill_unknown(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.fill(schemas.UNKNOWN, subset=cols)


def fill_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """How many values ``fill_unknown`` would fill, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "field", "filled")


def project(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*schema.names)


def cast_to(df: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """Cast to the declared types; without ``strict`` bad values become null."""
    def cast(field):
        c = F.col(field.name)
        return (c.cast(field.dataType) if strict else c.try_cast(field.dataType)).alias(field.name)

    return df.select(*[cast(f) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

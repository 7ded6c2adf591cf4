"""Long-form metric rows ``(metric_type, dim1, dim2, record_count, pct,
avg_score, data_date, computed_at)`` and other aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratewise.functions.labels import known
from cratewise.functions.text import day
from cratewise.operators.explode import explode_tokens
from cratewise.operators.quality import data_date
from cratewise.session import broadcast_if_small

# Words that never count as keywords.
STOP_WORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with",
    "it", "its", "is", "was", "are", "be", "by", "as", "this", "that", "i", "my", "me",
    "you", "your", "we", "our", "they", "their", "he", "she", "his", "her", "have",
    "has", "had", "do", "does", "not", "no", "so", "if", "up", "out", "just", "like",
    "from", "get", "got", "can", "will", "would", "could", "should", "one", "all",
    "more", "also", "very", "really", "about", "there", "what", "when", "how", "who",
    "which", "than", "into", "other", "been", "some", "any", "links", "bot", "message",
    "send", "youtube", "deezer", "spotify", "http", "www", "com", "amp", "gt", "lt",
    "via", "here", "check", "listen", "song", "songs", "track", "tracks", "playlist",
    "link",
]

def metric_rows(df, metric_type, dim1, dim2, count, pct, score, date, computed_at) -> DataFrame:
    """Project an aggregate into the long form."""
    return df.select(
        F.lit(metric_type).alias("metric_type"),
        dim1.cast("string").alias("dim1"),
        dim2.cast("string").alias("dim2"),
        count.cast("long").alias("record_count"),
        F.round(F.coalesce(pct.cast("double"), F.lit(0.0)), 2).alias("pct"),
        F.round(F.coalesce(score.cast("double"), F.lit(0.0)), 4).alias("avg_score"),
        date.cast("string").alias("data_date"),
        F.lit(computed_at).alias("computed_at"),
    )


def share_of_total(df: DataFrame, x: str, name: str = "pct") -> DataFrame:
    """Percent of the total; ``df`` is an already bounded aggregate."""
    total = F.sum(x).over(Window.partitionBy())
    return df.withColumn(name, F.try_divide(F.col(x), total) * 100)


def share_within(df: DataFrame, part: str, x: str, name: str = "pct") -> DataFrame:
    """Percent of the total of the row's ``part``, a date column.

    A window would bring a whole day to one task. The totals hold at most one
    row per calendar day, so they are broadcast instead and no row moves.
    """
    totals = df.groupBy(F.col(part).alias("_part")).agg(F.sum(x).alias("_total"))
    joined = df.join(F.broadcast(totals), F.col(part).eqNullSafe(F.col("_part")))
    return joined.withColumn(name, F.try_divide(F.col(x), F.col("_total")) * 100).drop("_part", "_total")


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def _latest(df: DataFrame, ts: str) -> Column:
    return df.agg(data_date(ts)).scalar()


def _distribution(df, metric, col, score, source, computed_at, ts) -> DataFrame:
    counts = df.groupBy(col).agg(
        F.count("*").alias("cnt"), F.avg(score).alias("avg_s"), F.max(ts).alias("last")
    )
    shares = share_of_total(counts, "cnt").withColumn("last", F.max("last").over(Window.partitionBy()))
    return metric_rows(
        shares, metric, F.col(col), F.lit(source), F.col("cnt"), F.col("pct"), F.col("avg_s"),
        F.substring("last", 1, 10), computed_at,
    )


def sentiment_dist(df, source, computed_at, label="sentiment", score="compound", ts="ingested_at"):
    """Count, share and mean score of each of the three labels."""
    return _distribution(df, "sentiment_dist", label, score, source, computed_at, ts)


def comment_type_dist(df, source, computed_at, col="comment_type", score="confidence", ts="ingested_at"):
    """Count, share and mean confidence of each of the four types."""
    return _distribution(df, "comment_type_dist", col, score, source, computed_at, ts)


def sentiment_trend(df, source, computed_at, grain="day", score="compound", ts="ingested_at"):
    """Count and mean score per day (or ISO week, named by its Monday)."""
    date = day(ts) if grain == "day" else F.trunc(day(ts), grain)
    daily = df.groupBy(date.alias("date")).agg(F.count("*").alias("cnt"), F.avg(score).alias("avg_s"))
    return metric_rows(
        daily, "sentiment_trend", F.col("date"), F.lit(source), F.col("cnt"), F.lit(0.0), F.col("avg_s"),
        F.col("date"), computed_at,
    )


def keyword_tokens(tokens, stop: list[str] = STOP_WORDS, min_len: int = 3) -> Column:
    """Tokens that are long enough and not stop words."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.filter(tokens, lambda t: (F.length(t) >= min_len) & ~t.isin(stop))


def drop_stopwords(tokens_df: DataFrame, stop_df: DataFrame, token: str = "kw") -> DataFrame:
    """Anti join for a stop-word table; broadcast only while it is small."""
    stop = stop_df.select(F.col(stop_df.columns[0]).alias(token)).distinct()
    return tokens_df.join(broadcast_if_small(stop), token, "left_anti")


def _top_groups(df, metric, col, score, k, source, computed_at, date) -> DataFrame:
    counts = df.groupBy(col).agg(F.count("*").alias("cnt"), F.avg(score).alias("avg_s"))
    top = share_of_total(top_k(counts, [F.desc("cnt"), F.asc(col)], k), "cnt")
    return metric_rows(
        top, metric, F.col(col), F.lit(source), F.col("cnt"), F.col("pct"), F.col("avg_s"),
        date, computed_at,
    )


def top_keywords(df, source, computed_at, stop=STOP_WORDS, k=25, tokens="tokens", score="compound", ts="ingested_at"):
    """The k most frequent tokens, share of the top-k total, mean score of the
    comments they occur in. ``stop`` is a list or a one-column DataFrame."""
    slim = df.select(F.col(tokens).alias("_tokens"), F.col(score).alias("_score"))
    if isinstance(stop, DataFrame):
        words = explode_tokens(slim.select(keyword_tokens("_tokens", []).alias("_t"), "_score"), "_t")
        words = drop_stopwords(words, stop)
    else:
        words = explode_tokens(slim.select(keyword_tokens("_tokens", stop).alias("_t"), "_score"), "_t")
    return _top_groups(words, "top_keyword", "kw", "_score", k, source, computed_at, _latest(df, ts))


def top_mentions(df, source, computed_at, col="artist", k=20, score="compound", ts="ingested_at"):
    """The k most mentioned known artists, share of the top-k total."""
    named = df.filter(known(col))
    return _top_groups(named, f"{source}_artist", col, score, k, source, computed_at, _latest(df, ts))


def volume_trend(sources: dict[str, DataFrame], computed_at: str, ts: str = "ingested_at") -> DataFrame:
    """Rows per source and day."""
    daily = [
        df.groupBy(day(ts).alias("date")).agg(F.count("*").alias("cnt")).withColumn("source", F.lit(name))
        for name, df in sources.items()
    ]
    return metric_rows(
        union_rows(*daily), "volume_trend", F.col("date"), F.col("source"), F.col("cnt"), F.lit(0.0), F.lit(0.0),
        F.col("date"), computed_at,
    )


def union_rows(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def _daily_peaks(df, keys, ts):
    return df.groupBy(*keys, day(ts).alias("date")).agg(
        F.max("listeners").alias("listeners"), F.max("playcount").alias("playcount")
    )


def daily_share(df, keys: list[str], share: str, metric_type: str, computed_at: str,
                dim2: str | None = None, ts: str = "ingested_at") -> DataFrame:
    """Per entity and day the peak counts, and the share of the day's total.

    ``keys`` is ``[name]`` (second dimension a constant) or ``[name, artist]``.
    Rows come in no order: the table is merged by month, and readers sort
    the days they show.
    """
    shares = share_within(_daily_peaks(df, keys, ts), "date", share)
    second = F.lit(dim2) if len(keys) == 1 else F.col(keys[1])
    return metric_rows(
        shares, metric_type, F.col(keys[0]), second, F.col("playcount"), F.col("pct"), F.col("listeners"),
        F.col("date"), computed_at,
    )


def topn_peak_share(df, keys: list[str], metric: str, metric_type: str, computed_at: str,
                    dim2: str | None = None, k: int = 20, ts: str = "ingested_at") -> DataFrame:
    """Overall top k entities by peak metric, share of the top-k total."""
    peaks = df.groupBy(*keys).agg(
        F.max("listeners").alias("listeners"), F.max("playcount").alias("playcount")
    )
    top = share_of_total(top_k(peaks, [F.desc(metric), *keys], k), metric)
    second = F.lit(dim2) if len(keys) == 1 else F.col(keys[1])
    return metric_rows(
        top, metric_type, F.col(keys[0]), second, F.col("playcount"), F.col("pct"), F.col("listeners"),
        _latest(df, ts), computed_at,
    )


# --- other aggregates -----------------------------------------------------------

def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(value, n, pct)``; the total is a scalar, as values may be many."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    return counts.withColumn("pct", F.round(F.try_divide(F.col("n"), total) * 100, 2))


def distinct_counts(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    """One row of distinct counts; approximate ones need a single pass.

    Exact ones read one column each, so no row is multiplied by the columns.
    """
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
    counts = [df.select(c).distinct().agg(F.count(c)).scalar().alias(c) for c in cols]
    return df.sparkSession.range(1).select(*counts)


def volume_by_source(metrics: DataFrame) -> DataFrame:
    trend = metrics.filter(F.col("metric_type") == "volume_trend")
    return trend.groupBy(F.col("dim2").alias("source")).agg(F.sum("record_count").alias("total_records"))


def sentiment_summary(metrics: DataFrame) -> DataFrame:
    return metrics.filter(F.col("metric_type") == "sentiment_dist").select(
        F.col("dim2").alias("source"), F.col("dim1").alias("sentiment"),
        F.col("record_count").alias("n"), F.col("avg_score").alias("avg"),
    )


def histogram(df: DataFrame, col: str, bins: int, by: str | None = None) -> DataFrame:
    """``(by, bin, low, high, n)``: equal-width bins over each group's range,
    the last one closed; a range of one value is widened by a half on either
    side. Empty bins are left out."""
    group = F.col(by).cast("string") if by else F.lit("all")
    values = df.select(group.alias("by"), F.col(col).cast("double").alias("value")).filter("value IS NOT NULL")
    ends = F.struct(F.min("value").alias("a"), F.max("value").alias("z")).alias("ends")
    if by is None:
        ranged = values.withColumn("ends", values.agg(ends).scalar())
    else:
        ranged = values.join(broadcast_if_small(values.groupBy("by").agg(ends)), "by")
    widen = F.when(F.col("ends.a") == F.col("ends.z"), 0.5).otherwise(0.0)
    placed = ranged.select("by", "value", (F.col("ends.a") - widen).alias("first"), (F.col("ends.z") + widen).alias("last"))
    span = F.col("last") - F.col("first")
    # Values are binned where they are read: what is shuffled is a count per task, group and bin.
    return (
        placed.withColumn("bin", F.least(F.floor((F.col("value") - F.col("first")) * bins / span), F.lit(bins - 1)))
        .groupBy("by", "bin", "first", "last")
        .agg(F.count("*").alias("n"))
        .select(
            "by", "bin",
            F.round(F.col("first") + span / bins * F.col("bin"), 4).alias("low"),
            F.round(F.col("first") + span / bins * (F.col("bin") + 1), 4).alias("high"),
            "n",
        )
    )


def narrative(metrics: DataFrame, words: int = 3) -> DataFrame:
    """The numbers of the headline card, one row."""
    def of(kind, dim=None):
        same = F.col("metric_type") == kind
        return same & (F.col("dim1") == dim) if dim else same

    def pick(kind, dim, value, digits):
        return F.round(F.max(F.when(of(kind, dim), F.col(value))), digits)

    top = top_k(metrics.filter(of("top_keyword")), [F.desc("record_count"), F.asc("dim1")], words)
    keywords = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("record_count")).alias("n"), "dim1"))).alias("w"))
    text = keywords.select(F.array_join(F.transform("w", lambda w: w["dim1"]), ", ")).scalar()
    leader = F.max(F.when(of("top_artist_lastfm"), F.struct(F.col("avg_score"), F.col("dim1"))))
    return metrics.agg(
        F.sum(F.when(of("sentiment_dist"), F.col("record_count"))).alias("comments"),
        pick("sentiment_dist", "positive", "pct", 1).alias("positive_pct"),
        pick("sentiment_dist", "positive", "avg_score", 3).alias("positive_score"),
        pick("sentiment_dist", "negative", "pct", 1).alias("negative_pct"),
        leader["dim1"].alias("leader"),
        F.floor(leader["avg_score"] / 1e6).alias("leader_millions"),
    ).withColumn("keywords", text)

"""Lexicon sentiment after the published rule method (Hutto & Gilbert, 2014).

Valence of a token = lexicon value, shifted by boosters and flipped by
negations among the three tokens before it; a contrast word halves what comes
before and weighs what comes after by 1.5; the sum ``x`` becomes
``x / sqrt(x*x + 15)``. Capitals and exclamation rules are left out: the
cleaned comment is lower case without ``!``.

The lexicon is an input table ``(token, valence)`` of any size, met by a join on
the token. The scored rows are written once, with a number each; only these
numbers, single tokens and sums leave their tasks.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.session import broadcast_if_small, materialize

# Rule constants of the published method.
NORMAL = 15.0
NEGATION_FACTOR = -0.74
BOOST = 0.293
DAMPING = (1.0, 0.95, 0.9)
BEFORE_CONTRAST = 0.5
AFTER_CONTRAST = 1.5
CONTRAST = "but"

# Common negations and degree words.
NEGATIONS = [
    "aint", "arent", "cannot", "cant", "couldnt", "didnt", "doesnt", "dont",
    "hadnt", "hardly", "hasnt", "havent", "isnt", "neither", "never", "no",
    "none", "nor", "not", "nothing", "nowhere", "rarely", "seldom",
    "shouldnt", "wasnt", "werent", "without", "wont", "wouldnt",
    "ain't", "aren't", "can't", "couldn't", "didn't", "doesn't", "don't",
    "hadn't", "hasn't", "haven't", "isn't", "shouldn't", "wasn't", "weren't",
    "won't", "wouldn't",
]
BOOSTERS = {
    **dict.fromkeys([
        "absolutely", "amazingly", "completely", "deeply", "especially",
        "extremely", "highly", "hugely", "incredibly", "insanely",
        "particularly", "pretty", "really", "remarkably", "so", "super",
        "totally", "truly", "utterly", "very",
    ], BOOST),
    **dict.fromkeys([
        "almost", "barely", "fairly", "kinda", "less", "little", "mildly",
        "occasionally", "partly", "slightly", "somewhat", "sorta",
    ], -BOOST),
}

# A small list of our own for out-of-the-box use; bring a full table for work.
DEFAULT_LEXICON = {
    "amazing": 2.8, "awesome": 3.0, "awful": -2.5, "bad": -2.4, "banger": 2.2,
    "beautiful": 2.9, "best": 3.1, "bland": -1.2, "boring": -1.6, "brilliant": 2.8,
    "catchy": 1.7, "cool": 1.4, "cringe": -1.8, "disappointed": -2.0,
    "disappointing": -2.1, "dull": -1.7, "emotional": 0.8, "enjoy": 2.1,
    "enjoyed": 2.2, "excellent": 2.9, "excited": 2.0, "fantastic": 2.7,
    "favorite": 2.0, "favourite": 2.0, "flawless": 2.6, "forgettable": -1.5,
    "fun": 2.2, "generic": -1.1, "good": 1.9, "gorgeous": 2.8, "great": 3.0,
    "happy": 2.6, "hate": -2.8, "hated": -2.9, "horrible": -2.6, "incredible": 2.8,
    "interesting": 1.5, "lazy": -1.6, "liked": 1.7, "love": 3.1, "loved": 2.9,
    "lovely": 2.7, "masterpiece": 2.9, "mediocre": -1.3, "mess": -1.6,
    "nice": 1.8, "overrated": -1.7, "perfect": 2.8, "poor": -1.9, "sad": -2.0,
    "skip": -1.0, "solid": 1.3, "stunning": 2.6, "terrible": -2.4, "trash": -2.2,
    "ugly": -2.2, "underrated": 0.9, "underwhelming": -1.6, "weak": -1.7,
    "weird": -0.7, "wonderful": 2.7, "worst": -3.0, "wow": 2.4,
}


def default_lexicon(spark) -> DataFrame:
    return spark.createDataFrame(list(DEFAULT_LEXICON.items()), "token string, valence double")


def _quote(word: str) -> str:
    return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _case(words: dict[str, float], subject: str) -> str:
    """Hash-set membership per distinct value; misses leave on one test."""
    if not words:
        return "0.0D"
    by_value = defaultdict(list)
    for word, value in words.items():
        by_value[float(value)].append(_quote(word))
    known = ", ".join(_quote(w) for w in words)
    branches = " ".join(
        f"WHEN {subject} IN ({', '.join(group)}) THEN {value!r}D"
        for value, group in by_value.items()
    )
    return f"CASE WHEN {subject} NOT IN ({known}) THEN 0.0D {branches} ELSE 0.0D END"


def _contrast_weight(position: str, contrast_at: str) -> str:
    return (
        f"CASE WHEN {contrast_at} = 0 OR {position} = {contrast_at} THEN 1.0D "
        f"WHEN {position} < {contrast_at} THEN {BEFORE_CONTRAST}D ELSE {AFTER_CONTRAST}D END"
    )


def _compound(total: Column) -> Column:
    return F.round(total / F.sqrt(total * total + F.lit(NORMAL)), 4)


def lookup_valence(tokens_df: DataFrame, lexicon_df: DataFrame) -> DataFrame:
    """Keep the tokens of the lexicon, with their valence (equi join on token).

    A lexicon whose rows were counted as few is broadcast, so frequent tokens
    are not gathered anywhere; a larger one is joined by Spark's own choice.
    """
    words = lexicon_df.select("token", F.col("valence").cast("double"))
    return tokens_df.join(broadcast_if_small(words), "token")


def clean_lexicon(lexicon_df: DataFrame) -> DataFrame:
    """One row per token: rows without token or valence are ignored, of several the largest valence counts."""
    words = lexicon_df.select("token", F.col("valence").cast("double")).filter("token is not null and valence is not null")
    return words.groupBy("token").agg(F.max("valence").alias("valence"))


def _score_by_join(df, tokens, lexicon_df, negations, boosters) -> DataFrame:
    """Any lexicon size. The rows are written once, so what made their tokens
    is not repeated, and numbered there. Neighbours travel with each token, so
    the rule needs no window; a row's hits are summed in the task that read it.
    The sums are written too: their size is then known to the join that brings
    them back, which is a broadcast if they are small."""
    key = "_row"
    df = materialize(df.withColumn(key, F.monotonically_increasing_id()), "to-score")
    spread = df.filter(F.size(tokens) > 0).select(
        key,
        F.expr(f"array_position({tokens}, {_quote(CONTRAST)})").alias("but_at"),
        F.expr(
            f"inline(transform({tokens}, (t, i) -> named_struct('token', t, 'pos', i, "
            f"'p1', get({tokens}, i - 1), 'p2', get({tokens}, i - 2), 'p3', get({tokens}, i - 3))))"
        ),
    )
    words = broadcast_if_small(clean_lexicon(lexicon_df))
    boosters_in = F.col("token").isin(list(boosters)) if boosters else F.lit(False)
    hits = spread.filter(~boosters_in).join(words, "token")
    for name in ("p1", "p2", "p3"):
        marks = words.select(F.col("token").alias(name), F.lit(True).alias(f"{name}_known"))
        hits = hits.join(marks, name, "left")  # marks keeps the hint of words
    value = "valence"
    negated = ", ".join(_quote(w) for w in negations)
    for damping, name in zip(DAMPING, ("p1", "p2", "p3")):
        idle = f"({name} IS NULL OR {name}_known IS NOT NULL)"
        value = (
            f"({value} + CASE WHEN {idle} THEN 0.0D "
            f"ELSE {_case(boosters, name)} * {damping}D * sign(valence) END)"
        )
        if negations:
            value = (
                f"({value} * CASE WHEN {idle} OR {name} NOT IN ({negated}) "
                f"THEN 1.0D ELSE {NEGATION_FACTOR}D END)"
            )
    weighted = hits.withColumn("_v", F.expr(f"{value} * {_contrast_weight('pos + 1', 'but_at')}"))
    totals = materialize(weighted.groupBy(key).agg(F.sum("_v").alias("_total")), "scores")
    return (
        df.join(totals, key, "left")
        .withColumn("compound", F.coalesce(_compound(F.col("_total")), F.lit(0.0)))
        .drop("_total", key)
    )


def score_sentiment(
    df: DataFrame,
    tokens: str,
    lexicon_df: DataFrame,
    negations=NEGATIONS,
    boosters=BOOSTERS,
) -> DataFrame:
    """Add ``compound``; null or empty token arrays score 0. See ``clean_lexicon`` for odd lexicon rows."""
    return _score_by_join(df, tokens, lexicon_df, negations, boosters)


def sentiment_label(score, threshold: float = 0.05) -> Column:
    """Inclusive thresholds; missing score is neutral."""
    score = F.col(score) if isinstance(score, str) else score
    return (
        F.when(score >= threshold, "positive")
        .when(score <= -threshold, "negative")
        .otherwise("neutral")
    )

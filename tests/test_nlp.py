"""Classification, extraction and sentiment on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from cratewise.functions import sentiment as se
from cratewise.functions.nlp import with_classification, with_entities
from cratewise.functions.text import tokenize


def classify(spark, text):
    return with_classification(spark.createDataFrame([(text,)], "t string"), "t").first()


def extract(spark, text, pattern, bounded=False):
    df = spark.createDataFrame([(text, pattern)], "t string, pattern_type string")
    row = with_entities(df, "t", bounded=bounded).first()
    return row["artist"], row["song"], row["extract_confidence"]


@pytest.mark.parametrize("text, pattern, kind, confidence", [
    ("", None, "other", 0.0),
    (None, None, "other", 0.0),
    ("  \n ", None, "other", 0.0),
    ("one", None, "other", 0.05),
    ("just three words", None, "other", 0.25),
    ("artist - song", "dash", "recommendation", 0.70),
    ("hip-hop is great", "dash", "recommendation", 0.70),
    ("carmelita by warren zevon", "by", "recommendation", 0.70),
    ("Artist: song", "colon", "recommendation", 0.70),
    ("love it but long", None, "opinion", 0.05),
    ("a b c d - e f g", "dash", "mixed", 0.50),
    ("song but by someone", "by", "mixed", 0.40),
    ("a-b-c-d-e-f-g", "dash", "recommendation", 0.40),
    ("w " * 25, None, "opinion", 0.0),
    ("1 2 3 4 5 6 7 8 9 - b", None, "opinion", 0.0),
    ("1 2 3 4 5 6 7 8 - 1 2 3 4 5 6 7 8", "dash", "mixed", 0.35),
    ("- b", None, "other", 0.25),
])
def test_classification(spark, text, pattern, kind, confidence):
    row = classify(spark, text)
    assert (row["pattern_type"], row["comment_type"], row["confidence"]) == (pattern, kind, confidence)
    assert row["has_music_pattern"] == (pattern is not None)


def test_given_tokens_change_nothing(spark):
    texts = ["artist - song", "love it but long", "", "a/b & c - d's e-f-g-h", "x by y", "w " * 24 + "w"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("w", tokenize("t"))
    columns = ["t", "word_count", "has_contrast", "pattern_type", "comment_type", "confidence"]
    alone = with_classification(df, "t").select(columns).collect()
    assert with_classification(df, "t", "w").select(columns).collect() == alone


@pytest.mark.parametrize("text, pattern, expected", [
    ("a - b - c", "dash", ("a", "b - c", 1.0)),
    ("hip-hop is great", "dash", ("hip", "hop is great", 1.0)),
    ("one two three four five - 1 2 3 4 5 6 7", "dash", (None, None, 0.5)),
    ("carmelita by warren zevon", "by", ("warren zevon", "carmelita", 1.29)),
    ("Song BY The Artist", "by", ("The Artist", "Song", 1.29)),
    ("artist: song", "colon", ("artist", "song", 1.13)),
    ("Artist: song", "colon", ("Artist", "song", 1.25)),
    ("99: song", "colon", ("99", "song", 1.25)),
    ("no pattern", None, (None, None, 0.0)),
    ("no dash here", "dash", (None, None, 0.0)),
    (None, "by", (None, None, 0.0)),
])
def test_extraction(spark, text, pattern, expected):
    assert extract(spark, text, pattern) == expected


def test_bounded_confidence_stays_below_one(spark):
    assert extract(spark, "carmelita by warren zevon", "by", bounded=True)[2] == 1.0
    assert extract(spark, "Artist: song", "colon", bounded=True)[2] == 1.0
    assert extract(spark, "artist: song", "colon", bounded=True)[2] == 0.9


def test_filter_above_extraction_is_planned_small(spark):
    df = spark.createDataFrame([("x by y",)], "t string")
    marked = with_entities(with_classification(df, "t"), "t").filter("artist IS NOT NULL AND artist <> ''")
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") < 30


def by_hand(tokens, lexicon, negations, boosters):
    total, at = 0.0, tokens.index("but") if "but" in tokens else None
    for i, token in enumerate(tokens):
        if token not in lexicon or token in boosters:
            continue
        base = value = lexicon[token]
        for step, damping in ((1, 1.0), (2, 0.95), (3, 0.9)):
            before = tokens[i - step] if i >= step else None
            if before is None or before in lexicon:
                continue
            value += boosters.get(before, 0.0) * damping * math.copysign(1, base)
            if before in negations:
                value *= -0.74
        if at is not None and i != at:
            value *= 0.5 if i < at else 1.5
        total += value
    return round(total / math.sqrt(total * total + 15), 4)


TEXTS = [
    "", "great", "not great", "very good", "not very good album", "good but boring", "boring but really great great",
    "slightly bad", "never so good", "nothing here", "love love love", "i do not really love it", "but good",
    "good but", "hardly a masterpiece but fun",
]


@pytest.mark.parametrize("more", [0, 50_000])
def test_sentiment_by_hand_with_any_lexicon(spark, more):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, t string")
    ready = rows.withColumn("tokens", tokenize("t"))
    others = spark.range(more).selectExpr("concat('zz', id) AS token", "1.0D AS valence")
    scored = se.score_sentiment(ready, "tokens", se.default_lexicon(spark).unionByName(others))
    found = {r["id"]: r["compound"] for r in scored.collect()}
    expected = {
        i: by_hand(t.split(), se.DEFAULT_LEXICON, se.NEGATIONS, se.BOOSTERS) for i, t in enumerate(TEXTS)
    }
    assert found == pytest.approx(expected, abs=1.1e-4)
    assert found[1] > 0 > found[2] and found[0] == 0.0


def test_null_tokens_score_zero(spark):
    df = spark.sql("SELECT 1L AS id, CAST(NULL AS ARRAY<STRING>) AS tokens")
    row = se.score_sentiment(df, "tokens", se.default_lexicon(spark)).first()
    assert row["compound"] == 0.0


def test_parts_of_one_comment_are_scored_apart(spark):
    df = spark.createDataFrame([("c1", ["love", "it"]), ("c1", ["hate", "it"]), ("c1", ["love", "it"])], "raw_comment_id string, tokens array<string>")
    odd = spark.createDataFrame([(None, 1.0), ("love", None), ("love", 0.5)], "token string, valence double")
    found = se.score_sentiment(df, "tokens", se.default_lexicon(spark).unionByName(odd)).collect()
    by = {tuple(r.tokens): r.compound for r in found}
    assert len(found) == 3 and by["love", "it"] > 0.5 and by["hate", "it"] < -0.5


def test_label_thresholds_are_inclusive(spark):
    df = spark.createDataFrame([(0.05,), (0.049,), (-0.05,), (-0.049,), (None,)], "c double")
    labels = [r[0] for r in df.select(se.sentiment_label("c")).collect()]
    assert labels == ["positive", "neutral", "negative", "neutral", "neutral"]
    assert df.filter(F.col("c") > 1).count() == 0

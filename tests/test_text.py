"""Text functions against Python's own Unicode rules on random strings."""

import html
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from cratewise.functions import text as tx
from cratewise.functions.html import unescape_html

PIECES = [
    "a", "B", "é", "Ž", "ß", "日本", "²", "½", "Ⅳ", "٣", "_", "-", "'", "’", "/", "&", "!", "?", "#", "$", "%",
    " ", "  ", "\t", "\n", "\n\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", "​", " ", "　",
    "(", ")", ") A", ") b", ")\nZ", "[t](http://a.b/c)", "http://x.y", "www.q.z", "http", "www", "&amp;", "&#39;",
    "&quot", "&notit;", "&#x41;", "& ", "&&", "word", "Two words", " by ", " - ", ":", "😀", "́",
]


def strings(n=1500, seed=11):
    rng = random.Random(seed)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(n)]
    return ["", " ", "\n", *made]


def links(s):
    s = re.sub(r"http\S+|www\.\S+", "", s)
    return re.sub(r"\[.*?\]\(http\S+\)", "", s)


def squeeze(s):
    return " ".join(s.lower().split())


def letters(s):
    return re.sub(r"[^\w\s/&\-']", "", s)


PYTHON = {
    "strip": (tx.strip, str.strip),
    "normalize": (tx.normalize_text, squeeze),
    "links": (tx.remove_links, links),
    "punctuation": (tx.clean_punctuation, letters),
    "html": (unescape_html, html.unescape),
    "name": (tx.name_tokens, lambda s: links(letters(html.unescape(squeeze(s)))).strip()),
    "comment": (tx.clean_comment, lambda s: squeeze(letters(links(html.unescape(s))))),
    "tokens": (tx.tokenize, str.split),
    "clean_tokens": (lambda c: tx.tokenize(tx.clean_comment(c), clean=True),
                     lambda s: squeeze(letters(links(html.unescape(s)))).split()),
    "words": (tx.word_count, lambda s: len(s.split())),
    "parts": (tx.split_comment,
              lambda s: [p.strip() for p in re.split(r"\n+|(?<=\))\s+(?=[A-Z])", s) if p.strip()]),
    "blank": (tx.is_blank, lambda s: not s.strip()),
    "flair": (tx.strip_flair, lambda s: re.sub(r"^\[.*?\]\s*", "", s).strip()),
}


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, s) for i, s in enumerate(strings())]
    return spark.createDataFrame(rows, "id int, s string").repartition(4).cache()


@pytest.mark.parametrize("name", PYTHON)
def test_parity_with_python(table, name):
    function, expected = PYTHON[name]
    for row in table.select("s", function("s").alias("r")).collect():
        assert row["r"] == expected(row["s"]), repr(row["s"])


def test_golden_name_tokens(spark, fixtures):
    golden = json.loads((fixtures / "expected.json").read_text(encoding="utf-8"))["tokens"]
    rows = spark.createDataFrame(list(golden.items()), "name string, tokens string")
    wrong = rows.filter(tx.name_tokens("name") != F.col("tokens"))
    assert wrong.collect() == []


def test_null_stays_null(spark):
    row = spark.sql("SELECT CAST(NULL AS STRING) AS s").select(
        tx.clean_comment("s"), tx.name_tokens("s"), tx.strip("s"), tx.is_blank("s")
    ).first()
    assert tuple(row) == (None, None, None, True)


@pytest.mark.parametrize("text, tokens", [
    ("[]", []), ("['a', 'b']", ["a", "b"]), ('["it\'s", \'x\']', ["it's", "x"]), ("['caf\\xe9']", ["café"]),
    ("['broken", []), ("", []), (None, []), ("nonsense", []),
])
def test_parse_tokens(spark, text, tokens):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(tx.parse_tokens("s")).first()[0] == tokens


def test_token_text_survives_both_ways(table):
    tokens = tx.tokenize(tx.clean_comment("s"), clean=True)
    both = table.select(tokens.alias("a"), tx.parse_tokens(tx.format_tokens(tokens)).alias("b"))
    assert both.filter("a <> b").count() == 0


@pytest.mark.parametrize("stamp, day", [
    ("2026-05-19T18:59:00.012434+00:00", "2026-05-19"), ("2026-05-18T18:50:26.065131", "2026-05-18"),
    ("2026-05-18", "2026-05-18"), ("garbage", None), (None, None),
])
def test_day(spark, stamp, day):
    df = spark.createDataFrame([(stamp,)], "s string")
    assert df.select(tx.day("s").cast("string")).first()[0] == day

from datetime import date

import pytest
from pyspark.sql import functions as F

from cratewise import schemas
from cratewise.functions import labels as lb
from cratewise.operators import clean as cl
from cratewise.operators import dedup as dd
from cratewise.operators import explode as ex
from cratewise.operators import quality as q

from .conftest import tuples


def test_null_words(spark):
    words = [None, " NULL ", "nan", "[deleted]", "[removed]", "", " none\n", "x", " x "]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    assert [r["w"] for r in cl.normalize_nulls(df).orderBy("i").collect()] == [None] * 7 + ["x", " x "]


@pytest.mark.parametrize("text, score", [
    ("12.7", 12), ("-3.9", -3), ("", 0), ("abc", 0), (None, 0), (" 5 ", 5), ("1e3", 1000), ("NaN", 0), ("Infinity", 0),
])
def test_score(spark, text, score):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(cl.coerce_score("s")).first()[0] == score


def test_invalid_records_split_loses_no_row(spark):
    rows = [("a", 1), (" ", 5), (None, 5), ("b", 0), ("c", -1), ("d", None), ("e", 9)]
    df = spark.createDataFrame(rows, "name string, playcount long")
    valid, rejects = cl.split_invalid(df, ["name"], "playcount")
    assert tuples(valid) == [("a", 1), ("e", 9)]
    assert valid.count() + rejects.count() == len(rows)


def test_reaction_keywords_match_inside_words(spark):
    titles = ["[FRESH ALBUM] x", "deep cut", "plain title", "Slept On", None]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    assert [r[0] for r in df.select(cl.is_reaction("t")).collect()] == [True, True, False, True, False]


def test_fill_unknown_counts(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("b", "c")], "x string, y string")
    assert dict(tuples(cl.fill_counts(df, ["x", "y"]))) == {"x": 1, "y": 2}
    assert cl.fill_unknown(df, ["x", "y"]).filter("y = 'unknown'").count() == 2


def artists(spark, rows):
    return spark.createDataFrame(
        rows, "name string, name_tokens string, playcount string, listeners string, mbid string, ingested_at string, extra int")


def test_enforce_schema_modes(spark):
    df = artists(spark, [("a", "a", "1", "2", None, "2024-01-01", 1), ("b", "b", "x", "2", "m", "2024-01-01", 1),
                         (None, "c", "1", "2", "m", "2024-01-01", 1)])
    good, rejects = q.enforce_schema(df, schemas.ARTISTS, mode="rejects")
    assert good.columns == schemas.ARTISTS.names and good.schema["playcount"].dataType.simpleString() == "bigint"
    assert tuples(good) == [("a", "a", 1, 2, "unknown", "2024-01-01")]
    assert rejects.count() == 2
    assert dict(tuples(q.required_nulls(cl.cast_to(df, schemas.ARTISTS), schemas.ARTISTS)))["playcount"] == 1
    with pytest.raises(Exception, match="required field"):
        q.enforce_schema(df, schemas.ARTISTS)[0].collect()
    with pytest.raises(ValueError, match="missing"):
        q.enforce_schema(df.drop("name"), schemas.ARTISTS)


def test_later_stamp_wins_even_with_lower_count(spark):
    rows = [("a", 9, 9, "2024-01-01T08:00:00"), ("a", 5, 5, "2024-01-01T20:00:00"),
            ("a", 7, 7, "2024-01-02T01:00:00"), ("b", 3, 1, "2024-01-01T08:00:00"), ("b", 3, 2, "2024-01-01T08:00:00")]
    df = spark.createDataFrame(rows, "name string, playcount long, listeners long, ingested_at string")
    assert tuples(dd.dedup_daily(df, ["name"])) == sorted([rows[1], rows[2], rows[4]], key=repr)
    assert tuples(dd.dedup_max(df, ["name"], "playcount")) == sorted([rows[0], rows[4]], key=repr)


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(10_000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v")
    plan = dd.dedup_max(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning")  # below the exchange
    assert "WindowGroupLimit" in plan


def test_duplicate_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (2, None)], "k int, v string")
    assert tuple(dd.duplicate_report(df, ["k"]).first()) == (5, 2, 3, 40.0, 60.0)
    assert tuple(dd.duplicate_report(df.limit(0), ["k"]).first()) == (0, 0, 0, 0.0, 0.0)


def test_observed_rows(spark):
    before, seen = dd.observed(spark.range(100), "before")
    after, left = dd.observed(before.filter("id % 4 = 0"), "after")
    after.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] - left.get["rows"] == 75


@pytest.mark.parametrize("step", [1, 7_000_000_011])
def test_comment_ids_run_over_all_posts(spark, step):
    posts = [(p * step, [f"c{p}", None, " \n", f"d{p}"][: 1 + p % 4]) for p in range(300)]
    df = spark.createDataFrame(posts, "post_id long, comments array<string>").repartition(5)
    rows = ex.number_comments(df).orderBy("raw_comment_id").collect()
    expected = [(p, i, c) for p, cs in posts for i, c in enumerate(cs) if c and c.strip()]
    assert [(r["post_id"], r["comment_pos"], r["raw_comment"]) for r in rows] == expected
    assert [r["raw_comment_id"] for r in rows] == list(range(len(expected)))


def test_no_text_is_ordered_for_comment_ids(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, ["b"])], "post_id long, comments array<string>")
    plan = ex.number_comments(df)._jdf.queryExecution().optimizedPlan().toString()
    below = [x for x in plan[plan.index("Window") :].split("\n") if "Relation" in x]
    assert below and all("_post" in x and "comments" not in x for x in below)


def test_parts_keep_their_order(spark):
    df = spark.createDataFrame([(1, "Foo (x) Bar\n\nbaz"), (2, "  )  \n A) B"), (3, " \n ")], "id int, c string")
    rows = ex.explode_parts(df, "c").orderBy("id", "part_pos").collect()
    assert [(r["id"], r["part_pos"], r["c"]) for r in rows] == [
        (1, 0, "Foo (x)"), (1, 1, "Bar"), (1, 2, "baz"), (2, 0, ")"), (2, 1, "A)"), (2, 2, "B")]


def test_labels(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (5.1,)], "r double")
    assert [r[0] for r in df.select(lb.severity("r")).collect()] == ["ok", "warn", "error"]
    names = spark.createDataFrame([("n" * 22, "a"), ("n" * 23, "a")], "n string, a string")
    assert [r[0] for r in names.select(lb.track_label("n", "a")).collect()] == ["n" * 22 + "\n(a)", "n" * 22 + "…\n(a)"]


def test_first_n(spark):
    df = spark.createDataFrame([(g, i) for g in "ab" for i in range(5)], "g string, i int")
    assert tuples(dd.first_n(df, ["g"], [F.desc("i")], 2)) == [("a", 3), ("a", 4), ("b", 3), ("b", 4)]


def test_day_key_columns(spark):
    df = spark.createDataFrame([("a", "2024-01-02T03:04:05")], "name string, ingested_at string")
    assert tuple(df.select(*dd.day_key(["name"])).first()) == ("a", date(2024, 1, 2))

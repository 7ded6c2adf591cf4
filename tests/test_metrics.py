import numpy as np
import pytest
from pyspark.sql import functions as F

from cratewise.operators import metrics as m
from cratewise.operators import views as v
from cratewise.session import broadcast_if_small, spread

from .conftest import tuples

NOW = "2024-03-01T00:00:00"


@pytest.fixture(scope="module")
def comments(spark):
    rows = [
        ("2024-01-01T01:00:00", ["album", "great", "the", "ok"], "opinion", 0.2, "x", 0.5, "positive"),
        ("2024-01-01T02:00:00", ["album", "bad"], "opinion", 0.4, "unknown", -0.5, "negative"),
        ("2024-01-09T01:00:00", ["bad", "zoo"], "other", 0.0, None, 0.0, "neutral"),
        ("2024-01-09T03:00:00", [], "mixed", 0.1, "x", 0.25, "positive"),
    ]
    return spark.createDataFrame(
        rows, "ingested_at string, tokens array<string>, comment_type string, confidence double, "
              "artist string, compound double, sentiment string")


def short(df):
    return tuples(df.select("dim1", "record_count", "pct", "avg_score", "data_date"))


def test_distributions(comments):
    assert short(m.sentiment_dist(comments, "s", NOW)) == [
        ("negative", 1, 25.0, -0.5, "2024-01-09"), ("neutral", 1, 25.0, 0.0, "2024-01-09"),
        ("positive", 2, 50.0, 0.375, "2024-01-09")]
    assert short(m.comment_type_dist(comments, "s", NOW)) == [
        ("mixed", 1, 25.0, 0.1, "2024-01-09"), ("opinion", 2, 50.0, 0.3, "2024-01-09"),
        ("other", 1, 25.0, 0.0, "2024-01-09")]


def test_trends(comments):
    assert short(m.sentiment_trend(comments, "s", NOW)) == [
        ("2024-01-01", 2, 0.0, 0.0, "2024-01-01"), ("2024-01-09", 2, 0.0, 0.125, "2024-01-09")]
    assert [r[0] for r in short(m.sentiment_trend(comments, "s", NOW, grain="week"))] == ["2024-01-01", "2024-01-08"]


def test_top_keywords_break_ties_by_word(comments, spark):
    rows = m.top_keywords(comments, "s", NOW, k=3)
    assert short(rows) == [
        ("album", 2, 40.0, 0.0, "2024-01-09"), ("bad", 2, 40.0, -0.25, "2024-01-09"), ("great", 1, 20.0, 0.5, "2024-01-09")]
    stop = spark.createDataFrame([("album",)], "w string")
    assert [r[0] for r in short(m.top_keywords(comments, "s", NOW, stop, k=2))] == ["bad", "great"]


def test_top_mentions_skip_unknown(comments):
    assert short(m.top_mentions(comments, "s", NOW)) == [("x", 2, 100.0, 0.375, "2024-01-09")]


def test_empty_input_gives_no_rows(comments):
    none = comments.filter("false")
    for rows in (m.sentiment_dist(none, "s", NOW), m.top_keywords(none, "s", NOW), m.top_mentions(none, "s", NOW)):
        assert rows.count() == 0


def test_daily_share_with_a_zero_day(spark):
    rows = [("a", 10, 30, "2024-01-01T01:00:00"), ("a", 5, 40, "2024-01-01T09:00:00"),
            ("b", 1, 10, "2024-01-01T01:00:00"), ("a", 7, 0, "2024-01-02T01:00:00")]
    df = spark.createDataFrame(rows, "name string, playcount long, listeners long, ingested_at string")
    found = m.daily_share(df, ["name"], "listeners", "top", NOW, dim2="c").collect()
    assert [(r["dim1"], r["dim2"], r["record_count"], r["pct"], r["avg_score"], r["data_date"]) for r in found] == [
        ("a", "c", 10, 80.0, 40.0, "2024-01-01"), ("b", "c", 1, 20.0, 10.0, "2024-01-01"),
        ("a", "c", 7, 0.0, 0.0, "2024-01-02")]


@pytest.mark.parametrize("values, bins", [(np.arange(100.0), 7), (np.full(9, 3.0), 20), (np.array([0.0, 1.0]), 4)])
def test_histogram_equals_numpy(spark, values, bins):
    df = spark.createDataFrame([(float(x),) for x in values], "x double")
    counts, edges = np.histogram(values, bins)
    found = {r["bin"]: (r["n"], r["low"]) for r in m.histogram(df, "x", bins).collect()}
    assert {b: n for b, (n, _) in found.items()} == {b: n for b, n in enumerate(counts) if n}
    assert all(low == pytest.approx(edges[b], abs=1e-4) for b, (_, low) in found.items())


def test_narrative_without_rows(spark):
    empty = spark.createDataFrame([], "metric_type string, dim1 string, dim2 string, record_count long, pct double, "
                                      "avg_score double, data_date string, computed_at string")
    row = m.narrative(empty).first()
    assert row["positive_pct"] is None and row["keywords"] == ""


KPIS = [
    ("a", "ALL", "volume", 10.0), ("a", "ALL", "schema_compliance", 100.0), ("a", "ts", "ingestion_days", 2.0),
    ("a", "x", "null_rate", 7.0), ("a", "y", "null_rate", 7.0), ("a", "z", "null_rate", 0.0),
    ("a", "x", "outlier_rate", 20.0), ("b", "ALL", "volume", 5.0), ("b", "q", "outlier_rate", 10.0),
]


@pytest.fixture(scope="module")
def kpis(spark):
    df = spark.createDataFrame(KPIS, "source string, field_name string, kpi_type string, value double")
    return df.withColumns({"unit": F.lit("u"), "data_date": F.lit("2024-01-01"), "computed_at": F.lit(NOW)})


def test_kpi_views(kpis):
    assert tuples(v.kpi_summary(kpis)) == [("a", 10, 100.0, 2.0), ("b", 5, None, None)]
    assert tuple(v.kpi_cards(kpis).first()) == (15, 100.0, 15.0, 7.0, "x")
    flags = {(r["Source"], r["Field"], r["KPI"]): r["flag"] for r in v.kpi_table(kpis).collect()}
    assert flags[("a", "x", "null_rate")] == "high_nulls" and flags[("a", "x", "outlier_rate")] == "many_outliers"
    assert flags[("a", "ALL", "schema_compliance")] == "compliant" and flags[("b", "q", "outlier_rate")] is None
    assert kpis.agg(v.arg_max("value", "field_name")).first()[0] == "ALL"


def test_latest_run(spark):
    df = spark.createDataFrame([("m", 1, "t1"), ("m", 2, "t2"), ("n", 3, "t1")], "metric_type string, x int, computed_at string")
    assert tuples(v.latest_run(df)) == [("m", 2, "t2")]
    assert tuples(v.latest_run(df, ["metric_type"]).select("x")) == [(2,), (3,)]
    stamps = spark.createDataFrame([("2026-05-30T02:09:41.94",)], "computed_at string")
    assert v.last_updated(stamps).first()[0] == "2026-05-30  02:09 UTC"
    assert v.last_updated(stamps.filter("false")).first()[0] == "N/A"


def test_compare_sources(spark):
    pop = spark.createDataFrame([("a", 4_000_000), ("b", 2_000_000), ("c", 1)], "name string, listeners long")
    said = spark.createDataFrame([("b", 8), ("z", 9), ("c", 1)], "name string, mentions long")
    assert tuples(v.shared_entities(pop, said, k=2)) == [("b", 8)]
    assert tuples(v.compare(pop, said, k=2)) == [("a", 4.0, None, None), ("b", 2.0, 8, 4.0)]


def test_broadcast_only_below_the_bound(spark):
    table = spark.range(50)
    hinted = [broadcast_if_small(table, limit)._jdf.queryExecution().analyzed().toString() for limit in (50, 49)]
    assert ["ResolvedHint" in plan for plan in hinted] == [True, False]


def test_spread_leaves_large_tables(spark, monkeypatch):
    table = spark.range(1000).coalesce(1)
    assert spread(table).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr("cratewise.session.SPREAD_LIMIT", 10)
    assert spread(table) is table


def test_source_labels(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    assert [r["label"] for r in v.label(df, "c", {"x": "Ex"}).collect()] == ["Ex", "y", None]

"""Stored sketches: merged ranges against numpy and plain sets."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from cratewise.operators import sketches as sk

DAYS = [datetime.date(2024, 1, d) for d in range(1, 11)]


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(3)
    return {(s, d): np.exp(rng.normal(i, 1 + (s == "b"), 2000)) for s in ("a", "b") for i, d in enumerate(DAYS)}


@pytest.fixture(scope="module")
def stored(spark, values, tmp_path_factory):
    rows = [(s, d, float(x), None) for (s, d), xs in values.items() for x in xs]
    rows += [("a", DAYS[0], None, None), ("a", DAYS[0], float("nan"), None)]
    df = spark.createDataFrame(rows, "s string, d date, x double, none double").repartition(6)
    path = str(tmp_path_factory.mktemp("sketches") / "q")
    sk.quantile_sketches(df, F.col("s"), F.col("d"), ["x", "none"]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("since, until", [(None, None), ("2024-01-03", "2024-01-06"), ("2024-01-10", None)])
def test_ranks_of_any_range(stored, values, since, until):
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    found = {(r["source"], r["field"]): r for r in sk.sketch_quantiles(sk.merged_quantiles(stored, since, until), probs).collect()}
    assert set(found) == {(s, f) for s in "ab" for f in ("x", "none")}
    days = [d for d in DAYS if (since or "") <= str(d) <= (until or "9")]
    for s in "ab":
        own = np.concatenate([values[s, d] for d in days])
        row = found[s, "x"]
        assert (row["days"], row["n"], row["low"], row["high"]) == (len(days), len(own), own.min(), own.max())
        assert [np.mean(own <= v) for v in row["quantiles"]] == pytest.approx(probs, abs=2 * sk.rank_error())
        assert found[s, "none"]["n"] == 0 and found[s, "none"]["quantiles"] is None


def test_outliers_without_rows(stored, values):
    found = {(r["source"], r["field"]): r for r in sk.history_outliers(sk.merged_quantiles(stored, "2024-01-02", "2024-01-05")).collect()}
    for s in "ab":
        own = np.concatenate([values[s, d] for d in DAYS[1:5]])
        row = found[s, "x"]
        outside = 100 * np.mean((own < row["lo"]) | (own > row["hi"]))
        assert row["rate"] == pytest.approx(outside, abs=400 * sk.rank_error())
        assert found[s, "none"]["rate"] is None


def test_constant_column_has_no_outliers(spark):
    df = spark.range(100).select(F.lit("s").alias("s"), F.lit(4).alias("x"))
    merged = sk.merged_quantiles(sk.quantile_sketches(df, F.col("s"), F.lit("2024-01-01").cast("date"), ["x"]))
    assert sk.history_outliers(merged).first()["rate"] == 0.0


def test_a_smaller_sketch_has_a_larger_error():
    assert sk.rank_error(200) == pytest.approx(0.0133, abs=1e-4)
    assert sk.distinct_error(10) > sk.distinct_error(12)


def _sets(spark, sizes, log):
    rows = spark.range(sizes[0]).select(F.lit("a").alias("s"), F.col("id").alias("x")).unionByName(
        spark.range(sizes[0] // 2, sizes[0] // 2 + sizes[1]).select(F.lit("b").alias("s"), F.col("id").alias("x")))
    rows = rows.withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("x") % 10).cast("int")))
    return sk.distinct_sketches(rows.unionByName(rows), F.col("s"), F.col("d"), F.col("x"), log)


def test_few_items_are_counted_exactly(spark):
    sketches = _sets(spark, (1000, 800), 12)
    found = {r["source"]: r for r in sk.shared_with(sk.merged_distinct(sketches), "a").collect()}
    assert (found["b"]["days"], found["b"]["items"], found["b"]["shared"], found["b"]["shared_error"]) == (10, 800, 500, 0.0)
    some = sk.merged_distinct(sketches, "2024-01-01", "2024-01-05")
    assert {r["source"]: (r["days"], r["items"]) for r in some.collect()} == {"a": (5, 500), "b": (5, 400)}
    assert [r["shared"] for r in sk.shared_with(some, "missing").collect()] == [None, None]


def test_many_items_within_the_error(spark):
    found = {r["source"]: r for r in sk.shared_with(sk.merged_distinct(_sets(spark, (60_000, 50_000), 10), log=10), "a", 10).collect()}
    assert found["b"]["items"] == pytest.approx(50_000, rel=4 * sk.distinct_error(10))
    assert found["b"]["shared"] == pytest.approx(30_000, abs=4 * found["b"]["shared_error"])
    assert found["b"]["shared_error"] > 0


def test_no_rows(spark):
    none = spark.createDataFrame([], "s string, d date, x long")
    assert sk.history_outliers(sk.merged_quantiles(sk.quantile_sketches(none, F.col("s"), F.col("d"), ["x"]))).count() == 0
    assert sk.shared_with(sk.merged_distinct(sk.distinct_sketches(none, F.col("s"), F.col("d"), F.col("x"))), "a").count() == 0

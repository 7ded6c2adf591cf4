"""KPIs and quantiles, against numpy and against the golden report."""


import numpy as np
import pytest

from cratewise.operators import quality as q
from cratewise.operators import quantiles as qt

from .conftest import tuples

PROBS = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
RNG = np.random.default_rng(5)
SAMPLES = {
    "uniform": RNG.random(30_000),
    "heavy tail": np.exp(RNG.normal(0, 6, 20_000)),
    "a third equal": np.where(RNG.random(30_000) < 0.34, 7.0, RNG.normal(7, 1, 30_000)),
    "few values": RNG.integers(0, 5, 10_000).astype(float),
    "constant": np.full(1000, 3.25),
    "one": np.array([4.5]),
    "two": np.array([1.0, 2.0]),
    "negative": -RNG.random(5000) * 1e9,
    "huge range": np.concatenate([RNG.random(5000), [1e300, -1e300]]),
}


@pytest.mark.parametrize("name", SAMPLES)
def test_exact_quantiles_equal_numpy(spark, name):
    values = SAMPLES[name]
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(4)
    found = qt.exact_quantiles(df, ["x"], PROBS)["x"]
    assert found == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12, abs=1e-12)


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (3.0, None)], "a double, b double")
    assert qt.exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [2.0], "b": [None]}


def test_cap_and_iqr_table(spark):
    values = [*range(1, 12), 1000]
    df = spark.createDataFrame([(v,) for v in values], "x long")
    q1, q3 = np.quantile(values, [0.25, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    capped = sorted(r[0] for r in qt.cap_outliers(df, ["x"]).select("x_capped").collect())
    assert capped == pytest.approx(sorted(np.clip(values, lo, hi)))
    row = qt.iqr_table(df, ["x"]).first()
    assert (row["n_out"], row["rate"], row["lo_whisker"], row["hi_whisker"]) == (1, 8.33, 1.0, 11.0)


def test_constant_column_has_no_outliers(spark):
    df = spark.createDataFrame([(5.0,)] * 9 + [(5.0,)], "x double")
    assert tuples(qt.outlier_rates(df, ["x"])) == [("x", 0.0)]


def test_rates(spark):
    df = spark.createDataFrame([("a", None), ("", "unknown"), (None, "z"), ("b", "unknown")], "x string, y string")
    assert {r["field"]: (r["n"], r["rate"]) for r in q.null_rates(df).collect()} == {"x": (2, 50.0), "y": (1, 25.0)}
    assert {r["field"]: r["n"] for r in q.null_rates(df, blanks=False).collect()} == {"x": 1, "y": 1}
    assert tuple(q.compliance(df).first()) == (4, 2, 50.0)
    assert tuple(q.compliance(df, ["x"]).first()) == (4, 3, 75.0)
    report = {r["field"]: tuple(r)[1:] for r in q.relevant_nulls(q.null_unknown_rates(df)).collect()}
    assert report == {"x": (1, 25.0, 0, 0.0), "y": (1, 25.0, 2, 50.0)}


def test_empty_source_has_no_rows(spark):
    df = spark.createDataFrame([], "name string, playcount long, ingested_at string")
    assert q.governance_report(df, "s", ["playcount"], ["name"], "now").count() == 0
    assert q.governance_report(df, "s", [], [], "now").count() == 0


def test_report_reads_the_source_twice(spark, tmp_path):
    """Count the rows that pass the source, not the plan's text."""
    df = spark.range(1000).selectExpr(
        "CAST(id AS STRING) AS name", "id AS playcount", "id AS listeners", "'2024-01-01T00:00:00' AS ingested_at")
    passed = spark.sparkContext.accumulator(0)

    def tally(batches):
        for batch in batches:
            passed.add(len(batch))
            yield batch

    counted = df.mapInPandas(tally, df.schema)
    report = q.governance_report(counted, "s", ["playcount", "listeners"], ["name"], "now")
    assert len(report.collect()) == 1 + 4 + 1 + 2 + 4 + 1
    assert passed.value == 2000


def test_ingestion_gaps_and_days(spark):
    days = ["2024-02-27T01:00:00", "2024-02-28T01:00:00", "2024-03-02T01:00:00", "2024-03-02T05:00:00"]
    df = spark.createDataFrame([(d,) for d in days], "ingested_at string")
    assert [str(r[0]) for r in q.ingestion_gaps(df).orderBy("day").collect()] == ["2024-02-29", "2024-03-01"]
    assert q.ingestion_days(df).first()[0] == 3


def test_text_lengths(spark):
    df = spark.createDataFrame([("ab",), ("abcd",), ("é😀x",), (None,)], "t string")
    assert tuples(q.text_length_kpis(df, ["t"])) == [
        ("t", "text_len_max", 4.0), ("t", "text_len_mean", 3.0), ("t", "text_len_median", 3.0), ("t", "text_len_min", 2.0)]
    assert tuple(q.text_length_exact(df, ["t"]).first()) == ("t", 3.0, 3.0, 2, 4)


def test_run_summary(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", 5, "x")], "name string, plays long, mbid string")
    row = q.run_summary(df, top=q.top_name("name", "plays"), with_artist=q.with_artist("mbid")).first()
    assert tuple(row) == (2, 3, 1, "b", 1)


@pytest.mark.parametrize("name", SAMPLES)
def test_large_brackets_are_cut_again(spark, monkeypatch, name):
    monkeypatch.setattr(qt, "SMALL", 20)
    values = SAMPLES[name]
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(4)
    found = qt.exact_quantiles(df, ["x"], [0.25, 0.5])["x"]
    assert found == pytest.approx(np.quantile(values, [0.25, 0.5]).tolist(), rel=1e-12, abs=1e-12)


def test_ranks_in_two_far_clusters(spark, monkeypatch):
    monkeypatch.setattr(qt, "SMALL", 100)
    values = [*map(float, range(500)), *map(float, range(10**6, 10**6 + 500))]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    first = qt._first_brackets(df, ["x"], [0.5])
    assert [tuple(b["solved"]) for b in first] == [(499.0, 1e6)]
    assert qt.exact_quantiles(df, ["x"], PROBS)["x"] == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12)


def test_infinite_values(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.0,), (2.0,), (3.0,)], "x double")
    assert qt.exact_quantiles(df, ["x"], [0.5, 0.25]) == {"x": [2.0, 1.0]}

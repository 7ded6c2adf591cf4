"""Quantiles and distinct counts over any days, from sketches stored per source and day.

The rows of a day are read once, when they arrive; what is kept is one small row
per source, day and column. Any range of days is then a merge of these rows: its
cost depends on the number of days, not on the rows behind them, and a corrected
day replaces its own sketches only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.operators.quantiles import fences

# Size of a quantile sketch and, as a power of two, of a distinct-count sketch.
KLL_K = 1024
THETA_LOG = 12


def rank_error(k: int = KLL_K) -> float:
    """Published error of a KLL sketch: the rank of a quantile is within it in 99 of 100 cases."""
    # Factor and exponent of the published fit.
    return 2.296 / k**0.9723


def distinct_error(log: int = THETA_LOG) -> float:
    """Relative standard error of a theta sketch; with fewer than ``2**log`` distinct values it is exact."""
    return 1 / (2**log - 1) ** 0.5


def _in_range(sketches: DataFrame, since: str | None, until: str | None) -> DataFrame:
    """Days from ``since`` to ``until``, both included; the bounds reach the scan."""
    for bound, test in ((since, F.col("day") >= F.to_date(F.lit(since))), (until, F.col("day") <= F.to_date(F.lit(until)))):
        if bound is not None:
            sketches = sketches.filter(test)
    return sketches


# --- quantiles -------------------------------------------------------------------

def quantile_sketches(df: DataFrame, source: Column, day: Column, cols: list[str], k: int = KLL_K) -> DataFrame:
    """``(source, day, field, n, low, high, sketch)``: one row per source, day and column.

    Null and NaN are missing values. A column without values has n = 0 and null
    ends. A null source or day is a group of its own.
    """
    names = {f"v{i}": c for i, c in enumerate(cols)}
    numbers = df.select(
        source.alias("source"), day.alias("day"),
        *[F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(v) for v, c in names.items()],
    )
    # All columns of a group are one pass and one aggregate; no row is multiplied by the columns.
    facts = [
        F.struct(
            F.lit(c).alias("field"), F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"),
            F.kll_sketch_agg_double(v, k).alias("sketch"),
        ).alias(v)
        for v, c in names.items()
    ]
    return numbers.groupBy("source", "day").agg(*facts).select("source", "day", F.inline(F.array(*names)))


def merged_quantiles(sketches: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """``(source, field, days, n, low, high, sketch)`` of a range of days."""
    return _in_range(sketches, since, until).groupBy("source", "field").agg(
        F.count("*").alias("days"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def sketch_quantiles(merged: DataFrame, probs: list[float]) -> DataFrame:
    """``merged`` with ``quantiles`` in the order of ``probs`` instead of the sketch; null without values."""
    grid = F.array(*[F.lit(float(p)) for p in probs])
    found = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", grid))
    return merged.withColumn("quantiles", found).drop("sketch")


def history_outliers(merged: DataFrame, steps: int = 1000) -> DataFrame:
    """``(source, field, n, q1, med, q3, iqr, lo, hi, rate)``: fences of a range of days and the share of its
    values outside, in percent, both from the sketch: no row is read again. The share is that of ``steps``
    evenly spaced ranks, so its error is twice the sketch's and one step. Without spread the rate is 0,
    without values null."""
    ranks = sketch_quantiles(merged.withColumn("kept", F.col("sketch")), [(i + 0.5) / steps for i in range(steps)])
    ranks = ranks.withColumnsRenamed({"quantiles": "ranks", "kept": "sketch"})
    # The key and the ranks go through as one field.
    box = fences(sketch_quantiles(ranks, [0.25, 0.5, 0.75]).withColumn("field", F.struct("source", "field", "ranks")))
    outside = F.size(F.filter("field.ranks", lambda x: (x < F.col("lo")) | (x > F.col("hi"))))
    rate = F.when(F.col("n") == 0, None).when(F.col("iqr") == 0, 0.0).otherwise(F.round(outside * 100 / F.lit(steps), 4))
    return box.select(
        "field.source", "field.field", "n", "q1", "med", "q3", "iqr", "lo", "hi", rate.alias("rate"))


# --- distinct counts ----------------------------------------------------------------

def distinct_sketches(df: DataFrame, source: Column, day: Column, item: Column, log: int = THETA_LOG) -> DataFrame:
    """``(source, day, sketch)``: the distinct items of each source and day; null is no item."""
    rows = df.select(source.alias("source"), day.alias("day"), item.alias("item"))
    return rows.groupBy("source", "day").agg(F.theta_sketch_agg("item", log).alias("sketch"))


def merged_distinct(sketches: DataFrame, since: str | None = None, until: str | None = None, log: int = THETA_LOG) -> DataFrame:
    """``(source, days, items, sketch)``: distinct items of each source over a range of days."""
    merged = _in_range(sketches, since, until).groupBy("source").agg(
        F.count("*").alias("days"), F.theta_union_agg("sketch", log).alias("sketch"))
    return merged.select("source", "days", F.theta_sketch_estimate("sketch").alias("items"), "sketch")


def shared_with(merged: DataFrame, one: str, log: int = THETA_LOG) -> DataFrame:
    """``(source, days, items, shared, shared_error)``: the items that each source has in common with source
    ``one``, and the standard error of that number, which depends on the union of both. Without ``one`` in
    the table the last two are null. Its sketch reaches the others as one scalar."""
    other = merged.filter(F.col("source") == one).agg(F.max("sketch")).scalar()
    both = merged.withColumn("other", other)
    union = F.theta_sketch_estimate(F.theta_union("sketch", "other", log))
    return both.select(
        "source", "days", "items",
        F.theta_sketch_estimate(F.theta_intersection("sketch", "other")).alias("shared"),
        F.when(union >= 2**log, union * distinct_error(log)).when(union.isNotNull(), 0.0).alias("shared_error"),
    )

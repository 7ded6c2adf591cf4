"""Deduplication and first-per-group operators.

``row_number() <= n`` is planned with a group limit in front of the shuffle:
each map task keeps at most n rows per key, so a key that holds a third of
all rows never reaches one task whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from cratewise.functions.text import day


def _columns(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def first_n(df: DataFrame, group: list, order: list, n: int) -> DataFrame:
    """First ``n`` rows of every group by ``order``."""
    rank = F.row_number().over(Window.partitionBy(*_columns(group)).orderBy(*_columns(order)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def first_per_key(df: DataFrame, keys: list, order: list) -> DataFrame:
    return first_n(df, keys, order, 1)


def dedup_first(df: DataFrame, keys: list, order: list) -> DataFrame:
    return first_per_key(df, keys, order)


def dedup_exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedup_latest(df: DataFrame, keys: list, ts: str, ties: list | None = None) -> DataFrame:
    """Latest ``ts`` per key; ties by the given columns, largest first, then
    by all remaining columns so that the result never depends on row order."""
    ties = list(ties or [])
    rest = [c for c in df.columns if c != ts and c not in ties]
    order = [F.col(c).desc_nulls_last() for c in [ts, *ties, *rest]]
    return first_per_key(df, keys, order)


def dedup_max(df: DataFrame, keys: list, metric: str) -> DataFrame:
    """Highest ``metric`` per key; ties by all remaining columns."""
    return dedup_latest(df, keys, metric)


def day_key(names: list[str], ingested_at: str = "ingested_at") -> list[Column]:
    """Key of a daily snapshot: the names plus the day of the stamp."""
    return [*_columns(names), day(ingested_at)]


def dedup_daily(df: DataFrame, names: list[str], ingested_at: str = "ingested_at") -> DataFrame:
    """Latest snapshot per entity and day; ties keep the most played."""
    ties = [c for c in ("playcount", "listeners") if c in df.columns]
    return dedup_latest(df, day_key(names, ingested_at), ingested_at, ties)


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Exact and per-key duplicate counts and rates, one row.

    Two nested groupings instead of two distinct counts: equal rows collapse
    before the first shuffle, and no row is expanded per aggregate.
    """
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    groups = rows.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.count("*").alias("_rows"))
    totals = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("_n") - F.sum("_rows"), F.lit(0)).alias("exact_dups"),
        F.coalesce(F.sum("_n") - F.count("*"), F.lit(0)).alias("key_dups"),
    )
    def share(c):
        return F.coalesce(F.round(F.try_divide(F.col(c), F.col("total")) * 100, 2), F.lit(0.0))

    return totals.select(
        "*", share("exact_dups").alias("exact_rate"), share("key_dups").alias("key_rate")
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass this point of the job, without another job.

    The observation is filled once an action has run on the returned frame;
    the rows a step removed are the difference of two observations.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen

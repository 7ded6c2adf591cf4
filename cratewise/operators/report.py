"""What each step of a job let through, counted by the job itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT = "step int, name string, rows long, removed long, nulls long"


class Steps:
    """Counts rows, and nulls of required columns, where they pass; no pass of its own.

    The counts are there once the job that reads the frames has run. ``report``
    keeps the order in which the steps were named; a step's ``removed`` rows are
    those of the step before that it did not let through (fewer than none where
    a step makes several rows of one).
    """

    def __init__(self) -> None:
        self.seen: list[tuple[str, Observation]] = []

    def see(self, name: str, df: DataFrame, required: list[str] | None = None) -> DataFrame:
        seen = Observation()
        nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in required or []]
        self.seen.append((name, seen))
        return df.observe(seen, F.count("*").alias("rows"), *nulls)

    def counts(self) -> dict[str, int]:
        """``rows_<step>`` of every step and ``nulls_<column>`` of the required columns."""
        found = {}
        for name, seen in self.seen:
            values = dict(seen.get)
            found[f"rows_{name}"] = values.pop("rows")
            found |= values
        return found

    def report(self, spark: SparkSession) -> DataFrame:
        rows, before = [], None
        for i, (name, seen) in enumerate(self.seen):
            values = dict(seen.get)
            count = values.pop("rows")
            rows.append((i, name, count, 0 if before is None else before - count, sum(values.values())))
            before = count
        return spark.createDataFrame(rows, REPORT)

"""Tables that change in one step.

A table is a folder of runs and a folder of numbered manifests. A run writes the
parts it touches (months, days, batches) into a folder of its own, which nobody
reads yet; then a manifest that names the folder of every part appears by a
rename. Readers take their folders from the manifest with the largest number, so
they see all of a run or nothing of it, whenever its driver dies. Folders that
neither the last manifest nor the one before it names are removed afterwards, by
this run or, if it dies, by the next one. A table has one writer at a time; a
second one fails, as its manifest's number is taken.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cratewise import files
from cratewise.operators.dedup import dedup_latest
from cratewise.operators.report import Steps
from cratewise.session import staged

DATA, MANIFESTS, NO_PART = "data", "manifests", "none"


class GateFailed(ValueError):
    """A run did not meet its gate; nothing was published."""


@dataclass(frozen=True)
class Version:
    """What a manifest says: the folder of each part, and how far each feeding query has come."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    marks: dict[str, int] = field(default_factory=dict)


def _manifests(path: str) -> list[str]:
    return [n for n in files.names(f"{path}/{MANIFESTS}") if n.endswith(".json") and not n.startswith(".")]


def _version(path: str, name: str) -> Version:
    return Version(**json.loads(files.read_text(f"{path}/{MANIFESTS}/{name}")))


def current(path: str) -> Version:
    """The last published version; a table that was never published is version 0."""
    found = _manifests(path)
    return _version(path, found[-1]) if found else Version()


def read_published(spark: SparkSession, path: str, schema: StructType, since: str | None = None, parts: list[str] | None = None) -> DataFrame:
    """The last version, or of it the parts from ``since`` on (labels in text order), or the named ``parts``."""
    folders = [
        f"{path}/{folder}" for part, folder in sorted(current(path).parts.items())
        if (since is None or part >= since) and (parts is None or part in parts)
    ]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def publish_months(
    rows: DataFrame, path: str, key: list[str] | None = None, gate: Callable[[dict[str, int]], str | None] | None = None,
    required: list[str] | None = None,
) -> Version:
    """Publish gold rows by the month of their ``data_date`` (``yyyy-MM``).

    The identity of a row is every column but ``computed_at`` (a re-run with a
    changed value keeps both rows), or ``key`` when given; the last run of an
    identity stays.
    """
    identity = key or [c for c in rows.columns if c != "computed_at"]

    def dedup(df: DataFrame) -> DataFrame:
        if key is None:
            return df.groupBy(*identity).agg(F.max("computed_at").alias("computed_at")).select(*df.columns)
        return dedup_latest(df, identity, "computed_at")

    month = F.date_format(F.col("data_date").try_cast("date"), "yyyy-MM")
    return publish(rows, path, month, dedup, gate, required)


def clean(path: str) -> None:
    """Remove the folders of runs that the last two versions do not name, and older manifests."""
    found = _manifests(path)
    named = {folder.split("/")[1] for name in found[-2:] for folder in _version(path, name).parts.values()}
    for run in files.names(f"{path}/{DATA}"):
        if run not in named:
            files.delete_tree(f"{path}/{DATA}/{run}")


def publish(
    rows: DataFrame, path: str, part: Column, dedup: Callable[[DataFrame], DataFrame],
    gate: Callable[[dict[str, int]], str | None] | None = None, required: list[str] | None = None, mark: tuple[str, int] | None = None,
) -> Version:
    """Merge ``rows`` into the parts that they touch and publish the new version.

    ``part`` labels a row's part; labels are few (calendar units, batches).
    ``gate`` sees the counts of the write itself (``rows_in``, ``rows_old``,
    ``rows_out``, and ``nulls_<c>`` of the ``required`` columns) and names what is
    wrong; then :class:`GateFailed` is raised and the old version stays. ``mark``
    is a feeding query and its batch: a batch at or before the query's last one
    is already in the table and changes nothing. No rows publish no part.
    """
    spark, now = rows.sparkSession, current(path)
    if mark is not None and now.marks.get(mark[0], -1) >= mark[1]:
        return now
    steps = Steps()
    label = F.coalesce(part.cast("string"), F.lit(NO_PART)).alias("part")
    with staged(steps.see("in", rows.select("*", label)), "publish") as new:
        touched = [r[0] for r in new.select("part").distinct().collect()]
        old = read_published(spark, path, rows.schema, parts=touched)
        merged = dedup(steps.see("old", old).unionByName(new.drop("part")))
        run = f"{DATA}/{now.number + 1:08}-{uuid.uuid4().hex}"
        out = steps.see("out", merged, required or []).select("*", label)
        if touched:
            out.hint("rebalance", "part").write.partitionBy("part").parquet(f"{path}/{run}")
    if gate is not None:
        counts = steps.counts() if touched else {"rows_in": 0, "rows_old": 0, "rows_out": 0}
        wrong = gate(counts)
        if wrong:
            raise GateFailed(f"{path}: {wrong} ({counts})")
    parts = now.parts | {p: f"{run}/part={p}" for p in touched}
    marks = now.marks | ({mark[0]: mark[1]} if mark is not None else {})
    version = Version(now.number + 1, parts, marks)
    files.write_new(f"{path}/{MANIFESTS}/{version.number:08}.json", json.dumps(version.__dict__))
    clean(path)
    return version

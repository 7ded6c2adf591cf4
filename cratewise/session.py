"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.files import delete_tree


def prepare(spark: SparkSession) -> SparkSession:
    """Day boundaries are UTC days, whatever zone the cluster runs in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="cratewise-")


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``; only a local session
    (tests, laptop) may fall back to a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` only when a bounded count proves it small.

    Past the bound the frame is returned without a hint, so the join falls
    back to whatever Spark picks from the sizes it measures (shuffle join
    with adaptive skew handling).
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the table.

    Cuts the lineage, so several reads neither repeat the work nor depend on
    executors that may be gone by then.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As ``materialize`` for the length of a block; the table is then deleted
    (a stream would otherwise leave one behind per batch)."""
    spark = df.sparkSession
    path = work_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_tree(path)


# Below this size dealing rows out costs less than leaving cores idle.
SPREAD_LIMIT = 256 * 1024 * 1024


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small table out to all cores.

    A small Parquet file is one row group, hence one task, and text work on
    it would use one core. The size Spark knows of the input is checked
    first: a larger table has splits enough and is never moved.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SPREAD_LIMIT:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)

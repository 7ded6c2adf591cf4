"""Written tables between the steps of an operator.

A step whose result is read more than once, or that must not be repeated when
an executor is lost, is written to the shared folder and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.session import shared_dir


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors can reach; a local
    session without the setting gets one of its own."""
    return shared_dir(spark)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read back: no lineage, no executor's copy."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it: helper columns never meet the user's."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable id of each id in ``links`` (a, b): columns ``id``, ``component``.

    Alternates large-star and small-star steps (every neighbour is tied to the
    smallest one) until each id has one link, to an id that has none itself; the
    number of rounds grows with the logarithm of the longest chain, and links that
    are such stars already need none. Each step is an aggregation and a join, both
    of which spread a hot id, and is written once.
    """
    def tied(near: DataFrame) -> DataFrame:
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return near.join(least, "a")

    def unsettled(df: DataFrame) -> bool:
        ends = df.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            df.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return ends.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0] > 0

    # From here on a link goes from the larger id to the smaller one.
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = written(links.distinct(), "links")
    while unsettled(links):
        # Large star: neighbours above a are tied to the least around a.
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = tied(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "large")
        # Small star: a and its neighbours below it are tied to the least of them.
        star = tied(large)
        small = star.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(star.select("a", F.col("m").alias("b")))
        links = written(small.filter("a <> b").distinct(), "links")
    # Steps keep what is connected, so every id is still in a link.
    found = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return found.unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())

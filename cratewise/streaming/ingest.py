"""New files only: snapshots to daily silver, and running daily volumes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cratewise.functions.text import day
from cratewise.operators.dedup import dedup_latest
from cratewise.session import staged
from cratewise.sources.bronze import explode_records, split_errors
from cratewise.sources.published import publish
from cratewise.sources.tables import merge_partitions


# Columns of an envelope that was turned away.
REJECTS = StructType([StructField("file", StringType()), StructField("code", LongType()), StructField("message", StringType())])


def snapshot_stream(
    spark: SparkSession, folder: str, schema: StructType, data_key: str, record_key: str,
    files_per_batch: int = 1000,
) -> DataFrame:
    """``(record, ingested_at)`` of the snapshot files that appear in a folder."""
    raw = (
        spark.readStream.schema(schema).option("multiLine", True)
        .option("maxFilesPerTrigger", files_per_batch).json(folder)
    )
    ok, _ = split_errors(raw.withColumn("file", F.lit(None).cast("string")))
    return explode_records(ok, data_key, record_key)


def envelope_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000, lines: bool = False) -> DataFrame:
    """The envelopes of the snapshot files that appear in a folder, each with its file's path."""
    raw = (
        spark.readStream.schema(schema).option("multiLine", not lines).option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch).json(folder)
    )
    return raw.withColumn("file", raw.metadataColumn("_metadata")["file_path"])


def ingest_with_rejects(
    envelopes: DataFrame, silver: str, rejects: str, checkpoint: str, flatten: Callable[[DataFrame], DataFrame], data_key: str, record_key: str,
    keys: list[str], name: str = "ingest", gate: Callable[[dict[str, int]], str | None] | None = None,
) -> StreamingQuery:
    """One stream into two published tables: the latest record per (keys, day), and the rejects.

    ``envelopes`` comes from ``envelope_stream``; ``flatten`` makes table rows of
    ``(record, ingested_at)``. An envelope with an error or without metadata is
    a reject ``(file, code, message)``. Both tables remember the last batch of
    the query ``name`` in the manifest that its rows appear with, so a batch that
    is run again, after a failure between the two or otherwise, adds nothing.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        with staged(batch, "envelopes") as rows:
            ok, damaged = split_errors(rows)
            part = F.lit(f"{name}-{batch_id:010}")
            publish(damaged, rejects, part, lambda df: df, mark=(name, batch_id))
            flat = flatten(explode_records(ok, data_key, record_key)).withColumn("day", day("ingested_at"))

            def keep_latest(df: DataFrame) -> DataFrame:
                return dedup_latest(df, [*keys, "day"], "ingested_at", [c for c in ("playcount", "listeners") if c in df.columns])

            publish(keep_latest(flat), silver, F.col("day"), keep_latest, gate=gate, required=keys, mark=(name, batch_id))

    return (
        envelopes.writeStream.queryName(name).foreachBatch(run)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def ingest_stream(
    rows: DataFrame, dst: str, checkpoint: str, keys: list[str], ts: str = "ingested_at",
    ties: list[str] | None = None,
) -> StreamingQuery:
    """Keep the latest row per (keys, day) in a table partitioned by ``day``.

    Each batch merges into the days it touches, so late files and rows of
    earlier batches meet; a replayed batch changes nothing. Runs until all
    files present are processed, then stops.
    """
    ties = ties if ties is not None else [c for c in ("playcount", "listeners") if c in rows.columns]

    def keep_latest(df: DataFrame) -> DataFrame:
        return dedup_latest(df, [*keys, "day"], ts, ties)

    def merge(batch: DataFrame, batch_id: int) -> None:
        # Rows of one batch collapse before they are staged for the merge.
        merge_partitions(keep_latest(batch.withColumn("day", day(ts))), dst, ["day"], keep_latest)

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_volume_stream(
    rows: DataFrame, ts: str, watermark: str, source: str = "source", score: str | None = None,
) -> DataFrame:
    """Rows (and mean score) per source and day; state is dropped once a day
    is older than the watermark."""
    aggregates = [F.count("*").alias("record_count")]
    if score:
        aggregates.append(F.avg(score).alias("avg_score"))
    return (
        rows.withWatermark(ts, watermark)
        .groupBy(F.window(ts, "1 day").alias("w"), source)
        .agg(*aggregates)
        .select(F.to_date("w.start").alias("day"), *[c for c in [source, "record_count", *(["avg_score"] if score else [])]])
    )


def write_daily_volume(volumes: DataFrame, dst: str, checkpoint: str, source: str = "source") -> StreamingQuery:
    """Upsert the running volumes: the newest state of a (day, source) wins.

    A count only grows while its day is open, so the largest one is the
    newest; a replayed batch changes nothing.
    """
    def newest(df: DataFrame) -> DataFrame:
        return dedup_latest(df, ["day", source], "record_count")

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_partitions(batch, dst, ["day"], newest)

    return (
        volumes.writeStream.outputMode("update").foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

"""Streams end with the batch result, over several batches and replays."""

import json

import pytest
from pyspark.sql import functions as F

from cratewise import schemas
from cratewise.operators.dedup import dedup_daily
from cratewise.sources import bronze, tables
from cratewise.streaming.ingest import daily_volume_stream, ingest_stream, snapshot_stream, write_daily_volume

from .conftest import tuples


def write(folder, name, stamp, rows):
    artists = [{"name": n, "playcount": str(p), "listeners": "1", "mbid": ""} for n, p in rows]
    doc = {"_metadata": {"ingested_at": stamp}, "data": {"artists": {"artist": artists}}}
    (folder / name).write_text(json.dumps(doc))


def run(spark, src, dst, checkpoint):
    stream = snapshot_stream(spark, str(src), schemas.ARTIST_SNAPSHOT, "artists", "artist", files_per_batch=1)
    rows = bronze.flatten_artists(stream)
    ingest_stream(rows, dst, checkpoint, ["name"]).awaitTermination()
    return tables.read_table(spark, dst, tables.day_schema(schemas.ARTISTS)).drop("day")


def test_new_files_merge_into_their_days(spark, tmp_path):
    src = tmp_path / "bronze"
    src.mkdir()
    dst, checkpoint = str(tmp_path / "silver"), str(tmp_path / "checkpoint")
    write(src, "1.json", "2024-01-01T08:00:00", [("a", 9), ("b", 1), ("a", 3)])
    write(src, "2.json", "2024-01-01T20:00:00", [("a", 5)])
    (src / "bad.json").write_text('{"error": 6, "message": "no"}')
    first = tuples(run(spark, src, dst, checkpoint))
    assert [(r[0], r[2]) for r in first] == [("a", 5), ("b", 1)]

    write(src, "3.json", "2024-01-02T08:00:00", [("a", 7)])
    write(src, "4.json", "2024-01-01T09:00:00", [("a", 99), ("c", 2)])  # late, but older than the kept row
    found = tuples(run(spark, src, dst, checkpoint))
    records, _ = bronze.read_snapshots(spark, str(src), "artists", "artist")
    assert found == tuples(dedup_daily(bronze.flatten_artists(records), ["name"]))

    # A lost checkpoint replays every file; the table stays the same.
    assert tuples(run(spark, src, dst, str(tmp_path / "checkpoint2"))) == found


@pytest.mark.parametrize("batches", [1, 3])
def test_daily_volume(spark, tmp_path, batches):
    src, dst = tmp_path / "in", str(tmp_path / "out")
    rows = spark.range(300).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 1000).alias("ts"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("source"), F.col("id").cast("double").alias("score"))
    schema = rows.schema
    step = 300 // batches
    for i in range(batches):
        part = rows.filter((F.col("score") >= i * step) & (F.col("score") < (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    volumes = daily_volume_stream(stream, "ts", "1 day", "source", "score")
    write_daily_volume(volumes, dst, str(tmp_path / "c")).awaitTermination()
    expected = rows.groupBy(F.to_date("ts").alias("day"), "source").agg(
        F.count("*").alias("record_count"), F.avg("score").alias("avg_score"))
    found = tables.read_table(spark, dst).select("day", "source", "record_count", "avg_score")
    assert tuples(found) == tuples(expected)

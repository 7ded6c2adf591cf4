"""Structured Streaming over the event table, compared with the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratewise import schemas
from cratewise.registry.base import query
from cratewise.session import work_path
from cratewise.sources import bronze, published, tables
from cratewise.streaming.ingest import (
    REJECTS, daily_volume_stream, envelope_stream, ingest_stream, ingest_with_rejects, write_daily_volume,
)


def events_stream(t):
    schema = t.events.schema
    return t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)


@query("stream_dedup_daily", """SELECT user_id, event_id, value, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at, CAST(ts AS DATE) AS day
  FROM events QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""")
def stream_dedup_daily(t):
    rows = events_stream(t).select(
        "user_id", "event_id", "value", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingested_at"))
    folder = work_path(t.spark, "stream-silver")
    ingest_stream(rows, folder, f"{folder}-checkpoint", ["user_id"], ties=["event_id"]).awaitTermination()
    return tables.read_table(t.spark, folder, tables.day_schema(rows.schema))


# Chart envelopes of twenty events each, in eight files; some envelopes are cut off or carry an error.
PAGE = "CAST(floor(event_id / 20) AS BIGINT)"
STAMP = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"


@query("stream_rejects", f"""SELECT 'silver' AS kind, 'user_' || CAST(user_id AS VARCHAR) AS name, {STAMP} AS ingested_at, CAST(event_id AS BIGINT) AS n
    FROM events WHERE {PAGE} % 7 NOT IN (3, 5) QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1
  UNION ALL SELECT 'no snapshot envelope', NULL, NULL, count(DISTINCT {PAGE}) + 1 FROM events WHERE {PAGE} % 7 = 3
  UNION ALL SELECT 'rate limit', NULL, NULL, count(DISTINCT {PAGE}) FROM events WHERE {PAGE} % 7 = 5
  UNION ALL SELECT 'files with rejects', NULL, NULL, count(DISTINCT {PAGE} % 8) + 1 FROM events WHERE {PAGE} % 7 IN (3, 5)""")
def stream_rejects(t):
    """Files of envelopes through the stream, two a batch, then a replayed file and a damaged one."""
    folder = work_path(t.spark, "envelopes")
    entry = F.struct(
        F.concat(F.lit("user_"), "user_id").alias("name"), F.col("event_id").cast("string").alias("playcount"),
        F.lit("1").alias("listeners"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at"))
    page = F.floor(F.col("event_id") / 20)
    # One envelope per page and stamp, as an envelope has one stamp for all its records.
    bodies = t.events.groupBy(page.alias("page"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at")).agg(F.collect_list(entry).alias("artist"))
    whole = F.to_json(F.struct(
        F.struct(F.col("at").alias("ingested_at")).alias("_metadata"), F.struct(F.struct("artist").alias("artists")).alias("data")))
    error = F.lit('{"error": 29, "message": "rate limit"}')
    kind = F.col("page") % 7
    good = bodies.filter(~kind.isin(3, 5)).select("page", whole.alias("value"))
    bad = t.events.select(page.alias("page")).distinct().filter(kind.isin(3, 5)).select(
        "page", F.when(kind == 5, error).otherwise(F.lit('{"_metadata": {"ingested')).alias("value"))
    files = good.unionByName(bad).withColumn("file", F.col("page") % 8)
    files.repartition("file").select("file", "value").write.partitionBy("file").text(folder)

    silver, rejects, checkpoint = (work_path(t.spark, f"stream-{n}") for n in ("silver", "rejects", "checkpoint"))

    def run():
        envelopes = envelope_stream(t.spark, folder, schemas.ARTIST_SNAPSHOT, files_per_batch=2, lines=True)
        ingest_with_rejects(envelopes, silver, rejects, checkpoint, bronze.flatten_artists, "artists", "artist", ["name"]).awaitTermination()

    run()
    again = files.filter("file = 1 AND page % 7 NOT IN (3, 5)").select("value").coalesce(1)
    again.write.text(f"{folder}/file=again")
    t.spark.createDataFrame([('{"data": {}}',)], "value string").write.text(f"{folder}/file=bad")
    run()
    none = F.lit(None).cast("string")
    found = published.read_published(t.spark, rejects, REJECTS)
    return (
        published.read_published(t.spark, silver, tables.day_schema(schemas.ARTISTS))
        .select(F.lit("silver").alias("kind"), "name", "ingested_at", F.col("playcount").alias("n"))
        .unionByName(found.groupBy(F.col("message").alias("kind")).agg(F.count("*").alias("n")).select("kind", none.alias("name"), none.alias("ingested_at"), "n"))
        .unionByName(found.agg(F.countDistinct(F.regexp_extract("file", "file=([^/]+)", 1)).alias("n")).select(
            F.lit("files with rejects").alias("kind"), none.alias("name"), none.alias("ingested_at"), "n"))
    )


@query("stream_daily_volume", """SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS record_count, round(avg(value), 6) AS avg_score
  FROM events GROUP BY ALL""")
def stream_daily_volume(t):
    rows = events_stream(t).select("event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    volumes = daily_volume_stream(rows, "ts", "2 days", "event_type", "value")
    folder = work_path(t.spark, "stream-volume")
    write_daily_volume(volumes, folder, f"{folder}-checkpoint", "event_type").awaitTermination()
    return tables.read_table(t.spark, folder).select("day", "event_type", "record_count", F.round("avg_score", 6).alias("avg_score"))

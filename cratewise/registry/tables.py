"""Payloads, sinks and readers: written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratewise import schemas
from cratewise.functions.text import name_tokens
from cratewise.operators import dedup as dd
from cratewise.operators import metrics as m
from cratewise.operators.views import last_updated, latest_run
from cratewise.registry.base import SNAPSHOT_SQL, query, s_name_tokens, snapshots
from cratewise.session import work_path
from cratewise.sources import arrays, bronze, published, tables

# --- raw records -----------------------------------------------------------------------

# A chart entry per event, as the API sends it: counts as text, blanks, an empty id.
RECORD_FIELDS = {
    "name": "'  user_' || CAST(user_id AS STRING) || ' & Band  '",
    "playcount": "CAST(CAST(floor(value * 100) AS BIGINT) AS STRING)",
    "mbid": "CASE WHEN event_id % 4 = 0 THEN '' ELSE 'id' || CAST(user_id AS STRING) END",
}
FLAT = f"""event_id, trim({RECORD_FIELDS['name']}) AS name, CAST(floor(value * 100) AS BIGINT) AS playcount,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS listeners, nullif({RECORD_FIELDS['mbid']}, '') AS mbid,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at"""


def _records(t, *fields):
    props = F.from_json("props", "k INT")
    known = {
        **{name: F.expr(sql) for name, sql in RECORD_FIELDS.items()},
        "listeners": props["k"].cast("string"),
        "duration": F.when(F.col("event_id") % 3 != 0, F.col("event_id").cast("string")),
    }
    entry = [known[f].alias(f) for f in fields]
    if "duration" in fields:
        entry.append(F.struct(
            F.concat(F.lit(" "), "event_type").alias("name"), known["mbid"].alias("mbid"),
        ).alias("artist"))
    return t.events.select(
        F.struct(*entry).alias("record"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingested_at"),
    )


query("flatten_events_props", f"""SELECT name, {s_name_tokens('name')} AS name_tokens, playcount, listeners, mbid, ingested_at
  FROM (SELECT {FLAT} FROM events) e""")(
    lambda t: bronze.flatten_artists(_records(t, "name", "playcount", "listeners", "mbid"))
)

query("flatten_track_records", f"""SELECT name, {s_name_tokens('name')} AS name_tokens,
    CASE WHEN event_id % 3 <> 0 THEN event_id ELSE 0 END AS duration_sec, playcount, listeners, mbid, event_type AS artist_name,
    {s_name_tokens('event_type')} AS artist_name_tokens, mbid AS artist_mbid, ingested_at
  FROM (SELECT {FLAT}, event_type FROM events) e""")(
    lambda t: bronze.flatten_tracks(_records(t, "name", "duration", "playcount", "listeners", "mbid"))
)

# Fifty events per envelope.
query("snapshot_envelope", """SELECT CAST(floor(event_id / 50) AS BIGINT) AS page, max(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')) AS ingested_at,
    'events' AS source, 'table' AS method, count(*) AS artist_count, string_agg('user_' || CAST(user_id AS VARCHAR), '|' ORDER BY event_id) AS names
  FROM events GROUP BY 1""")(
    lambda t: bronze.build_envelopes(
        t.events.select(
            "event_id", F.concat(F.lit("user_"), "user_id").alias("name"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("stamp")),
        F.floor(F.col("event_id") / 50), "artist", F.col("stamp"), "events", "table", order=["event_id"],
    ).select(
        "page", "_metadata.ingested_at", "_metadata.source", "_metadata.method", "_metadata.artist_count",
        F.array_join(F.transform("data.artists.artist", lambda r: r["name"]), "|").alias("names"))
)


@query("snapshot_roundtrip", f"""SELECT name, {s_name_tokens('name')} AS name_tokens, playcount, listeners, mbid,
    '2024-03-01T00:00:00' AS ingested_at FROM (SELECT {FLAT} FROM events) e""")
def snapshot_roundtrip(t):
    """Append all records as envelopes, then read the folder back."""
    folder = work_path(t.spark, "bronze")
    rows = _records(t, "name", "playcount", "listeners", "mbid").select("record.*")
    bronze.write_snapshot(rows, folder, "artist", "2024-03-01T00:00:00", "events", "table")
    records, _ = bronze.read_snapshots(t.spark, folder, "artists", "artist", lines=True)
    return bronze.flatten_artists(records)


# --- post files ---------------------------------------------------------------------------

# A file per hundred parts; every seventh file is cut off and must come back as a reject.
FILE = "CAST(floor(p_partkey / 100) AS BIGINT)"


@query("post_files", f"""SELECT 'post' AS kind, p_name AS title, CAST(p_size AS VARCHAR) AS score, p_type || '|' || p_brand AS comments, 1 AS n
    FROM part WHERE {FILE} % 7 <> 3
  UNION ALL SELECT 'reject', 'no JSON list of posts', NULL, NULL, count(DISTINCT {FILE}) FROM part WHERE {FILE} % 7 = 3 HAVING count(*) > 0
  UNION ALL SELECT 'ids', NULL, NULL, NULL, count(*) FROM part WHERE {FILE} % 7 <> 3""")
def post_files(t):
    """Write all parts as post files, some of them damaged, and read the folder back."""
    folder = work_path(t.spark, "posts")
    entry = F.struct(
        F.col("p_name").alias("title"), F.col("p_size").cast("string").alias("score"), F.array("p_type", "p_brand").alias("comments"))
    bodies = t.part.groupBy(F.expr(FILE).alias("f")).agg(F.to_json(F.collect_list(entry)).alias("value"))
    cut = F.when(F.col("f") % 7 == 3, F.expr("left(value, length(value) - 9)")).otherwise(F.col("value"))
    bodies.select("f", cut.alias("value")).write.partitionBy("f").text(folder)
    posts, rejects = bronze.read_posts(t.spark, folder)
    none = F.lit(None).cast("string")
    one = F.lit(1).cast("long").alias("n")
    return m.union_rows(
        posts.select(F.lit("post").alias("kind"), "title", "score", F.array_join("comments", "|").alias("comments"), one),
        rejects.groupBy("message").agg(F.count("*").alias("n")).select(
            F.lit("reject").alias("kind"), F.col("message").alias("title"), none.alias("score"), none.alias("comments"), "n"),
        # Ids run without gaps: the largest is one less than the number of posts.
        posts.agg((F.max("post_id") + 1).alias("n")).select(
            F.lit("ids").alias("kind"), none.alias("title"), none.alias("score"), none.alias("comments"), "n"),
    )


# All conversations as one file, read by ranges of 32 KB, beside a file that is cut off.
@query("post_ranges", "SELECT conv_id, turn, role, text, (SELECT count(*) FROM conversations) AS ids, 1 AS rejects FROM conversations")
def post_ranges(t):
    folder = work_path(t.spark, "arrays")
    one = t.conversations.coalesce(1)
    mark = F.when(F.monotonically_increasing_id() == 0, "[").otherwise(",")
    lines = one.select(F.concat(mark, F.to_json(F.struct(*one.columns), {"ignoreNullFields": "false"})).alias("value"))
    end = t.spark.createDataFrame([("]",)], "value string")
    lines.unionByName(end).coalesce(1).write.text(f"{folder}/whole")
    lines.coalesce(1).write.text(f"{folder}/cut")
    rows, rejects = arrays.read_arrays(t.spark, folder, t.conversations.schema, 1 << 15)
    total = rows.agg((F.max("id") + 1).alias("ids"))
    bad = rejects.agg(F.count("*").cast("int").alias("rejects"))
    return rows.select("element.*").crossJoin(F.broadcast(total)).crossJoin(F.broadcast(bad))


# --- silver ----------------------------------------------------------------------------------

SILVER_SQL = f"""SELECT name, {s_name_tokens('name')} AS name_tokens, playcount, listeners, coalesce(mbid, 'unknown') AS mbid, ingested_at
  FROM ({SNAPSHOT_SQL}) s QUALIFY row_number() OVER (PARTITION BY name, ingested_at[1:10] ORDER BY ingested_at DESC, playcount DESC) = 1"""


def _silver(t):
    latest = dd.dedup_daily(snapshots(t), ["name"]).withColumn("name_tokens", name_tokens("name"))
    return latest.na.fill("unknown", subset=["mbid"]).select(*schemas.ARTISTS.names)


@query("silver_roundtrip", SILVER_SQL)
def silver_roundtrip(t):
    folder = work_path(t.spark, "silver")
    tables.write_silver(_silver(t), schemas.ARTISTS, folder)
    return tables.read_table(t.spark, folder, schemas.ARTISTS)


@query("csv_roundtrip", """SELECT doc_id, '"' || lang || '", ' || source AS label, text, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE n_chars / 8.0 END AS eighth
  FROM documents""")
def csv_roundtrip(t):
    rows = t.documents.select(
        "doc_id", F.expr("""'"' || lang || '", ' || source""").alias("label"), "text",
        F.when(F.col("doc_id") % 3 != 0, F.col("n_chars") / 8.0).alias("eighth"),
    )
    folder = work_path(t.spark, "csv")
    tables.write_csv(rows, folder)
    return tables.read_csv(t.spark, folder, rows.schema)


# --- gold --------------------------------------------------------------------------------------

RUNS = ("2024-03-01T10:00:00", "2024-03-02T10:00:00")
SPLIT = "1999-01-01"
VOLUMES = """SELECT 'volume_trend' AS metric_type, strftime(o_orderdate, '%Y-%m-%d') AS dim1, o_orderstatus AS dim2,
  count(*) AS record_count, CAST(0 AS DOUBLE) AS pct, CAST(0 AS DOUBLE) AS avg_score, strftime(o_orderdate, '%Y-%m-%d') AS data_date
  FROM orders GROUP BY ALL"""
# The second run repeats the later days; a repeated row keeps its last stamp.
GOLD_SQL = f"""SELECT *, CASE WHEN data_date >= '{SPLIT}' THEN '{RUNS[1]}' ELSE '{RUNS[0]}' END AS computed_at FROM ({VOLUMES}) v"""


def _volumes(t, run):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    counts = t.orders.groupBy(day.alias("day"), "o_orderstatus").agg(F.count("*").alias("cnt"))
    return m.metric_rows(
        counts, "volume_trend", F.col("day"), F.col("o_orderstatus"), F.col("cnt"), F.lit(0), F.lit(0), F.col("day"), run)


def _two_runs(t):
    folder = work_path(t.spark, "gold")
    tables.upsert_months(_volumes(t, RUNS[0]), folder)
    tables.upsert_months(_volumes(t, RUNS[1]).filter(F.col("data_date") >= SPLIT), folder)
    return folder


@query("gold_month_upsert", f"""SELECT *, CAST(data_date[1:4] AS INTEGER) AS year, CAST(data_date[6:7] AS INTEGER) AS month
  FROM ({GOLD_SQL}) g""")
def gold_month_upsert(t):
    return tables.read_table(t.spark, _two_runs(t), tables.with_months(schemas.STORYTELLING))


# Three published runs: everything, the later days again, and one that its gate holds back.
@query("gold_publish", f"SELECT *, 2 AS versions, (SELECT count(DISTINCT data_date[1:7]) FROM ({GOLD_SQL}) m) AS parts FROM ({GOLD_SQL}) g")
def gold_publish(t):
    folder = work_path(t.spark, "gold-published")
    published.publish_months(_volumes(t, RUNS[0]), folder, gate=_complete, required=["data_date"])
    published.publish_months(_volumes(t, RUNS[1]).filter(F.col("data_date") >= SPLIT), folder, gate=_complete, required=["data_date"])
    try:
        broken = _volumes(t, "2024-03-03T10:00:00").withColumn("data_date", F.when(F.col("dim2") != "F", F.col("data_date")))
        published.publish_months(broken, folder, gate=_complete, required=["data_date"])
    except published.GateFailed:
        pass
    now = published.current(folder)
    rows = published.read_published(t.spark, folder, schemas.STORYTELLING)
    return rows.withColumns({"versions": F.lit(now.number), "parts": F.lit(len(now.parts)).cast("long")})


def _complete(counts):
    return "rows without a date" if counts["nulls_data_date"] else None


query("gold_history_read", f"SELECT * FROM ({GOLD_SQL}) g WHERE data_date >= '1998-06-15'")(
    lambda t: tables.read_history(t.spark, _two_runs(t), schemas.STORYTELLING, since="1998-06-15")
)


@query("gold_latest_run", f"""SELECT *, '2024-03-02  10:00 UTC' AS last_updated FROM ({GOLD_SQL}) g WHERE computed_at = '{RUNS[1]}'""")
def gold_latest_run(t):
    history = tables.read_history(t.spark, _two_runs(t), schemas.STORYTELLING)
    return latest_run(history).withColumn("last_updated", last_updated(history).scalar())


query("gold_latest_per_metric", f"""SELECT * FROM ({GOLD_SQL}) g WHERE computed_at = CASE WHEN data_date >= '{SPLIT}' THEN '{RUNS[1]}' ELSE '{RUNS[0]}' END""")(
    lambda t: latest_run(tables.read_history(t.spark, _two_runs(t), schemas.STORYTELLING), ["metric_type", "dim1"])
)

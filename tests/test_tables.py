"""Readers and sinks on real files."""

import json

import pytest
from pyspark.sql import functions as F

from cratewise import schemas
from cratewise.operators import quality as q
from cratewise.session import shared_dir
from cratewise.sources import bronze, tables

from .conftest import tuples

RUN1, RUN2 = "2024-07-01T00:00:00", "2024-07-02T00:00:00"


def metric(spark, rows, run):
    df = spark.createDataFrame(rows, "dim1 string, record_count long, data_date string")
    return df.select(
        F.lit("volume_trend").alias("metric_type"), "dim1", F.lit(None).cast("string").alias("dim2"), "record_count",
        F.lit(0.0).alias("pct"), F.lit(0.0).alias("avg_score"), "data_date", F.lit(run).alias("computed_at"))


ROWS = [("a", 1, "2024-05-31"), ("b", 2, "2024-06-01"), ("c", 3, "2023-06-01")]


def test_rows_go_to_the_month_of_their_date(spark, tmp_path):
    path = str(tmp_path / "gold")
    tables.upsert_months(metric(spark, ROWS, RUN1), path)
    found = tables.read_table(spark, path, tables.with_months(schemas.STORYTELLING))
    assert tuples(found.select("dim1", "year", "month")) == [("a", 2024, 5), ("b", 2024, 6), ("c", 2023, 6)]


def test_a_second_run_adds_nothing_and_keeps_the_last_stamp(spark, tmp_path):
    path = str(tmp_path / "gold")
    for run in (RUN1, RUN2, RUN2):
        tables.upsert_months(metric(spark, ROWS[:2], run), path)
    tables.upsert_months(metric(spark, ROWS[2:], RUN1), path)
    history = tables.read_history(spark, path, schemas.STORYTELLING)
    assert [(r["dim1"], r["computed_at"]) for r in history.orderBy("dim1").collect()] == [("a", RUN2), ("b", RUN2), ("c", RUN1)]
    assert "rangepartitioning" not in history._jdf.queryExecution().toString()


def test_changed_values_and_identity_keys(spark, tmp_path):
    both, one = str(tmp_path / "both"), str(tmp_path / "one")
    for run, n in ((RUN1, 1), (RUN2, 5)):
        rows = metric(spark, [("a", n, "2024-05-31")], run)
        tables.upsert_months(rows, both)
        tables.upsert_months(rows, one, key=["metric_type", "dim1", "dim2", "data_date"])
    assert tables.read_history(spark, both, schemas.STORYTELLING).count() == 2
    assert tuples(tables.read_history(spark, one, schemas.STORYTELLING).select("record_count")) == [(5,)]


def test_history_prunes_months_and_falls_back(spark, tmp_path):
    path = str(tmp_path / "gold")
    tables.upsert_months(metric(spark, ROWS, RUN1), path)
    recent = tables.read_history(spark, path, schemas.STORYTELLING, since="2024-06-01")
    assert tuples(recent.select("dim1")) == [("b",)]
    assert "PartitionFilters: [isnotnull(year" in recent._jdf.queryExecution().executedPlan().toString() or "year#" in \
        recent._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:80]
    csv = tmp_path / "export.csv"
    csv.write_text('metric_type,dim1,dim2,record_count,pct,avg_score,computed_at\ntop,"Good, ""B""",x,3,1.5,2.0,t\n')
    old = tables.read_history(spark, str(tmp_path / "none"), schemas.STORYTELLING, csv=str(csv)).first()
    assert (old["dim1"], old["record_count"], old["data_date"]) == ('Good, "B"', 3, None)
    assert tables.read_history(spark, str(tmp_path / "none"), schemas.STORYTELLING).count() == 0


def test_history_renames_the_older_date(spark, tmp_path):
    path = str(tmp_path / "gold")
    metric(spark, ROWS, RUN1).withColumnRenamed("data_date", "ingest_date").write.parquet(path)
    assert tuples(tables.read_history(spark, path, schemas.STORYTELLING).select("data_date")) == [
        ("2023-06-01",), ("2024-05-31",), ("2024-06-01",)]


def test_fingerprint_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "gold")
    assert tables.fingerprint(spark, path) == "empty"
    tables.upsert_months(metric(spark, ROWS[:1], RUN1), path)
    first = tables.fingerprint(spark, path)
    assert first == tables.fingerprint(spark, path)
    tables.upsert_months(metric(spark, ROWS[1:], RUN1), path)
    assert tables.fingerprint(spark, path) != first


def test_missing_source_is_empty(spark, tmp_path):
    none = tables.read_if_any(spark, str(tmp_path / "none"), schemas.ARTISTS)
    assert q.governance_report(none, "s", ["playcount"], ["name"], RUN1).count() == 0


def test_validate_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "a", 1, 2, "m", "2024-01-01")], schemas.ARTISTS)
    tables.write_silver(df, schemas.ARTISTS, path)
    assert q.validate_table(spark, path, schemas.ARTISTS).first()["rows"] == 1
    with pytest.raises(ValueError, match="missing"):
        q.validate_table(spark, path, schemas.TRACKS)
    tables.write_silver(df.filter("false"), schemas.ARTISTS, path)
    with pytest.raises(ValueError, match="no rows"):
        q.validate_table(spark, path, schemas.ARTISTS)


def snapshot(path, stamp, artists, **extra):
    doc = {"_metadata": {"ingested_at": stamp, "source": "s", "method": "m"}, "data": {"artists": {"artist": artists}}, **extra}
    path.write_text(json.dumps(doc, indent=2))


def test_snapshots_with_errors_and_missing_envelope(spark, tmp_path):
    good = [{"name": " A ", "playcount": "5", "listeners": "2", "mbid": ""}, {"name": "B", "playcount": "x"}]
    snapshot(tmp_path / "a.json", "2024-01-01T00:00:00", good)
    (tmp_path / "b.json").write_text(json.dumps({"artists": {"artist": good}}))
    (tmp_path / "c.json").write_text(json.dumps({"error": 29, "message": "Rate limit"}))
    snapshot(tmp_path / "d.json", "2024-01-02T00:00:00", [])
    records, rejects = bronze.read_snapshots(spark, str(tmp_path), "artists", "artist")
    assert tuples(bronze.flatten_artists(records)) == [
        ("A", "a", 5, 2, None, "2024-01-01T00:00:00"), ("B", "b", None, 0, None, "2024-01-01T00:00:00")]
    assert tuples(rejects.select("code", "message")) == [(29, "Rate limit"), (None, "no snapshot envelope")]
    envelopes = bronze.read_envelopes(spark, str(tmp_path), schemas.ARTIST_SNAPSHOT)
    batch = bronze.validate_batch(bronze.split_errors(envelopes)[0], "artists", "artist")
    assert tuples(batch.select("ingested_at", "count", "top_name")) == [
        ("2024-01-01T00:00:00", 2, " A "), ("2024-01-02T00:00:00", 0, "N/A")]


def test_snapshot_pages_are_bounded_and_complete(spark, tmp_path):
    rows = spark.range(1234).selectExpr("CONCAT('n', id) AS name", "CAST(id AS STRING) AS playcount")
    folder = str(tmp_path / "bronze")
    bronze.write_snapshot(rows, folder, "artist", "2024-01-01T00:00:00", "s", "m", page_size=50)
    envelopes = bronze.read_envelopes(spark, folder, schemas.ARTIST_SNAPSHOT, lines=True)
    sizes = [r[0] for r in envelopes.select(F.size("data.artists.artist")).collect()]
    assert max(sizes) <= 50 and sum(sizes) == 1234
    assert envelopes.filter(F.col("_metadata.artist_count") != F.size("data.artists.artist")).count() == 0
    assert bronze.explode_records(envelopes, "artists", "artist").select("record.name").distinct().count() == 1234
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        bronze.write_snapshot(rows, folder, "artist", "2024-01-01T00:00:00", "s", "m")


def test_posts_are_numbered_over_files(spark, tmp_path):
    def post(title, score="1"):
        return {"title": title, "score": score, "comments": ["c"]}

    (tmp_path / "posts_20260102_000000.json").write_text(json.dumps([post("c"), post("d", 27)]))
    (tmp_path / "posts_20260101_101112.json").write_text(json.dumps([post("a"), post("b", "")], indent=1))
    (tmp_path / "posts_20260103_000000.json").write_text(json.dumps([post("e"), post("f")])[:-9])
    other = tmp_path / "site=other"
    other.mkdir()
    (other / "posts_20260102_000000.json").write_text("[]")
    posts, rejects = bronze.read_posts(spark, str(tmp_path))
    assert tuples(rejects) == [("posts_20260103_000000.json", "no JSON list of posts")]
    assert tuples(posts.select("post_id", "title", "score", "file_stamp")) == [
        (0, "a", "1", "20260101_101112"), (1, "b", "", "20260101_101112"),
        (2, "c", "1", "20260102_000000"), (3, "d", "27", "20260102_000000")]
    assert bronze.latest_stamp(posts).first()[0] == "20260102_000000"
    iso = posts.select(bronze.stamp_to_iso("file_stamp")).distinct()
    assert tuples(iso) == [("2026-01-01T10:11:12",), ("2026-01-02T00:00:00",)]
    assert bronze.read_post_table(spark, str(tmp_path / "posts_20260101_101112.json")).columns == ["comments", "score", "title"]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")

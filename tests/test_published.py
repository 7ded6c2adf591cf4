"""Published tables: all of a run or nothing of it, gates, and a stream with rejects."""

import json

import pytest
from pyspark.sql import functions as F

from cratewise import files, schemas
from cratewise.operators.dedup import dedup_daily
from cratewise.operators.report import Steps
from cratewise.plans.comments import silver_comments
from cratewise.sources import bronze, published, tables
from cratewise.sources.published import GateFailed, current, publish, publish_months, read_published
from cratewise.streaming import ingest
from cratewise.streaming.ingest import REJECTS, envelope_stream, ingest_with_rejects

from .conftest import tuples

ROWS = "data_date string, k string, v long, computed_at string"


def rows(spark, *found):
    return spark.createDataFrame(found, ROWS)


def read(spark, path, **how):
    return tuples(read_published(spark, path, rows(spark).schema, **how))


@pytest.fixture
def table(spark, tmp_path):
    path = f"file:{tmp_path}/gold"
    publish_months(rows(spark, ("2024-01-05", "a", 1, "r1"), ("2024-02-01", "b", 2, "r1"), ("odd", "c", 3, "r1")), path)
    return path


FIRST = [("2024-01-05", "a", 1, "r1"), ("2024-02-01", "b", 2, "r1"), ("odd", "c", 3, "r1")]
SECOND = [("2024-01-05", "a", 1, "r1"), ("2024-02-01", "b", 2, "r2"), ("2024-02-09", "d", 4, "r2"), ("odd", "c", 3, "r1")]


def second(spark, table, **how):
    return publish_months(rows(spark, ("2024-02-01", "b", 2, "r2"), ("2024-02-09", "d", 4, "r2")), table, **how)


def test_months_merge_and_prune(spark, table):
    assert read(spark, table) == FIRST
    second(spark, table)
    assert read(spark, table) == SECOND and current(table).number == 2
    assert read(spark, table, since="2024-02", parts=["2024-02"]) == SECOND[1:3]
    before = current(table).parts
    second(spark, table)
    assert read(spark, table) == SECOND and current(table).parts["2024-01"] == before["2024-01"]
    assert read(spark, f"{table}-none") == [] and current(f"{table}-none").number == 0


def test_a_run_without_rows_publishes_no_part(spark, table):
    version = publish_months(rows(spark), table)
    assert version.parts.keys() == {"2024-01", "2024-02", "none"} and read(spark, table) == FIRST


def test_a_key_keeps_the_last_run(spark, tmp_path):
    path = f"{tmp_path}/keyed"
    for run, value in (("r1", 1), ("r2", 5)):
        publish_months(rows(spark, ("2024-01-05", "a", value, run)), path, key=["data_date", "k"])
    assert read(spark, path) == [("2024-01-05", "a", 5, "r2")]


class Killed(Exception):
    pass


def killed(*args, **kwargs):
    raise Killed


def test_killed_before_the_swap_the_old_version_stays(spark, table, monkeypatch):
    monkeypatch.setattr(published.files, "write_new", killed)
    with pytest.raises(Killed):
        second(spark, table)
    assert read(spark, table) == FIRST and current(table).number == 1
    assert len(files.names(f"{table}/data")) == 2  # written, named by no manifest
    monkeypatch.undo()
    second(spark, table)
    assert read(spark, table) == SECOND
    assert len(files.names(f"{table}/data")) == 2  # the lost run's folder is gone


def test_killed_before_the_clean_up_the_new_version_is_there(spark, table, monkeypatch):
    second(spark, table)
    monkeypatch.setattr(published, "clean", killed)
    with pytest.raises(Killed):
        second(spark, table)
    assert read(spark, table) == SECOND and current(table).number == 3
    monkeypatch.undo()
    before = files.names(f"{table}/data")
    second(spark, table)
    assert read(spark, table) == SECOND and len(files.names(f"{table}/data")) <= len(before)


def test_readers_of_the_version_before_still_find_their_folders(spark, table):
    old = read_published(spark, table, rows(spark).schema)
    second(spark, table)
    assert tuples(old) == FIRST


def test_a_second_writer_fails(spark, table, monkeypatch):
    stale = current(table)
    second(spark, table)
    monkeypatch.setattr(published, "current", lambda path: stale)
    with pytest.raises(FileExistsError):
        second(spark, table)
    monkeypatch.undo()
    assert read(spark, table) == SECOND
    assert not [n for n in files.names(f"{table}/manifests") if n.startswith(".")]


def test_a_failed_gate_publishes_nothing(spark, table):
    seen = {}

    def gate(counts):
        seen.update(counts)
        return "a null" if counts["nulls_k"] else None

    bad = rows(spark, ("2024-02-01", None, 2, "r2"), ("2024-02-02", "x", 2, "r2"), ("2024-02-02", "x", 2, "r3"))
    with pytest.raises(GateFailed, match="a null"):
        publish_months(bad, table, gate=gate, required=["k"])
    assert seen == {"rows_in": 3, "rows_old": 1, "rows_out": 3, "nulls_k": 1}
    assert read(spark, table) == FIRST and current(table).number == 1
    second(spark, table, gate=gate, required=["k"])
    assert read(spark, table) == SECOND


def test_a_mark_is_taken_once(spark, tmp_path):
    path, whole = f"{tmp_path}/marked", lambda df: df
    for batch in (0, 1, 1, 0):
        publish(rows(spark, ("2024-01-01", "a", batch, "r")), path, F.lit(f"batch-{batch}"), whole, mark=("q", batch))
    assert [r[2] for r in read(spark, path)] == [0, 1]
    publish(rows(spark, ("2024-01-01", "a", 7, "r")), path, F.lit("other-0"), whole, mark=("other", 0))
    assert current(path).marks == {"q": 1, "other": 0} and len(read(spark, path)) == 3


def test_steps_count_rows_and_nulls(spark):
    steps = Steps()
    df = steps.see("in", spark.range(10).selectExpr("id", "if(id < 4, null, id) as x"), ["x"])
    steps.see("out", df.filter("id % 2 = 0")).write.format("noop").mode("overwrite").save()
    assert tuples(steps.report(spark)) == [(0, "in", 10, 0, 4), (1, "out", 5, 5, 0)]
    assert steps.counts() == {"rows_in": 10, "nulls_x": 4, "rows_out": 5}


def test_steps_of_the_comment_job(spark):
    posts = spark.createDataFrame(
        [("f", "20240101_000000", 0, "t", "3", ["A - B", "A - B", " ", "???", "one\ntwo"]), ("f", "20240101_000000", 1, None, "3", ["x"])],
        "file string, file_stamp string, post_id long, title string, score string, comments array<string>")
    steps = Steps()
    table = silver_comments(posts, "2024-01-01T00:00:00", steps=steps)
    assert table.count() == 3
    assert [(r.name, r.rows, r.removed) for r in steps.report(spark).orderBy("step").collect()] == [("comments", 4, 0), ("parts", 5, -1), ("unique", 4, 1), ("kept", 3, 1)]


# Streams


def write(folder, name, *envelopes):
    (folder / name).write_text("\n".join(envelopes))


def envelope(stamp, *found):
    artists = [{"name": n, "playcount": str(p), "listeners": "1", "mbid": ""} for n, p in found]
    return json.dumps({"_metadata": {"ingested_at": stamp}, "data": {"artists": {"artist": artists}}})


ERROR, CUT = json.dumps({"error": 29, "message": "rate limit"}), '{"_metadata": {"ingested_at": "20'


@pytest.fixture
def stream(spark, tmp_path):
    source = tmp_path / "bronze"
    source.mkdir()

    def run(checkpoint="checkpoint", **how):
        envelopes = envelope_stream(spark, str(source), schemas.ARTIST_SNAPSHOT, files_per_batch=1, lines=True)
        ingest_with_rejects(
            envelopes, f"{tmp_path}/silver", f"{tmp_path}/rejects", f"{tmp_path}/{checkpoint}", bronze.flatten_artists, "artists", "artist", ["name"], **how,
        ).awaitTermination()

    def found():
        silver = read_published(spark, f"{tmp_path}/silver", tables.day_schema(schemas.ARTISTS)).drop("day")
        rejects = read_published(spark, f"{tmp_path}/rejects", REJECTS)
        return tuples(silver), sorted((r.file.rsplit("/", 1)[1], r.code, r.message) for r in rejects.collect())

    return source, run, found


def test_stream_keeps_rejects_with_their_files(spark, stream):
    source, run, found = stream
    write(source, "1.json", envelope("2024-01-01T08:00:00", ("a", 9), ("b", 1)), ERROR)
    write(source, "2.json", envelope("2024-01-01T20:00:00", ("a", 5)))
    write(source, "3.json", CUT)
    run()
    write(source, "4.json", envelope("2024-01-02T08:00:00", ("a", 7)), envelope("2024-01-01T09:00:00", ("a", 99), ("c", 2)))
    run()
    silver, rejects = found()
    assert rejects == [("1.json", 29, "rate limit"), ("3.json", None, "no snapshot envelope")]
    records, _ = bronze.read_snapshots(spark, str(source), "artists", "artist", lines=True)
    assert silver == tuples(dedup_daily(bronze.flatten_artists(records), ["name"]))


def test_stream_killed_between_its_two_tables(spark, stream, monkeypatch):
    source, run, found = stream
    write(source, "1.json", envelope("2024-01-01T08:00:00", ("a", 9)), ERROR)
    own, calls = ingest.publish, []

    def dies_at_silver(*args, **kwargs):
        calls.append(args[1])
        if args[1].endswith("silver"):
            raise Killed
        return own(*args, **kwargs)

    monkeypatch.setattr(ingest, "publish", dies_at_silver)
    with pytest.raises(Exception):
        run()
    assert len(calls) == 2 and found() == ([], [("1.json", 29, "rate limit")])
    monkeypatch.undo()
    run()  # the batch is run again: the reject stays one
    silver, rejects = found()
    assert len(silver) == 1 and rejects == [("1.json", 29, "rate limit")]


def test_stream_gate_stops_before_a_bad_batch(spark, stream):
    source, run, found = stream
    write(source, "1.json", envelope("2024-01-01T08:00:00", ("a", 9)))
    run()
    write(source, "2.json", envelope("2024-01-01T09:00:00", *[(f"n{i}", i) for i in range(30)]))
    with pytest.raises(Exception, match="too many"):
        run(gate=lambda counts: "too many" if counts["rows_in"] > 20 else None)
    assert len(found()[0]) == 1
    run()
    assert len(found()[0]) == 31

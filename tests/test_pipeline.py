"""Files in, gold tables out, against the published reports."""

import json

import pytest

from cratewise import schemas
from cratewise.functions.sentiment import default_lexicon
from cratewise.operators import metrics as m
from cratewise.operators import quality as q
from cratewise.plans import charts, gold
from cratewise.plans.comments import silver_comments
from cratewise.sources import bronze, tables

from .conftest import tuples

NOW = "2026-05-30T02:09:41"


@pytest.fixture(scope="module")
def expected(fixtures):
    return json.loads((fixtures / "expected.json").read_text(encoding="utf-8"))


@pytest.fixture(scope="module")
def silver(spark, fixtures, tmp_path_factory):
    base = tmp_path_factory.mktemp("silver")
    done = {}
    for name, record, plan, schema in (
        ("artists", "artist", charts.silver_artists, schemas.ARTISTS),
        ("tracks", "track", charts.silver_tracks, schemas.TRACKS),
    ):
        records, rejects = bronze.read_snapshots(spark, str(fixtures / name), name, record)
        table, invalid = plan(records)
        assert rejects.count() == 0 and invalid.count() == 0
        tables.write_silver(table, schema, str(base / name))
        done[name] = tables.read_table(spark, str(base / name), schema)
    return done


def test_governance_golden(silver, expected):
    report = gold.governance({"lastfm_artists": silver["artists"], "lastfm_tracks": silver["tracks"]}, NOW)
    assert report.columns == schemas.GOVERNANCE.names
    found = {(r["source"], r["field_name"], r["kpi_type"]): (round(r["value"], 9), r["unit"]) for r in report.collect()}
    wanted = {(s, f, k): (round(v, 9), u) for s, f, k, v, u in expected["kpis"]}
    assert found == wanted


def test_top_twenty_golden(silver, expected):
    artists = m.topn_peak_share(silver["artists"], ["name"], "listeners", gold.ARTIST_METRIC, NOW, dim2="lastfm")
    tracks = m.topn_peak_share(silver["tracks"], ["name", "artist_name"], "playcount", gold.TRACK_METRIC, NOW)
    volumes = m.volume_trend({"lastfm_artists": silver["artists"], "lastfm_tracks": silver["tracks"]}, NOW)
    rows = m.union_rows(artists, tracks, volumes).select("metric_type", "dim1", "dim2", "record_count", "pct", "avg_score")
    assert tuples(rows) == sorted((tuple(r) for r in expected["metrics"]), key=repr)


def test_daily_shares_add_up(silver):
    rows = gold.storytelling(NOW, artists=silver["artists"], tracks=silver["tracks"])
    assert rows.columns == schemas.STORYTELLING.names
    daily = rows.filter("metric_type = 'top_artist_lastfm'").groupBy("data_date").sum("pct").collect()
    assert len(daily) == 3 and all(abs(r[1] - 100) < 0.3 for r in daily)


POSTS = {
    "20260101_000000": [
        {"title": "Best album", "score": "12.7", "comments": [
            "Artist One - Song One\n\nOther & Co - Tune", "great album but too long for me", "[deleted]", " ", None,
            "carmelita by warren zevon", "great album but too long for me"]},
        {"title": " NULL ", "score": 5, "comments": ["lost"]},
        {"title": "No comments", "score": 5, "comments": None},
    ],
    "20260102_000000": [
        {"title": "Best album", "score": "", "comments": ["great album but too long for me", "!!!", "see http://x.y/z &amp; listen"]},
        {"title": "Viral", "score": "9000", "comments": ["word " * 40, "ok"]},
    ],
}


@pytest.fixture(scope="module")
def posts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("posts")
    for stamp, rows in POSTS.items():
        (folder / f"music_posts_{stamp}.json").write_text(json.dumps(rows, indent=1))
    return bronze.read_posts(spark, str(folder))[0]


@pytest.fixture(scope="module")
def comments(spark, posts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver-comments") / "t")
    tables.write_silver(silver_comments(posts, NOW), schemas.COMMENTS, path)
    return tables.read_table(spark, path, schemas.COMMENTS)


def test_comment_table(comments):
    assert comments.schema.names == schemas.COMMENTS.names
    rows = comments.orderBy("raw_comment_id", "clean_comment").collect()
    assert [(r["post_id"], r["raw_comment_id"], r["clean_comment"], r["score"]) for r in rows] == [
        (0, 0, "artist one - song one", 12), (0, 0, "other & co - tune", 12), (0, 1, "great album but too long for me", 12),
        (0, 2, "deleted", 12), (0, 3, "carmelita by warren zevon", 12), (3, 5, "great album but too long for me", 0),
        (3, 7, "see & listen", 0), (4, 8, " ".join(["word"] * 40), 9000), (4, 9, "ok", 9000)]
    first = rows[0]
    assert (first["artist"], first["song"], first["comment_type"], first["pattern_type"]) == (
        "artist one", "song one", "recommendation", "dash")
    assert rows[2]["comment_type"] == "opinion" and rows[2]["artist"] == "unknown" and rows[2]["has_contrast"]
    assert rows[7]["word_count"] == 40 and rows[7]["word_count_capped"] < 40
    assert all(r["ingested_at"] == NOW for r in rows)


def test_capping_counts_every_part_before_dedup(comments, posts):
    """Nine kept rows, but the fences come from all eleven parts."""
    import numpy as np

    words = np.array([5, 4, 7, 1, 4, 7, 7, 0, 3, 40, 1], dtype=float)
    q1, q3 = np.quantile(words, [0.25, 0.75])
    cap = comments.agg({"word_count_capped": "max"}).first()[0]
    assert cap == pytest.approx(q3 + 1.5 * (q3 - q1))


def test_options(posts):
    kept = silver_comments(posts, NOW, stamp="file", drop_deleted=True)
    assert kept.filter("clean_comment = 'deleted'").count() == 0
    assert tuples(kept.select("ingested_at").distinct()) == [("2026-01-01T00:00:00",), ("2026-01-02T00:00:00",)]
    narrow = silver_comments(posts, NOW, key=["clean_comment"])
    assert narrow.filter("clean_comment LIKE 'great%'").count() == 1
    with pytest.raises(ValueError, match="stamp"):
        silver_comments(posts, NOW, stamp="other")


def test_storytelling_to_gold(spark, comments, silver, tmp_path):
    rows = gold.storytelling(NOW, comments, silver["artists"], silver["tracks"], default_lexicon(spark))
    path = str(tmp_path / "storytelling")
    tables.upsert_months(rows, path)
    tables.upsert_months(rows, path)
    stored = tables.read_history(spark, path, schemas.STORYTELLING)
    assert stored.count() == rows.count()
    kinds = {r[0] for r in stored.select("metric_type").distinct().collect()}
    assert kinds == {"sentiment_dist", "sentiment_trend", "comment_type_dist", "top_keyword", "volume_trend",
                     "reddit_artist", "top_artist_lastfm", "top_track_lastfm"}
    assert q.validate_table(spark, path, schemas.STORYTELLING).first()["rows"] == rows.count()
    card = m.narrative(stored).first()
    assert card["comments"] == comments.count() and card["leader"] and len(card["keywords"].split(", ")) == 3


def test_comment_governance(comments):
    report = gold.governance({"reddit": comments}, NOW)
    kinds = {r["kpi_type"] for r in report.collect()}
    assert len(kinds) == 9
    assert report.filter("kpi_type = 'null_rate'").count() == 19

"""Posts to the silver comment table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise import schemas
from cratewise.functions.nlp import with_classification, with_entities
from cratewise.functions.once import with_once
from cratewise.functions.text import clean_comment, tokenize
from cratewise.operators.clean import coerce_score, drop_blank, normalize_nulls, null_if_word, require
from cratewise.operators.dedup import dedup_first
from cratewise.operators.explode import explode_parts, number_comments
from cratewise.operators.quality import enforce_schema
from cratewise.operators.quantiles import cap_outliers
from cratewise.operators.report import Steps
from cratewise.session import materialize
from cratewise.sources.bronze import stamp_to_iso

DEDUP_KEY = ["title", "clean_comment", "file_stamp"]


def comment_rows(posts: DataFrame, drop_deleted: bool = False) -> DataFrame:
    """Posts to one row per raw comment, with its running id.

    ``drop_deleted`` also drops comments that only say "[deleted]" and the
    like; by default null words count in whole columns only.
    """
    present = require(normalize_nulls(posts, ["title", "score"]), ["title", "comments"])
    scored = present.withColumn("score", coerce_score("score"))
    keep = (lambda c: null_if_word(c).isNotNull()) if drop_deleted else None
    return number_comments(scored, keep=keep)


def annotate(comments: DataFrame, bounded: bool = False) -> DataFrame:
    """Split, clean, tokenise, classify and extract; all row-local."""
    parts = drop_blank(explode_parts(comments, "raw_comment"), "raw_comment")
    cleaned = with_once(parts, clean_comment=clean_comment("raw_comment"))
    tokens = with_once(cleaned, tokens=tokenize("clean_comment", clean=True))
    return with_entities(with_classification(tokens, "clean_comment", "tokens"), "clean_comment", bounded=bounded)


def silver_comments(
    posts: DataFrame,
    run_ts: str,
    stamp: str = "run",
    drop_deleted: bool = False,
    bounded: bool = False,
    key: list[str] | None = None,
    steps: Steps | None = None,
) -> DataFrame:
    """The silver table from ``read_posts`` rows.

    Capping comes before deduplication, over all comment parts, so a post's
    score counts once per part. The annotated rows are materialised once: the
    quantile passes then read two narrow columns instead of repeating the
    text work. ``stamp="file"`` keeps the stamp of each post file as
    ``ingested_at`` instead of the run time. ``steps`` counts the rows between the
    steps, in the jobs that run anyway.
    """
    if stamp not in ("run", "file"):
        raise ValueError(f"unknown stamp: {stamp}")
    see = (steps or Steps()).see
    comments = see("comments", comment_rows(posts, drop_deleted))
    annotated = materialize(see("parts", annotate(comments, bounded)), "comments")
    capped = cap_outliers(annotated, ["score", "word_count"])
    unique = see("unique", dedup_first(capped, key or DEDUP_KEY, ["raw_comment_id", "part_pos"]))
    kept = see("kept", drop_blank(unique, "clean_comment"), ["title", "score", "clean_comment"])
    when = F.lit(run_ts) if stamp == "run" else stamp_to_iso("file_stamp")
    return enforce_schema(kept.withColumn("ingested_at", when), schemas.COMMENTS)[0]

"""Row generation: posts to comments, comments to parts, parts to tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratewise.functions.text import is_blank, split_comment
from cratewise.session import materialize


def explode_comments(posts: DataFrame, comments: str = "comments") -> DataFrame:
    """One row per comment; ``comment_pos`` is its place in the post."""
    return posts.select("*", F.posexplode(comments).alias("comment_pos", "raw_comment")).drop(comments)


def explode_parts(df: DataFrame, col: str) -> DataFrame:
    """One row per non-empty part of ``col``; ``part_pos`` keeps the order."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.posexplode(split_comment(col)).alias("part_pos", col))


def explode_tokens(df: DataFrame, col: str, name: str = "kw") -> DataFrame:
    return df.select("*", F.explode(col).alias(name))


def struct_to_columns(df: DataFrame, col: str) -> DataFrame:
    return df.select("*", f"{col}.*").drop(col)


def number_comments(
    posts: DataFrame, comments: str = "comments", post: str = "post_id",
    keep: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per non-blank comment with its running ``raw_comment_id``.

    Ids run in (post, position) order over all posts. Only the posts' ids and
    comment counts are ordered: dealt out by ranges of ids, so that sparse ids
    spread like dense ones, summed within each range, and offset by the totals
    of the ranges before (one row per shuffle partition). The text meets its
    post's first id afterwards. ``post`` must be a unique whole number.
    ``keep`` is a further condition on a comment.
    """
    def wanted(entry: Column) -> Column:
        text = entry["raw_comment"]
        return ~is_blank(text) & keep(text) if keep else ~is_blank(text)

    entries = F.transform(
        comments, lambda c, i: F.struct(i.alias("comment_pos"), c.alias("raw_comment"))
    )
    kept = posts.select(*[c for c in posts.columns if c != comments], F.filter(entries, wanted).alias("_kept"))
    sizes = kept.select(F.col(post).alias("_post"), F.size("_kept").cast("long").alias("_n"))
    # Written, as the ranges are sampled and must be the same in both reads.
    ranges = materialize(sizes.repartitionByRange("_post").withColumn("_range", F.spark_partition_id()), "comment-counts")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy("_range").agg(F.sum("_n").alias("_n"))
    offsets = totals.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_range").orderBy("_post").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_offset") + F.coalesce(F.sum("_n").over(within), F.lit(0))
    firsts = ranges.join(F.broadcast(offsets), "_range").select("_post", first.alias("_first"))
    return (
        kept.join(firsts.hint("shuffle_hash"), F.col(post) == F.col("_post"))
        .select("*", F.posexplode("_kept").alias("_pos", "_entry"))
        .select("*", "_entry.*", (F.col("_first") + F.col("_pos")).alias("raw_comment_id"))
        .drop("_post", "_kept", "_first", "_pos", "_entry")
    )

"""Posts, links and comments out of stored web pages.

Plain tag patterns stay in the JVM. The selector forms (a post's own title,
the top-level comments of a thread) need a tag stack, which a regular
expression cannot keep; there a small parser runs inside ``mapInPandas``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.functions.html import unescape_html
from cratewise.functions.once import with_once
from cratewise.functions.text import SPACES, is_blank, strip, strip_flair
from cratewise.operators.clean import REACTION_KEYWORDS, is_reaction, null_if_word
from cratewise.operators.dedup import first_n
from cratewise.operators.outline import comments_of, posts_of

COMMENTS_PER_POST = 5
POSTS_PER_SOURCE = 35

# Tag patterns.
ANCHOR = r"(?s)<a[^>]*?href=\"([^\"]*)\"[^>]*>(.*?)</a>"
PARAGRAPH = r"(?si)<p(?:[ \t\r\n\f][^>]*)?>(.*?)</p[ \t\r\n\f]*>"
TITLE = r"(?s)<title>(.*?)</title>"
NEXT_BUTTON = r"(?s)<span[^>]*?class=\"[^\"]*?next-button[^\"]*\"[^>]*>[^<]*<a[^>]*?href=\"([^\"]*)\""
TAG = r"(?s)<[^>]*>"


def visible_text(markup) -> Column:
    """Tags become spaces, entities are decoded, whitespace collapses."""
    markup = F.col(markup) if isinstance(markup, str) else markup
    return strip(F.regexp_replace(unescape_html(F.regexp_replace(markup, TAG, " ")), SPACES, " "))


def page_links(pages: DataFrame) -> DataFrame:
    """``(page_id, pos, title, permalink)`` of every complete link."""
    found = F.arrays_zip(
        F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(2)).alias("markup"),
        F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1)).alias("permalink"),
    )
    links = pages.select("page_id", F.posexplode(found).alias("pos", "a"))
    decoded = with_once(links, title=visible_text("a.markup"), permalink=unescape_html(F.col("a.permalink")))
    return decoded.select("page_id", "pos", "title", "permalink").filter(~is_blank("title") & (F.col("permalink") != ""))


def next_link(html) -> Column:
    """Target of the next button, null without one."""
    html = F.col(html) if isinstance(html, str) else html
    return F.nullif(unescape_html(F.regexp_extract(html, NEXT_BUTTON, 1)), F.lit(""))


def page_title(html) -> Column:
    html = F.col(html) if isinstance(html, str) else html
    return visible_text(F.regexp_extract(html, TITLE, 1))


def page_text(pages: DataFrame, n: int | None = None) -> DataFrame:
    """``(page_id, pos, text)`` of the paragraphs that say something; the
    first ``n`` per page when ``n`` is given."""
    paragraphs = pages.select(
        "page_id", F.posexplode(F.regexp_extract_all("html", F.lit(PARAGRAPH), F.lit(1))).alias("pos", "markup")
    )
    texts = with_once(paragraphs, text=null_if_word(visible_text("markup")))
    texts = texts.select("page_id", "pos", "text").filter("text IS NOT NULL")
    return texts if n is None else first_n(texts, ["page_id"], ["pos"], n)


# --- selector forms -----------------------------------------------------------------

def listing_posts(pages: DataFrame) -> DataFrame:
    """``(page_id, pos, title, permalink, score)`` of a listing's posts.

    A score that is no whole number is 0; posts without title or permalink
    are dropped. The parser runs on pages that contain a post at all.
    """
    listings = pages.select("page_id", "html").filter(F.contains("html", F.lit("thing")))
    raw = listings.mapInPandas(
        posts_of, "page_id long, pos int, title string, permalink string, score string"
    )
    whole = F.coalesce(strip("score").try_cast("long"), F.lit(0)).cast("long")
    return raw.withColumn("score", whole).filter((F.col("title") != "") & (F.col("permalink") != ""))


def page_comments(pages: DataFrame, n: int = COMMENTS_PER_POST) -> DataFrame:
    """``(page_id, pos, text)``: the first ``n`` top-level comments of a post
    page that are neither empty, deleted nor removed."""
    threads = pages.select("page_id", "html").filter(F.contains("html", F.lit("commentarea")))
    raw = threads.mapInPandas(comments_of, "page_id long, pos int, text string")
    kept = raw.filter((F.col("text") != "") & ~F.col("text").isin("[deleted]", "[removed]"))
    return first_n(kept, ["page_id"], ["pos"], n)


def assemble_posts(
    posts: DataFrame, comments: DataFrame, source: str = "source", post: str = "post_id",
    order: list[str] | None = None, keywords: list[str] = REACTION_KEYWORDS, n: int = POSTS_PER_SOURCE,
    per_post: int = COMMENTS_PER_POST,
) -> DataFrame:
    """``(source, post_id, title, score, comments)``.

    Keeps posts whose title has a keyword and that have comments, cleans the
    title, and takes the first ``n`` accepted posts per source in listing
    order, each with its first ``per_post`` comments.
    """
    wanted = posts.filter(is_reaction("title", keywords))
    accepted = first_n(
        wanted.join(comments.select(post).distinct(), post, "left_semi"), [source], order or [post], n
    )
    bodies = (
        first_n(comments.join(accepted.select(post), post, "left_semi"), [post], ["pos"], per_post)
        .groupBy(post)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("_c"))
    )
    return accepted.join(bodies, post).select(
        source, post, strip_flair("title").alias("title"), "score",
        F.transform("_c", lambda c: c["text"]).alias("comments"),
    )

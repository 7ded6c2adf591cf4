import pytest
from pyspark.sql import functions as F

from cratewise.operators import pages as pg

from .conftest import tuples

LISTING = """<html><body><div id="siteTable">
<div class="thing odd link" data-permalink="/r/1" data-score="42"><a class="thumb" href="#">no</a>
  <p><a class="title may-blank" href="/x"> Best <b>album</b> &amp; more </a></p><a class="title">second</a></div>
<div class="thing link" data-permalink="/r/2" data-score="n/a"><a class="title">Two</a></div>
<div class="thing link" data-permalink="" data-score="3"><a class="title">No link</a></div>
<div class="thing link" data-permalink="/r/4"><p>no title</p></div>
<div class="clear"><a class="title">outside</a></div>
<div class="thing link promoted" data-permalink="/r/5" data-score="7"><a class="title">Last<br>line</a></div>
<div class="thing comment"><a class="title">not a post</a></div>
</div><span class="nextprev"><span class="next-button"><a href="/next?a=1&amp;b=2" rel="next">next</a></span></span></body></html>"""


def comment(body, replies="", cls="thing comment"):
    return (f'<div class="{cls}"><p class="tagline">who</p><form><div class="usertext-body"><div class="md">{body}</div></div></form>'
            f'<div class="child"><div class="sitetable">{replies}</div></div></div>')


THREAD = (
    '<div class="commentarea"><div class="menuarea">x</div><div class="sitetable nestedlisting">'
    + comment("<p>First <em>one</em></p><p>more</p>", comment("<p>reply</p>"))
    + comment("<p>[deleted]</p>") + comment("  ") + comment("<p>[removed]</p>")
    + '<div class="thing comment"><p>no body</p><div class="child"></div></div>'
    + comment("<p>a &lt; b</p>") + comment("<p>c</p>", cls="thing noncollapsed comment") + comment("d") + comment("e") + comment("f")
    + '</div></div><div class="sitetable">' + comment("elsewhere") + "</div>"
)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "u1", LISTING), (2, "u2", THREAD), (3, "u3", "<p>nothing</p>"), (4, "u4", None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_listing_posts(pages):
    assert tuples(pg.listing_posts(pages)) == [
        (1, 0, "Bestalbum& more", "/r/1", 42), (1, 1, "Two", "/r/2", 0), (1, 4, "Lastline", "/r/5", 7)]


def test_next_link(pages):
    assert [r[0] for r in pages.orderBy("page_id").select(pg.next_link("html")).collect()] == ["/next?a=1&b=2", None, None, None]


def test_page_comments_are_top_level_and_capped(pages):
    assert [r["text"] for r in pg.page_comments(pages).orderBy("pos").collect()] == ["First one more", "a < b", "c", "d", "e"]
    assert pg.page_comments(pages, n=2).count() == 2


def test_plain_links_and_text(spark):
    html = '<a href="/a">One &amp; <b>two</b></a><a href="">x</a><a name="q" href="/c">  </a><p>t1</p><p>[deleted]</p><p>t <i>2</i></p>'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert tuples(pg.page_links(df)) == [(1, 0, "One & two", "/a")]
    assert tuples(pg.page_text(df)) == [(1, 0, "t1"), (1, 2, "t 2")]
    assert tuples(pg.page_text(df, n=1)) == [(1, 0, "t1")]


def test_assemble_posts(spark):
    posts = spark.createDataFrame(
        [(i, "s", f"[FRESH] best {i}", i) for i in range(5)] + [(9, "s", "plain", 0), (10, "t", "album", 1)],
        "post_id long, source string, title string, score long")
    comments = spark.createDataFrame(
        [(i, p, f"c{i}{p}") for i in (1, 2, 3, 9, 10) for p in (1, 0)], "post_id long, pos int, text string")
    found = pg.assemble_posts(posts, comments, n=2)
    assert tuples(found.withColumn("comments", F.array_join("comments", ","))) == [
        ("s", 1, "best 1", 1, "c10,c11"), ("s", 2, "best 2", 2, "c20,c21"), ("t", 10, "album", 1, "c100,c101")]

"""Presentation queries over KPI and metric rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratewise.functions.labels import severity
from cratewise.operators import pages as pg
from cratewise.operators import views as v
from cratewise.registry.base import WS, query, s_html, s_round, s_strip
from cratewise.registry.quality import REPORT_SQL, report
from cratewise.session import spread
from cratewise.operators.clean import REACTION_KEYWORDS

KPI = f"WITH k AS ({REPORT_SQL}) "

query("kpi_summary", KPI + """SELECT source, CAST(max(value) FILTER (kpi_type = 'volume') AS BIGINT) AS total_records,
    max(value) FILTER (kpi_type = 'schema_compliance') AS schema_compliance,
    max(value) FILTER (kpi_type = 'ingestion_days') AS ingestion_days FROM k GROUP BY source""")(
    lambda t: v.kpi_summary(report(t))
)

query("pivot_kpi", KPI + "SELECT source, value AS total_records FROM k WHERE kpi_type = 'volume'")(
    lambda t: v.pivot_kpi(report(t), "volume", "total_records")
)

query("kpi_slice", KPI + "SELECT * FROM k WHERE kpi_type = 'null_rate' AND source = 'orders' AND field_name = 'status'")(
    lambda t: v.kpi_slice(report(t), "null_rate", "orders", "status")
)

query("text_kpi_pivot", KPI + "SELECT source, field_name, " + ", ".join(
    f"{s_round(f'avg(value) FILTER (kpi_type = {chr(39)}text_len_{x}{chr(39)})', 1)} AS text_len_{x}" for x in ("mean", "median", "min", "max"))
    + " FROM k WHERE kpi_type LIKE 'text_len_%' GROUP BY source, field_name")(
    lambda t: v.text_kpi_pivot(report(t))
)

query("kpi_cards", KPI + """SELECT CAST(sum(value) FILTER (kpi_type = 'volume') AS BIGINT) AS records,
    round(avg(value) FILTER (kpi_type = 'schema_compliance'), 4) AS mean_compliance,
    round(avg(value) FILTER (kpi_type = 'outlier_rate'), 4) AS mean_outlier_rate,
    coalesce(max(value) FILTER (kpi_type = 'null_rate' AND value > 0), 0.0) AS max_null_rate,
    (SELECT field_name FROM k WHERE kpi_type = 'null_rate' AND value > 0 ORDER BY value DESC, field_name LIMIT 1) AS max_null_field
  FROM k""")(
    lambda t: v.kpi_cards(report(t))
)

query("kpi_table_flags", KPI + """SELECT source AS "Source", field_name AS "Field", source || '.' || field_name AS "FullField",
    kpi_type AS "KPI", CAST(round(CAST(value AS DECIMAL(38, 12)), 3) AS DOUBLE) AS "Value", unit AS "Unit", data_date AS "DataDate",
    CASE WHEN kpi_type = 'null_rate' AND value > 5 THEN 'high_nulls' WHEN kpi_type = 'schema_compliance' AND value = 100 THEN 'compliant'
      WHEN kpi_type = 'outlier_rate' AND value > 15 THEN 'many_outliers' END AS flag FROM k""")(
    lambda t: v.kpi_table(report(t))
)

query("severity_bucket", KPI + """SELECT source, field_name, value,
    CASE WHEN value = 0 THEN 'ok' WHEN value <= 5 THEN 'warn' ELSE 'error' END AS severity FROM k WHERE kpi_type = 'null_rate'""")(
    lambda t: v.kpi_slice(report(t), "null_rate").select("source", "field_name", "value", severity("value").alias("severity"))
)

# Half of the statuses have a label, the others keep their code.
CODES = {"F": "Finished", "O": "Open"}
query("label_map", """SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open'
    ELSE o_orderstatus END AS label FROM orders""")(
    lambda t: v.label(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", CODES)
)

POP = """SELECT 'supplier_' || CAST(l_suppkey AS VARCHAR) AS name, CAST(sum(l_quantity) AS BIGINT) * 1000 AS listeners FROM lineitem GROUP BY l_suppkey"""
MENTIONS = """SELECT 'supplier_' || CAST(l_suppkey AS VARCHAR) AS name, count(*) AS mentions FROM lineitem GROUP BY l_suppkey"""
TOP10 = "(SELECT * FROM ({}) {} ORDER BY {} DESC, name LIMIT 10)"
POP10, MENTION10 = TOP10.format(POP, "p0", "listeners"), TOP10.format(MENTIONS, "m0", "mentions")


def _popularity(t):
    name = F.concat(F.lit("supplier_"), "l_suppkey").alias("name")
    pop = t.lineitem.groupBy(name).agg((F.sum("l_quantity").cast("long") * 1000).alias("listeners"))
    mentions = t.lineitem.groupBy(name).agg(F.count("*").alias("mentions"))
    return pop, mentions


query("shared_entities", f"SELECT m.name, mentions FROM {MENTION10} m WHERE m.name IN (SELECT name FROM {POP10} p)")(
    lambda t: v.shared_entities(*_popularity(t))
)
query("source_compare", f"""SELECT p.name, round(listeners / 1e6, 6) AS listeners_m, mentions,
    round(mentions * (max(listeners) OVER () / 1e6 / max(mentions) OVER ()), 6) AS scaled
  FROM {POP10} p LEFT JOIN {MENTION10} m ON m.name = p.name""")(
    lambda t: v.compare(*_popularity(t))
)

# --- pages -----------------------------------------------------------------------------------


def s_visible(x):
    bare = f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"
    return s_strip(f"regexp_replace({s_html(bare)}, '[{WS}]+', ' ', 'g')")


LINK = '(?s)<a[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
LINKS_SQL = f"""SELECT page_id, i - 1 AS pos, {s_visible('markup')} AS title, {s_html('permalink')} AS permalink FROM (
    SELECT page_id, unnest(regexp_extract_all(html, '{LINK}', 2)) AS markup, unnest(regexp_extract_all(html, '{LINK}', 1)) AS permalink,
      CAST(unnest(generate_series(1, len(regexp_extract_all(html, '{LINK}', 1)))) AS INTEGER) AS i FROM pages) l"""


@query("page_links", f"SELECT * FROM ({LINKS_SQL}) x WHERE title <> '' AND permalink <> ''")
def page_links(t):
    return pg.page_links(spread(t.pages))


query("next_link", """SELECT page_id, nullif(regexp_extract(html, 'href="([^"]*)"', 1), '') AS next_link FROM pages""")(
    lambda t: t.pages.select("page_id", pg.next_link(as_listing("html")).alias("next_link"))
)

PARAGRAPH = r"(?si)<p(?:[ \t\r\n\f][^>]*)?>(.*?)</p[ \t\r\n\f]*>"
NULL_TEXTS = "('null', 'none', 'nan', '', '[deleted]', '[removed]')"
TEXTS_SQL = f"""SELECT page_id, i - 1 AS pos, {s_visible('markup')} AS text FROM (
    SELECT page_id, unnest(regexp_extract_all(html, '{PARAGRAPH}', 1)) AS markup,
      CAST(unnest(generate_series(1, len(regexp_extract_all(html, '{PARAGRAPH}', 1)))) AS INTEGER) AS i FROM pages) l"""
# Other ways to write the same paragraphs; the SQL reads the pages as they are.
WRITTEN = """CASE page_id % 3 WHEN 1 THEN replace(html, '<p>', '<p class="x">')
  WHEN 2 THEN replace(replace(html, '<p>', '<P>'), '</p>', '</P >') ELSE html END"""
query("page_text", f"SELECT * FROM ({TEXTS_SQL}) x WHERE lower(text) NOT IN {NULL_TEXTS}")(
    lambda t: pg.page_text(spread(t.pages).select("page_id", F.expr(WRITTEN).alias("html")))
)

query("page_titles", f"SELECT page_id, {s_visible(chr(39).join(['regexp_extract(html, ', '(?s)<title>(.*?)</title>', ', 1)']))} AS title FROM pages")(
    lambda t: t.pages.select("page_id", pg.page_title("html").alias("title"))
)


def as_listing(html):
    """The pages' link lists as a listing: each entry a post with a score,
    and the first link once more as the next button."""
    html = F.col(html) if isinstance(html, str) else html
    posts = F.regexp_replace(
        html, '<li><a href="([^"]*)">([^<]*)</a></li>',
        '<div class="thing odd link" data-permalink="$1" data-score="$2"><p><a class="title may-blank" href="$1"><b>$2</b> post</a></div>',
    )
    first = F.regexp_extract(html, 'href="([^"]*)"', 1)
    return F.concat(posts, F.lit('<span class="nav next-button">\n<a rel="next" href="'), first, F.lit('">more</a></span>'))


@query("listing_posts", f"""SELECT page_id, pos, title || 'post' AS title, permalink,
    coalesce(TRY_CAST(title AS BIGINT), 0) AS score FROM ({LINKS_SQL}) x WHERE title <> '' AND permalink <> ''""")
def listing_posts(t):
    return pg.listing_posts(spread(t.pages).select("page_id", as_listing("html").alias("html")))


def as_thread(html):
    """The pages' paragraphs as top-level comments of a post page, each with
    one nested reply that must not be taken."""
    bodies = F.transform(
        F.regexp_extract_all(html, F.lit(pg.PARAGRAPH), F.lit(1)),
        lambda p: F.concat(
            F.lit('<div class="thing comment"><div class="usertext-body"><div class="md"><p>'),
            F.regexp_replace(p, pg.TAG, " "),
            F.lit('</p></div></div><div class="child"><div class="sitetable"><div class="thing comment">'
                  '<div class="usertext-body"><div class="md">reply</div></div></div></div></div></div>'),
        ),
    )
    return F.concat(
        F.lit('<div class="commentarea"><div class="sitetable nestedlisting">'), F.array_join(bodies, "\n"),
        F.lit("</div></div>"),
    )


THREAD_SQL = f"""SELECT page_id, i - 1 AS pos, {s_strip(s_html("regexp_replace(markup, '(?s)<[^>]*>', ' ', 'g')"))} AS text FROM (
    SELECT page_id, unnest(regexp_extract_all(html, '{PARAGRAPH}', 1)) AS markup,
      CAST(unnest(generate_series(1, len(regexp_extract_all(html, '{PARAGRAPH}', 1)))) AS INTEGER) AS i FROM pages) l"""


@query("page_comments", f"""SELECT * FROM ({THREAD_SQL}) x WHERE text <> ''
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pos) <= 5""")
def page_comments(t):
    return pg.page_comments(spread(t.pages).select("page_id", as_thread(F.col("html")).alias("html")))


HIT = " OR ".join(f"contains(lower(title), '{k}')" for k in REACTION_KEYWORDS)
POSTS_SQL = f"""SELECT page_id, 'site_' || CAST(page_id % 3 AS VARCHAR) AS source, length(html) AS score,
  '[FRESH ' || CAST(page_id AS VARCHAR) || '] ' || {s_visible(chr(39).join(['regexp_extract(html, ', '(?s)<title>(.*?)</title>', ', 1)']))} AS title FROM pages"""
ASSEMBLED_SQL = f"""SELECT source, page_id, {s_strip(f"regexp_replace(title, '^\\[.*?\\][{WS}]*', '')")} AS title, score, comments FROM (
    SELECT p.*, (SELECT string_agg(text, '|' ORDER BY pos) FROM (SELECT * FROM ({TEXTS_SQL}) y WHERE lower(text) NOT IN {NULL_TEXTS}
      QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pos) <= 5) c WHERE c.page_id = p.page_id) AS comments
    FROM ({POSTS_SQL}) p WHERE {HIT}) q WHERE comments IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY page_id) <= 35"""


@query("assemble_posts", ASSEMBLED_SQL)
def assemble_posts(t):
    posts = t.pages.select(
        "page_id", F.concat(F.lit("site_"), F.col("page_id") % 3).alias("source"),
        F.length("html").cast("long").alias("score"),
        F.concat(F.lit("[FRESH "), "page_id", F.lit("] "), pg.page_title("html")).alias("title"),
    )
    texts = pg.page_text(spread(t.pages), pg.COMMENTS_PER_POST)
    done = pg.assemble_posts(posts, texts, "source", "page_id")
    return done.withColumn("comments", F.array_join("comments", "|"))

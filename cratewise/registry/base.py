"""Registration, table access and the SQL twins of shared inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.functions.text import WORD, WS
from cratewise.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

COMPUTED_AT = "2024-03-01T00:00:00"


class Tables:
    """The parquet tables of one scale folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = prepare(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name`` with its equivalent SQL."""
    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- text functions in SQL ---------------------------------------------------------

def s_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def s_norm(x: str) -> str:
    return f"regexp_replace(lower({s_strip(x)}), '[{WS}]+', ' ', 'g')"


def s_links(x: str) -> str:
    bare = f"regexp_replace({x}, 'http[^{WS}]+|www\\.[^{WS}]+', '', 'g')"
    return f"regexp_replace({bare}, '\\[.*?\\]\\(http[^{WS}]+\\)', '', 'g')"


def s_punct(x: str) -> str:
    return f"regexp_replace({x}, '[^{WORD}{WS}/&\\-'']', '', 'g')"


def s_html(x: str) -> str:
    """The entities of the test tables; a cut-off one lacks its semicolon."""
    for entity, char in (
        ("&#39;", "''"), ("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&"),
    ):
        x = f"regexp_replace({x}, '{entity}', '{char}', 'g')"
    return x


def s_clean(x: str) -> str:
    return s_norm(s_punct(s_links(s_html(x))))


def s_name_tokens(x: str) -> str:
    return s_strip(s_links(s_punct(s_html(s_norm(x)))))


def s_tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{WS}]+'), lambda w: w <> '')"


def s_words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{WS}]+'))"


def s_round(x: str, digits: int = 4) -> str:
    """Half up on the decimal text of a double, as Spark rounds."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


# --- inputs ------------------------------------------------------------------------

# Comments with every pattern, out of the part table (valid in both engines).
COMMENT = """CASE p_partkey % 6
  WHEN 0 THEN p_brand || ' - ' || p_name
  WHEN 1 THEN p_name || ' by ' || p_brand
  WHEN 2 THEN p_name || ' but ' || p_type
  WHEN 3 THEN '[deleted]'
  WHEN 4 THEN p_type || ': ' || p_name
  ELSE '(' || p_name || ') Next http://x.io/' || CAST(p_partkey AS STRING) || ' &amp; more' END"""

PART_STAMP = "'2024-01-' || lpad(CAST(1 + p_partkey % 28 AS STRING), 2, '0') || 'T10:00:00'"
DOC_STAMP = "'2024-02-' || lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0') || 'T08:30:00'"

COMMENTS_SQL = f"""SELECT p_partkey AS comment_id, p_brand AS title, CAST(p_size AS BIGINT) AS score,
  {COMMENT} AS raw_comment, {PART_STAMP} AS ingested_at FROM part"""

# Daily chart snapshots out of the event stream.
SNAPSHOT_SQL = """SELECT 'user_' || CAST(user_id AS STRING) AS name, event_type AS artist_name,
  CAST(floor(value * 1000) AS BIGINT) AS playcount, CAST(floor(value * 10) AS BIGINT) AS listeners,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'id' || CAST(user_id AS STRING) END AS mbid,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at FROM events"""


def comments(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("comment_id"), F.col("p_brand").alias("title"),
        F.col("p_size").cast("long").alias("score"),
        F.expr(COMMENT).alias("raw_comment"), F.expr(PART_STAMP).alias("ingested_at"),
    )


def snapshots(t: Tables) -> DataFrame:
    return t.events.select(
        F.concat(F.lit("user_"), "user_id").alias("name"),
        F.col("event_type").alias("artist_name"),
        F.floor(F.col("value") * 1000).cast("long").alias("playcount"),
        F.floor(F.col("value") * 10).cast("long").alias("listeners"),
        F.when(F.col("event_id") % 10 != 0, F.concat(F.lit("id"), "user_id")).alias("mbid"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingested_at"),
    )

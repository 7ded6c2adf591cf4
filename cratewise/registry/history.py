"""Stored sketches merged over ranges of days, judged against the rows they stand for."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratewise.operators import sketches as sk
from cratewise.registry.base import query
from cratewise.session import materialize

# --- quantiles of events --------------------------------------------------------------

SINCE, UNTIL = "2024-01-08", "2024-01-21"
FIELDS, PROBS = ["value", "user_id"], [0.25, 0.5, 0.75]
# A sketch states its error for 99 of 100 cases; twice that is never left in practice.
SLACK = 2 * sk.rank_error()


def stored_quantiles(t):
    """The table of sketches, as a run would leave it."""
    return materialize(sk.quantile_sketches(t.events, F.col("event_type"), F.to_date("ts"), FIELDS), "quantile-sketches")


def event_values(t, since=SINCE, until=UNTIL):
    """(source, field, value) of the rows behind a range of days."""
    day = F.to_date("ts")
    rows = t.events.filter(day.between(F.to_date(F.lit(since)), F.to_date(F.lit(until))))
    values = [F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value")) for c in FIELDS]
    return rows.select(F.col("event_type").alias("source"), F.inline(F.array(*values))).filter("value IS NOT NULL")


def _values_sql(columns):
    rows = " UNION ALL ".join(
        f"SELECT event_type AS source, '{c}' AS field, CAST(ts AS DATE) AS day, CAST({c} AS DOUBLE) AS value FROM events" for c in FIELDS)
    return f"SELECT {columns} FROM ({rows}) r WHERE day BETWEEN DATE '{SINCE}' AND DATE '{UNTIL}'"


@query("quantile_history", f"""SELECT v.*, CAST(p AS DOUBLE) AS p, true AS within FROM (
    {_values_sql('source, field, count(DISTINCT day) AS days, count(value) AS n, min(value) AS low, max(value) AS high')}
    GROUP BY source, field) v, (SELECT unnest({PROBS}) AS p) g""")
def quantile_history(t):
    """Quartiles of two weeks from the stored days. ``within``: the share of rows below each is what the
    sketch promises."""
    merged = sk.merged_quantiles(stored_quantiles(t), SINCE, UNTIL)
    grid = F.array(*[F.lit(p) for p in PROBS])
    found = sk.sketch_quantiles(merged, PROBS).withColumn("p", grid).select(
        "source", "field", "days", "n", "low", "high", F.inline(F.arrays_zip("p", "quantiles")))
    keys = ["source", "field", "p", "days", "n", "low", "high"]
    below, upto = F.count_if(F.col("value") < F.col("quantiles")), F.count_if(F.col("value") <= F.col("quantiles"))
    judged = event_values(t).join(found, ["source", "field"]).groupBy(*keys).agg(
        ((below / F.col("n") <= F.col("p") + SLACK) & (upto / F.col("n") >= F.col("p") - SLACK)).alias("within"))
    return judged.select("source", "field", "days", "n", "low", "high", "p", "within")


# --- distinct orders by return flag -----------------------------------------------------

FIRST, LAST, ONE = "1993-01-01", "1997-12-31", "R"
# Standard errors that an estimate may be off.
SIGMAS = 4


@query("distinct_history", f"""WITH r AS (SELECT DISTINCT l_returnflag AS source, l_orderkey AS item, CAST(l_shipdate AS DATE) AS day FROM lineitem
    WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}')
  SELECT source, count(DISTINCT day) AS days, count(DISTINCT item) AS items,
    count(DISTINCT item) FILTER (item IN (SELECT item FROM r WHERE source = '{ONE}')) AS shared,
    true AS items_within, true AS shared_within FROM r GROUP BY source""")
def distinct_history(t):
    """Orders with a line of each return flag over five years, and those that also have a returned line: exact
    numbers, and whether the estimates from the stored days are within their own errors."""
    day = F.to_date("l_shipdate")
    stored = materialize(sk.distinct_sketches(t.lineitem, F.col("l_returnflag"), day, F.col("l_orderkey")), "distinct-sketches")
    guess = sk.shared_with(sk.merged_distinct(stored, FIRST, LAST), ONE).withColumnsRenamed({"items": "about", "shared": "about_shared"})
    rows = t.lineitem.filter(day.between(F.to_date(F.lit(FIRST)), F.to_date(F.lit(LAST)))).select(
        F.col("l_returnflag").alias("source"), F.col("l_orderkey").alias("item")).distinct()
    one = rows.filter(F.col("source") == ONE).select("item", F.lit(True).alias("also"))
    exact = rows.join(one, "item", "left").groupBy("source").agg(F.count("*").alias("items"), F.count("also").alias("shared"))
    off = SIGMAS * sk.distinct_error()
    return exact.join(guess, "source").select(
        "source", "days", "items", "shared",
        (F.abs(F.col("about") - F.col("items")) <= off * F.col("items")).alias("items_within"),
        (F.abs(F.col("about_shared") - F.col("shared")) <= SIGMAS * F.col("shared_error")).alias("shared_within"),
    )

"""Data-quality KPIs, outliers, duplicates and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratewise.operators import dedup as dd
from cratewise.operators import quality as q
from cratewise.operators import quantiles as qt
from cratewise.operators.clean import split_invalid
from cratewise.operators.metrics import union_rows
from cratewise.registry.base import COMPUTED_AT, SNAPSHOT_SQL, query, s_strip, snapshots

# --- tables with gaps ------------------------------------------------------------------

GAPPY = """o_orderkey AS id, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
  nullif(o_custkey % 10, 0) AS segment, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS status,
  CASE WHEN o_custkey % 7 = 0 THEN 'unknown' ELSE o_orderpriority END AS note, o_totalprice AS price"""
GAPPY_FIELDS = ["id", "priority", "segment", "status", "note", "price", "ingested_at"]
GAPPY_SQL = f"SELECT {GAPPY}, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS ingested_at FROM orders"


def gappy(t):
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')").alias("priority"),
        F.expr("nullif(o_custkey % 10, 0)").alias("segment"),
        F.expr("CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END").alias("status"),
        F.expr("CASE WHEN o_custkey % 7 = 0 THEN 'unknown' ELSE o_orderpriority END").alias("note"),
        F.col("o_totalprice").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"),
    )


def _each(columns, row):
    return " UNION ALL ".join(row.format(c=c) for c in columns)


query("null_rate", f"""WITH g AS ({GAPPY_SQL}) SELECT true AS blanks, * FROM ({_each(GAPPY_FIELDS, '''
    SELECT '{c}' AS field, count(*) FILTER ({c} IS NULL OR CAST({c} AS VARCHAR) = '') AS n,
      round(count(*) FILTER ({c} IS NULL OR CAST({c} AS VARCHAR) = '') / count(*) * 100, 4) AS rate FROM g''')}) a
  UNION ALL SELECT false, * FROM ({_each(GAPPY_FIELDS, '''
    SELECT '{c}', count(*) FILTER ({c} IS NULL), round(count(*) FILTER ({c} IS NULL) / count(*) * 100, 4) FROM g''')}) b""")(
    lambda t: union_rows(*[
        q.null_rates(gappy(t), blanks).select(F.lit(blanks).alias("blanks"), "*") for blanks in (True, False)])
)

query("null_unknown_rate", f"""WITH g AS ({GAPPY_SQL}) SELECT * FROM ({_each(GAPPY_FIELDS, '''
    SELECT '{c}' AS field, count(*) FILTER ({c} IS NULL) AS nulls, round(count(*) FILTER ({c} IS NULL) / count(*) * 100, 2) AS null_rate,
      count(*) FILTER (CAST({c} AS VARCHAR) = 'unknown') AS unknowns,
      round(count(*) FILTER (CAST({c} AS VARCHAR) = 'unknown') / count(*) * 100, 2) AS unknown_rate FROM g''')}) a
  WHERE nulls + unknowns > 0""")(
    lambda t: q.relevant_nulls(q.null_unknown_rates(gappy(t)))
)


def _compliance_sql(columns):
    ok = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return f"""SELECT count(*) AS total, count(*) FILTER ({ok}) AS compliant,
      round(count(*) FILTER ({ok}) / count(*) * 100, 4) AS compliance FROM ({GAPPY_SQL}) g"""


REQUIRED = ["id", "status", "segment", "ingested_at"]
query("schema_compliance", _compliance_sql(GAPPY_FIELDS))(lambda t: q.compliance(gappy(t)))
query("schema_compliance_required", _compliance_sql(REQUIRED))(lambda t: q.compliance(gappy(t), REQUIRED))

# --- outliers and descriptions -------------------------------------------------------------

NUMBERS = {"events": ["value", "user_id"], "lineitem": ["l_quantity", "l_extendedprice", "l_discount"]}


def _box_sql(table, c):
    return f"""SELECT '{c}' AS field, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS med,
      quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3, count({c}) AS n FROM {table}"""


def _iqr_sql(table, c):
    return f"""SELECT field, round(q1, 2) AS q1, round(med, 2) AS med, round(q3, 2) AS q3, round(q3 - q1, 2) AS iqr,
      round(lo, 2) AS lo, round(hi, 2) AS hi, n,
      (SELECT count(*) FROM {table} WHERE {c} < lo OR {c} > hi) AS n_out,
      round((SELECT count(*) FROM {table} WHERE {c} < lo OR {c} > hi) / n * 100, 2) AS rate,
      round((SELECT CAST(min({c}) AS DOUBLE) FROM {table} WHERE {c} >= lo AND {c} <= hi), 2) AS lo_whisker,
      round((SELECT CAST(max({c}) AS DOUBLE) FROM {table} WHERE {c} >= lo AND {c} <= hi), 2) AS hi_whisker
    FROM (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM ({_box_sql(table, c)}) b) f"""


query("iqr_table", " UNION ALL ".join(_iqr_sql(table, c) for table, cols in NUMBERS.items() for c in cols))(
    lambda t: union_rows(*[qt.iqr_table(getattr(t, table), cols) for table, cols in NUMBERS.items()])
)


def _describe_sql(table, c):
    return f"""SELECT b.field, b.n AS count, round(m, 4) AS mean, round(s, 4) AS std, round(lo, 4) AS min,
      round(q1, 4) AS q25, round(med, 4) AS q50, round(q3, 4) AS q75, round(hi, 4) AS max
    FROM ({_box_sql(table, c)}) b, (SELECT avg({c}) AS m, stddev_samp({c}) AS s, CAST(min({c}) AS DOUBLE) AS lo,
      CAST(max({c}) AS DOUBLE) AS hi FROM {table}) d"""


query("describe_numeric", " UNION ALL ".join(_describe_sql(table, c) for table, cols in NUMBERS.items() for c in cols))(
    lambda t: union_rows(*[qt.describe(getattr(t, table), cols) for table, cols in NUMBERS.items()])
)

CAPPED_SQL = " , ".join(
    f"""least(greatest(CAST({c} AS DOUBLE), (SELECT q1 - 1.5 * (q3 - q1) FROM ({_box_sql('events', c)}) b)),
      (SELECT q3 + 1.5 * (q3 - q1) FROM ({_box_sql('events', c)}) b)) AS {c}_capped""" for c in NUMBERS["events"]
)
query("cap_outliers", f"SELECT event_id, {CAPPED_SQL} FROM events")(
    lambda t: qt.cap_outliers(t.events.select("event_id", "value", "user_id"), ["value", "user_id"]).select(
        "event_id", "value_capped", "user_id_capped")
)


# Quartiles that are off by twice the error, which leaves room for the rounding of a rank.
OFF = [p + d for p in (0.25, 0.75) for d in (-2 * q.OUTLIER_ERROR, 0, 2 * q.OUTLIER_ERROR)]
# Ends of the fences from such quartiles: (name, low end, high end).
RATES = [
    ("rate", "2.5 * {q1} - 1.5 * {q3}", "2.5 * {q3} - 1.5 * {q1}"),
    ("rate_low", "2.5 * {q1_less} - 1.5 * {q3_more}", "2.5 * {q3_more} - 1.5 * {q1_less}"),
    ("rate_high", "2.5 * {q1_more} - 1.5 * {q3_less}", "2.5 * {q3_less} - 1.5 * {q1_more}"),
]
EDGES = ["q1_less", "q1", "q1_more", "q3_less", "q3", "q3_more"]


def _rates_sql(table, c):
    ends = {edge: f"CAST(qs[{i + 1}] AS DOUBLE)" for i, edge in enumerate(EDGES)}
    shares = ", ".join(
        f"round(count(*) FILTER ({c} < CAST({lo.format(**ends)} AS DOUBLE) OR {c} > CAST({hi.format(**ends)} AS DOUBLE)) / count(*) * 100, 4) AS {name}"
        for name, lo, hi in RATES)
    return f"""SELECT '{c}' AS field, count({c}) AS n, {shares}, true AS in_bounds
      FROM {table}, (SELECT quantile_cont(CAST({c} AS DOUBLE), {OFF}) AS qs FROM {table}) k"""


@query("outlier_rate_approx", " UNION ALL ".join(
    _rates_sql(table, c) for table, cols in (("lineitem", NUMBERS["lineitem"]), ("events", ["value"])) for c in cols))
def outlier_rate_approx(t):
    """The exact rate, and the least and greatest one that quartiles within their error can give; the
    approximate rate must lie between these."""
    def verdict(df, cols):
        facts = []
        for c, edges in qt.exact_quantiles(df, cols, OFF).items():
            ends = {edge: f"double('{x!r}')" for edge, x in zip(EDGES, edges)}
            shares = ", ".join(
                f"'{name}', round(count_if({c} < {lo.format(**ends)} OR {c} > {hi.format(**ends)}) / count(*) * 100, 4)".replace("2.5 ", "2.5D ").replace("1.5 ", "1.5D ")
                for name, lo, hi in RATES)
            facts.append(f"named_struct('field', '{c}', 'n', count({c}), {shares})")
        exact = df.selectExpr(f"array({', '.join(facts)}) AS facts").select(F.inline("facts"))
        # One row per column on either side.
        rates = qt.outlier_rates(df, cols, q.OUTLIER_ERROR).withColumnRenamed("rate", "about")
        return exact.join(F.broadcast(rates), "field").withColumn(
            "in_bounds", F.col("about").between(F.col("rate_low"), F.col("rate_high"))).drop("about")

    return verdict(t.lineitem, NUMBERS["lineitem"]).unionByName(verdict(t.events, ["value"]))


# --- text lengths, days ---------------------------------------------------------------------

query("text_length_kpis", " UNION ALL ".join(
    f"SELECT '{c}' AS field, kpi, CAST(value AS DOUBLE) AS value FROM (SELECT avg(length({c})) AS text_len_mean, "
    f"CAST(quantile_disc(length({c}), 0.5) AS DOUBLE) AS text_len_median, CAST(min(length({c})) AS DOUBLE) AS text_len_min, "
    f"CAST(max(length({c})) AS DOUBLE) AS text_len_max FROM documents) UNPIVOT (value FOR kpi IN "
    f"(text_len_mean, text_len_median, text_len_min, text_len_max))" for c in ("text", "lang", "source")))(
    lambda t: q.text_length_kpis(t.documents, ["text", "lang", "source"])
)

query("text_length_exact", " UNION ALL ".join(
    f"SELECT '{c}' AS field, round(avg(length({c})), 1) AS mean, round(quantile_cont(CAST(length({c}) AS DOUBLE), 0.5), 1) AS median, "
    f"min(length({c})) AS min, max(length({c})) AS max FROM documents" for c in ("text", "source")))(
    lambda t: q.text_length_exact(t.documents, ["text", "source"])
)

query("ingestion_days", f"SELECT count(DISTINCT ingested_at[1:10]) AS ingestion_days FROM ({SNAPSHOT_SQL}) s")(
    lambda t: q.ingestion_days(snapshots(t))
)

# Orders of a weekend are taken in on the Monday after it, so weekends are the gaps.
query("ingestion_gaps", """WITH run AS (SELECT d + CAST(CASE dayofweek(d) WHEN 6 THEN 2 WHEN 0 THEN 1 ELSE 0 END AS INTEGER) AS d
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) o)
  SELECT CAST(g AS DATE) AS day FROM (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS g FROM run) s
  WHERE CAST(g AS DATE) NOT IN (SELECT d FROM run)""")(
    lambda t: q.ingestion_gaps(t.orders.select(F.to_date("o_orderdate").alias("d")).select(
        F.date_format(F.expr("date_add(d, CASE dayofweek(d) WHEN 7 THEN 2 WHEN 1 THEN 1 ELSE 0 END)"), "yyyy-MM-dd").alias("ingested_at")))
)

# --- the KPI report ---------------------------------------------------------------------------

REPORT = {
    "orders": (GAPPY_SQL, GAPPY_FIELDS, ["price"], ["priority", "note"]),
    "customers": (
        "SELECT c_custkey, c_name, c_acctbal, c_mktsegment, '2024-02-29T12:00:00' AS ingested_at FROM customer",
        ["c_custkey", "c_name", "c_acctbal", "c_mktsegment", "ingested_at"], ["c_acctbal", "c_custkey"], ["c_name", "c_mktsegment"],
    ),
    "parts": (
        "SELECT p_partkey, p_name, p_type, p_size, p_retailprice, '2024-01-' || lpad(CAST(1 + p_partkey % 28 AS VARCHAR), 2, '0') AS ingested_at FROM part",
        ["p_partkey", "p_name", "p_type", "p_size", "p_retailprice", "ingested_at"], ["p_size", "p_retailprice"], ["p_name", "p_type"],
    ),
}


def report_inputs(t):
    customers = t.customer.select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment", F.lit("2024-02-29T12:00:00").alias("ingested_at"))
    parts = t.part.select(
        "p_partkey", "p_name", "p_type", "p_size", "p_retailprice",
        F.expr("'2024-01-' || lpad(CAST(1 + p_partkey % 28 AS STRING), 2, '0')").alias("ingested_at"))
    return {"orders": gappy(t), "customers": customers, "parts": parts}


def report(t):
    return union_rows(*[
        q.governance_report(df, name, REPORT[name][2], REPORT[name][3], COMPUTED_AT)
        for name, df in report_inputs(t).items()
    ])


def _report_sql(name, source, fields, numbers, texts):
    rows = ["SELECT 'ALL' AS field_name, 'volume' AS kpi_type, CAST(count(*) AS DOUBLE) AS value, 'count' AS unit FROM g"]
    rows += [
        f"SELECT '{c}', 'null_rate', round(count(*) FILTER ({c} IS NULL OR CAST({c} AS VARCHAR) = '') / count(*) * 100, 4), 'percentage' FROM g"
        for c in fields
    ]
    whole = " AND ".join(f"{c} IS NOT NULL" for c in fields)
    rows.append(f"SELECT 'ALL', 'schema_compliance', round(count(*) FILTER ({whole}) / count(*) * 100, 4), 'percentage' FROM g")
    for c in numbers:
        fence = f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM g)"
        rows.append(
            f"SELECT '{c}', 'outlier_rate', round(count(*) FILTER (q1 <> q3 AND ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))) / count(*) * 100, 4), 'percentage' FROM g, {fence} f"
        )
    for c in texts:
        for kpi, value in (
            ("mean", f"avg(length({c}))"), ("median", f"quantile_disc(length({c}), 0.5)"),
            ("min", f"min(length({c}))"), ("max", f"max(length({c}))"),
        ):
            rows.append(f"SELECT '{c}', 'text_len_{kpi}', coalesce(CAST({value} AS DOUBLE), 0), 'characters' FROM g")
    rows.append("SELECT 'ingested_at', 'ingestion_days', CAST(count(DISTINCT ingested_at[1:10]) AS DOUBLE), 'days' FROM g")
    return f"""(WITH g AS ({source}) SELECT '{name}' AS source, *, (SELECT max(ingested_at)[1:10] FROM g) AS data_date,
      '{COMPUTED_AT}' AS computed_at FROM ({" UNION ALL ".join(rows)}) k WHERE (SELECT count(*) FROM g) > 0)"""


REPORT_SQL = " UNION ALL ".join(f"SELECT * FROM {_report_sql(name, *spec)} r" for name, spec in REPORT.items())
query("governance_report", REPORT_SQL)(report)



@query("governance_empty_source", f"""SELECT * FROM {_report_sql('customers', *REPORT['customers'])} a UNION ALL SELECT * FROM
  {_report_sql('orders', f"SELECT * FROM ({GAPPY_SQL}) e WHERE price < 0", *REPORT['orders'][1:])} b""")
def governance_empty_source(t):
    inputs = report_inputs(t)
    inputs = {"customers": inputs["customers"], "orders": inputs["orders"].filter("price < 0")}
    return union_rows(*[
        q.governance_report(df, name, REPORT[name][2], REPORT[name][3], COMPUTED_AT) for name, df in inputs.items()])


# --- records and duplicates --------------------------------------------------------------------

RECORDS = """event_id, CASE WHEN user_id % 9 = 0 THEN ' ' WHEN user_id % 9 = 1 THEN NULL ELSE 'user' END AS name,
  event_type AS artist_name, CAST(floor(value) AS BIGINT) - 10 AS playcount"""


@query("invalid_records", f"""SELECT event_id, playcount, coalesce(playcount > 0 AND name IS NOT NULL AND {s_strip('name')} <> ''
    AND {s_strip('artist_name')} <> '', false) AS valid FROM (SELECT {RECORDS} FROM events) r""")
def invalid_records(t):
    rows = t.events.select(
        "event_id",
        F.expr("CASE WHEN user_id % 9 = 0 THEN ' ' WHEN user_id % 9 = 1 THEN NULL ELSE 'user' END").alias("name"),
        F.col("event_type").alias("artist_name"),
        (F.floor("value").cast("long") - 10).alias("playcount"),
    )
    valid, rejects = split_invalid(rows, ["name", "artist_name"], "playcount")
    return union_rows(*[
        df.select("event_id", "playcount", F.lit(ok).alias("valid")) for df, ok in ((valid, True), (rejects, False))])


PLAIN_SQL = "SELECT user_id, event_type, CAST(ts AS DATE) AS day FROM events"
query("dedup_exact", f"SELECT DISTINCT * FROM ({PLAIN_SQL}) p")(
    lambda t: dd.dedup_exact(t.events.select("user_id", "event_type", F.to_date("ts").alias("day")))
)

query("duplicate_report", f"""SELECT count(*) AS total, count(*) - count(DISTINCT (user_id, event_type, day)) AS exact_dups,
    count(*) - count(DISTINCT (user_id, day)) AS key_dups,
    round((count(*) - count(DISTINCT (user_id, event_type, day))) / count(*) * 100, 2) AS exact_rate,
    round((count(*) - count(DISTINCT (user_id, day))) / count(*) * 100, 2) AS key_rate FROM ({PLAIN_SQL}) p""")(
    lambda t: dd.duplicate_report(
        t.events.select("user_id", "event_type", F.to_date("ts").alias("day")), ["user_id", "day"])
)

SNAP_COLUMNS = "name, artist_name, playcount, listeners, mbid, ingested_at"
LATEST_SQL = f"""SELECT {SNAP_COLUMNS} FROM ({SNAPSHOT_SQL}) s QUALIFY row_number() OVER (PARTITION BY name, ingested_at[1:10]
  ORDER BY ingested_at DESC, playcount DESC, listeners DESC) = 1"""
query("dedup_latest_daily", LATEST_SQL)(lambda t: dd.dedup_daily(snapshots(t), ["name"]))

query("dedup_max_metric", f"""SELECT {SNAP_COLUMNS} FROM ({SNAPSHOT_SQL}) s QUALIFY row_number() OVER (
    PARTITION BY name ORDER BY playcount DESC, name DESC, artist_name DESC, listeners DESC, mbid DESC NULLS LAST, ingested_at DESC) = 1""")(
    lambda t: dd.dedup_max(snapshots(t), ["name"], "playcount")
)

query("first_n_per_group", """SELECT conv_id, turn, role, text FROM conversations
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 2""")(
    lambda t: dd.first_n(t.conversations, ["conv_id"], ["turn"], 2)
)

SUMMARY = f"""SELECT count(*) AS rows, 6 AS columns, count(*) FILTER (mbid IS NULL) AS null_count,
  max_by(name, (listeners, name)) AS top_name, count(DISTINCT name) AS names, count(*) FILTER (artist_name <> 'error') AS with_artist
  FROM ({SNAPSHOT_SQL}) s"""


@query("run_summary", f"SELECT rows, CAST(columns AS BIGINT) AS columns, null_count, top_name, names, with_artist FROM ({SUMMARY}) x")
def run_summary(t):
    rows = snapshots(t)
    artist = F.when(F.col("artist_name") != "error", F.col("artist_name"))
    return q.run_summary(
        rows, top_name=q.top_name("name", "listeners"), names=F.count_distinct("name"),
        with_artist=q.with_artist(artist),
    )



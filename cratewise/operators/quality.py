"""Data-quality KPIs and gates."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from cratewise import schemas
from cratewise.functions.text import day, is_blank
from cratewise.operators.clean import cast_to
from cratewise.operators.quantiles import FENCE, exact_quantiles

OUTLIER_ERROR = 0.01


def _empty(c: str, blanks: bool = True) -> Column:
    missing = F.col(c).isNull()
    return missing | (F.col(c).cast("string") == "") if blanks else missing


def _all_present(cols: list[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in cols])


def _percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(F.try_divide(part, whole) * 100, digits)


def data_date(ts: str = "ingested_at") -> Column:
    """Aggregate: first ten characters of the latest stamp."""
    return F.substring(F.max(ts), 1, 10)


def distinct_days(ts: str = "ingested_at") -> Column:
    """Aggregate: number of distinct days. The set is bounded by the calendar
    and, unlike a distinct count, does not multiply the input rows."""
    return F.size(F.collect_set(day(ts)))


# --- single KPIs --------------------------------------------------------------

def volume(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("volume"))


def null_rates(df: DataFrame, blanks: bool = True) -> DataFrame:
    """``(field, n, rate)``: nulls (and empty text) per column, one pass."""
    cols = df.columns
    counts = df.agg(
        F.count("*").alias("_total"),
        *[F.count_if(_empty(c, blanks)).alias(c) for c in cols],
    )
    return counts.unpivot(["_total"], cols, "field", "n").select(
        "field", "n", F.coalesce(_percent(F.col("n"), F.col("_total"), 4), F.lit(0.0)).alias("rate")
    )


def compliance(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Percent of rows whose (required) columns are all non-null."""
    ok = F.count_if(_all_present(required or df.columns))
    return df.agg(
        F.count("*").alias("total"),
        ok.alias("compliant"),
        F.coalesce(_percent(ok, F.count("*"), 4), F.lit(0.0)).alias("compliance"),
    )


def null_unknown_rates(df: DataFrame) -> DataFrame:
    """Null and 'unknown' counts and rates (two digits) per column."""
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    pairs = [
        F.struct(
            F.lit(c).alias("field"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            (F.count_if(F.col(c) == schemas.UNKNOWN) if c in text else F.lit(0).cast("long")).alias("unknowns"),
        ).alias(c)
        for c in df.columns
    ]
    rows = df.agg(F.count("*").alias("_total"), *pairs).select(
        "_total", F.inline(F.array(*[F.col(c) for c in df.columns]))
    )
    return rows.select(
        "field", "nulls", _percent(F.col("nulls"), F.col("_total"), 2).alias("null_rate"),
        "unknowns", _percent(F.col("unknowns"), F.col("_total"), 2).alias("unknown_rate"),
    )


def relevant_nulls(report: DataFrame) -> DataFrame:
    """Only columns with a null or unknown value, worst first."""
    return report.filter(F.col("nulls") + F.col("unknowns") > 0).orderBy(
        F.desc("null_rate"), F.desc("unknown_rate"), "field"
    )


def text_length_kpis(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(field, kpi, value)``; the median is approximate (error 1/10000)."""
    stats = df.agg(*[F.array(*_length_stats(c)).alias(c) for c in cols])
    return (
        stats.unpivot([], cols, "field", "stats")
        .select("field", F.posexplode("stats").alias("i", "value"))
        .select("field", F.element_at(F.array(*[F.lit(k) for k in LENGTH_KPIS]), F.col("i") + 1).alias("kpi"), "value")
    )


LENGTH_KPIS = ["text_len_mean", "text_len_median", "text_len_min", "text_len_max"]


def _length_stats(c: str) -> list[Column]:
    size = F.length(c)
    stats = [F.avg(size), F.percentile_approx(size, F.lit(0.5)), F.min(size), F.max(size)]
    return [F.coalesce(s.cast("double"), F.lit(0.0)) for s in stats]


def text_length_exact(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(field, mean, median, min, max)`` with the exact median, one digit."""
    sizes = df.selectExpr(*[f"length(`{c}`) AS `{c}`" for c in cols])
    facts = [
        f"named_struct('field', '{c}', 'mean', round(avg(`{c}`), 1), 'median', round({'CAST(NULL AS DOUBLE)' if median is None else f'{median!r}D'}, 1), "
        f"'min', CAST(min(`{c}`) AS BIGINT), 'max', CAST(max(`{c}`) AS BIGINT))"
        for c, (median,) in exact_quantiles(sizes, cols, [0.5]).items()
    ]
    return sizes.selectExpr(f"array({', '.join(facts)}) AS facts").select(F.inline("facts"))


def ingestion_days(df: DataFrame, ts: str = "ingested_at") -> DataFrame:
    return df.agg(distinct_days(ts).cast("long").alias("ingestion_days"))


def ingestion_gaps(df: DataFrame, ts: str = "ingested_at") -> DataFrame:
    """Days without a run between the first and the last one."""
    days = df.select(day(ts).alias("day")).distinct()
    span = days.agg(F.min("day").alias("first"), F.max("day").alias("last")).filter("first IS NOT NULL")
    expected = span.select(F.explode(F.sequence("first", "last")).alias("day"))
    return expected.join(days, "day", "left_anti")


# --- the report ---------------------------------------------------------------

def _kpi(field: str, kpi: str, value: str, unit: str) -> str:
    return (
        f"named_struct('field_name', '{field}', 'kpi_type', '{kpi}', "
        f"'value', coalesce(CAST({value} AS DOUBLE), 0D), 'unit', '{unit}', 'data_date', _date)"
    )


def governance_report(
    df: DataFrame,
    source: str,
    num_cols: list[str],
    text_cols: list[str],
    computed_at: str,
    ts: str = "ingested_at",
) -> DataFrame:
    """All KPI rows of one source in two scans, whatever its width.

    The first aggregate yields every count, length and quartile; it reaches
    the second scan, which counts the outliers, as one scalar value. A source
    without rows yields no KPI rows.
    """
    cols = df.columns
    num_cols = [c for c in num_cols if c in cols]
    text_cols = [c for c in text_cols if c in cols]
    accuracy = round(1 / OUTLIER_ERROR)
    facts = [
        "count(*) AS _n",
        f"substring(max(`{ts}`), 1, 10) AS _date",
        "count_if(" + " AND ".join(f"`{c}` IS NOT NULL" for c in cols) + ") AS _compliant",
        f"size(collect_set(try_cast(substring(`{ts}`, 1, 10) AS DATE))) AS _days",
    ]
    facts += [f"count_if(`{c}` IS NULL OR CAST(`{c}` AS STRING) = '') AS _null{j}" for j, c in enumerate(cols)]
    facts += [
        f"percentile_approx(CAST(`{c}` AS DOUBLE), array(0.25D, 0.75D), {accuracy}) AS _q{j}"
        for j, c in enumerate(num_cols)
    ]
    for j, c in enumerate(text_cols):
        size = f"length(`{c}`)"
        facts.append(
            f"array(avg({size}), percentile_approx({size}, 0.5D), min({size}), max({size})) AS _len{j}"
        )
    hidden = [_kpi(c, "fence_input", f"_q{j}[{i}]", "") for j, c in enumerate(num_cols) for i in (0, 1)]
    shown = [
        _kpi("ALL", "volume", "_n", "count"),
        *[_kpi(c, "null_rate", f"round(try_divide(_null{j}, _n) * 100, 4)", "percentage") for j, c in enumerate(cols)],
        _kpi("ALL", "schema_compliance", "round(try_divide(_compliant, _n) * 100, 4)", "percentage"),
        *[
            _kpi(c, kpi, f"_len{j}[{i}]", "characters")
            for j, c in enumerate(text_cols) for i, kpi in enumerate(LENGTH_KPIS)
        ],
        _kpi(ts, "ingestion_days", "_days", "days"),
    ]
    # An array cannot be pruned field by field, so this stays one subquery.
    packed = df.selectExpr(*facts).selectExpr(
        f"CASE WHEN _n > 0 THEN array({', '.join(hidden + shown)}) END AS _kpis"
    )
    if num_cols:
        known = packed.scalar()
        outside = []
        for j, c in enumerate(num_cols):
            q1, q3 = known[2 * j]["value"], known[2 * j + 1]["value"]
            margin = (q3 - q1) * FENCE
            outside.append(F.count_if((margin != 0) & ~F.col(c).between(q1 - margin, q3 + margin)).alias(f"_out{j}"))
        outliers = [
            _kpi(c, "outlier_rate", f"round(try_divide(_out{j}, _n) * 100, 4)", "percentage")
            for j, c in enumerate(num_cols)
        ]
        counted = df.agg(F.count("*").alias("_n"), *outside).withColumn("_kpis", known)
        packed = counted.selectExpr("*", "_kpis[0].data_date AS _date").selectExpr(
            f"concat(_kpis, array({', '.join(outliers)})) AS _kpis"
        )
    return packed.select(F.inline("_kpis")).filter("kpi_type <> 'fence_input'").select(
        F.lit(source).alias("source"), "field_name", "kpi_type", "value", "unit", "data_date",
        F.lit(computed_at).alias("computed_at"),
    )


# --- gates --------------------------------------------------------------------

def required_nulls(df: DataFrame, schema: StructType) -> DataFrame:
    """Null count of every required column, one pass."""
    cols = schemas.required(schema)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).unpivot([], cols, "field", "nulls")


def enforce_schema(df: DataFrame, schema: StructType, mode: str = "strict") -> tuple[DataFrame, DataFrame | None]:
    """``(df, rejects)`` in the declared columns and types.

    Optional nulls become 'unknown'. A null, or a value that does not fit its
    type, in a required column fails the job in ``strict`` mode (no extra
    pass over the data) and moves the row to the rejects in ``rejects`` mode.
    """
    if mode not in ("strict", "rejects"):
        raise ValueError(f"unknown mode: {mode}")
    missing = [c for c in schemas.required(schema) if c not in df.columns]
    if missing:
        raise ValueError(f"required fields are missing: {missing}")
    typed = cast_to(df, schema).na.fill(schemas.UNKNOWN, subset=schemas.optional(schema))
    needed = schemas.required(schema)
    if mode == "rejects":
        return typed.filter(_all_present(needed)), typed.filter(~_all_present(needed))

    def checked(f):
        if f.nullable:
            return F.col(f.name)
        failure = F.raise_error(F.lit(f"required field '{f.name}' is null")).cast(f.dataType)
        return F.coalesce(F.col(f.name), failure).alias(f.name)

    return typed.select(*[checked(f) for f in schema]), None


def validate_table(spark, path: str, schema: StructType) -> DataFrame:
    """One summary row of a written table; fails on a missing field or no rows."""
    df = spark.read.parquet(path)
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"fields are missing in {path}: {missing}")
    if df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return run_summary(df)


def run_summary(df: DataFrame, **extra: Column) -> DataFrame:
    """Rows, columns, total of nulls, plus named aggregates of the caller."""
    nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns])
    return df.agg(
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        nulls.alias("null_count"),
        *[value.alias(name) for name, value in extra.items()],
    )


def top_name(name: str, metric: str) -> Column:
    """Aggregate: name of the largest metric, ties by name."""
    return F.max(F.struct(F.col(metric), F.col(name)))[name]


def with_artist(artist="artist") -> Column:
    """Aggregate: rows that have an extracted artist."""
    return F.count_if(~is_blank(artist))

"""Presentation queries over KPI and metric rows."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratewise.functions.labels import full_field, kpi_flag, millions
from cratewise.operators.metrics import top_k
from cratewise.operators.quality import LENGTH_KPIS


def latest_run(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows of the last run, overall or per ``by`` (such as the metric type)."""
    if not by:
        return df.filter(F.col("computed_at") == df.agg(F.max("computed_at")).scalar())
    last = df.groupBy(*by).agg(F.max("computed_at").alias("computed_at"))
    return df.join(last, [*by, "computed_at"], "left_semi")


def kpi_slice(kpis: DataFrame, kpi_type: str, source: str | None = None, field: str | None = None) -> DataFrame:
    rows = kpis.filter(F.col("kpi_type") == kpi_type)
    if source is not None:
        rows = rows.filter(F.col("source") == source)
    return rows if field is None else rows.filter(F.col("field_name") == field)


def metric_slice(metrics: DataFrame, metric_type: str) -> DataFrame:
    return metrics.filter(F.col("metric_type") == metric_type)


def _kpi_value(kpi_type: str) -> Column:
    return F.max(F.when(F.col("kpi_type") == kpi_type, F.col("value")))


def pivot_kpi(kpis: DataFrame, kpi_type: str, name: str) -> DataFrame:
    return kpi_slice(kpis, kpi_type).groupBy("source").agg(F.max("value").alias(name))


def kpi_summary(kpis: DataFrame) -> DataFrame:
    """Volume, compliance and ingestion days side by side: the left join of
    three slices on ``source`` as one conditional aggregate."""
    return (
        kpis.groupBy("source")
        .agg(
            _kpi_value("volume").cast("long").alias("total_records"),
            _kpi_value("schema_compliance").alias("schema_compliance"),
            _kpi_value("ingestion_days").alias("ingestion_days"),
        )
        .filter("total_records IS NOT NULL")
    )


def text_kpi_pivot(kpis: DataFrame) -> DataFrame:
    """(source, field) by text-length KPI, one digit."""
    wide = (
        kpis.filter(F.col("kpi_type").isin(LENGTH_KPIS))
        .groupBy("source", "field_name")
        .pivot("kpi_type", LENGTH_KPIS)
        .agg(F.avg("value"))
    )
    return wide.select("source", "field_name", *[F.round(k, 1).alias(k) for k in LENGTH_KPIS])


def arg_max(value, ret) -> Column:
    """Aggregate: ``ret`` of the row with the largest ``value``; of several,
    the smallest ``ret``."""
    value = F.col(value) if isinstance(value, str) else value
    ret = F.col(ret) if isinstance(ret, str) else ret
    return F.min(F.struct((-value).alias("v"), ret.alias("r")))["r"]


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """Card numbers: volume, mean compliance, mean outlier rate, worst null rate."""
    nulls = (F.col("kpi_type") == "null_rate") & (F.col("value") > 0)
    worst = F.min(F.when(nulls, F.struct((-F.col("value")).alias("v"), F.col("field_name").alias("r"))))
    return kpis.agg(
        F.sum(F.when(F.col("kpi_type") == "volume", F.col("value"))).cast("long").alias("records"),
        F.round(F.avg(F.when(F.col("kpi_type") == "schema_compliance", F.col("value"))), 4).alias("mean_compliance"),
        F.round(F.avg(F.when(F.col("kpi_type") == "outlier_rate", F.col("value"))), 4).alias("mean_outlier_rate"),
        F.coalesce(F.max(F.when(nulls, F.col("value"))), F.lit(0.0)).alias("max_null_rate"),
        worst["r"].alias("max_null_field"),
    )


def kpi_flags(kpis: DataFrame) -> DataFrame:
    return kpis.withColumn("flag", kpi_flag("kpi_type", "value"))


def kpi_table(kpis: DataFrame) -> DataFrame:
    """The quality table: presentation names, three digits, flag, full field."""
    return kpi_flags(kpis).select(
        F.col("source").alias("Source"),
        F.col("field_name").alias("Field"),
        full_field("source", "field_name").alias("FullField"),
        F.col("kpi_type").alias("KPI"),
        F.round("value", 3).alias("Value"),
        F.col("unit").alias("Unit"),
        F.col("data_date").alias("DataDate"),
        "flag",
    )


def label(df: DataFrame, col: str, lookup: dict[str, str], name: str = "label") -> DataFrame:
    """Map codes to labels; unmapped codes keep their code."""
    pairs = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in lookup.items()))
    return df.withColumn(name, F.coalesce(F.try_element_at(pairs, F.col(col)), F.col(col)))


def top_entities(metrics: DataFrame, metric_type: str, order: str, k: int) -> DataFrame:
    return top_k(metric_slice(metrics, metric_type), [F.desc(order), F.asc("dim1")], k)


def shared_entities(pop: DataFrame, mentions: DataFrame, k: int = 10) -> DataFrame:
    """Top-k mentions ``(name, mentions)`` whose name is also among the top-k
    popular ``(name, listeners)``. Both sides hold k rows."""
    most_popular = top_k(pop, [F.desc("listeners"), F.asc("name")], k)
    most_mentioned = top_k(mentions, [F.desc("mentions"), F.asc("name")], k)
    return most_mentioned.join(F.broadcast(most_popular), "name", "left_semi")


def compare(pop: DataFrame, mentions: DataFrame, k: int = 10) -> DataFrame:
    """Popularity in millions beside mentions, rescaled to the same axis."""
    most_popular = top_k(pop, [F.desc("listeners"), F.asc("name")], k)
    shared = shared_entities(pop, mentions, k)
    everything = Window.partitionBy()
    joined = most_popular.join(F.broadcast(shared), "name", "left")
    scale = millions(F.max("listeners").over(everything)) / F.max("mentions").over(everything)
    return joined.select(
        "name",
        F.round(millions("listeners"), 6).alias("listeners_m"),
        "mentions",
        F.round(F.col("mentions") * scale, 6).alias("scaled"),
    )


def last_updated(df: DataFrame, col: str = "computed_at") -> DataFrame:
    """Time of the last run as ``yyyy-MM-dd  HH:mm UTC``."""
    stamp = F.max(col)
    text = F.concat(F.substring(stamp, 1, 10), F.lit("  "), F.substring(stamp, 12, 5), F.lit(" UTC"))
    return df.agg(F.coalesce(text, F.lit("N/A")).alias("last_updated"))

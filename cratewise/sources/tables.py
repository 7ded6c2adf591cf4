"""Parquet and CSV tables: silver read/write, gold month upsert, history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from cratewise.operators.dedup import dedup_latest
from cratewise.session import staged

MONTHS = ["year", "month"]


def read_table(spark: SparkSession, folder: str, schema: StructType | None = None) -> DataFrame:
    """All Parquet files of a folder as one table."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(folder)


def read_if_any(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """As ``read_table``; a folder that does not exist is an empty table."""
    found = _if_there(lambda: spark.read.schema(schema).parquet(folder))
    return spark.createDataFrame([], schema) if found is None else found


def _if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` returns, None if its path does not exist; other errors are raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_silver(df: DataFrame, schema: StructType, folder: str) -> None:
    """Overwrite the current table in the declared column order."""
    df.select(*schema.names).write.mode("overwrite").option("compression", "snappy").parquet(folder)


def merge_partitions(
    new: DataFrame, path: str, parts: list[str], dedup: Callable[[DataFrame], DataFrame],
) -> None:
    """Merge rows into the partitions they touch; other partitions stay as is.

    The new rows are materialised first, then only the touched partitions are
    read. ``parts`` must be calendar columns, which bounds their distinct
    values. The dynamic overwrite stages its files and swaps them in on
    commit, so the same path can be read and replaced by one job, and a lost
    executor or a repeated run leaves the same table.
    """
    spark = new.sparkSession
    place = F.concat_ws("|", *[F.col(c).cast("string") for c in parts])
    with staged(new, "merge") as rows:
        touched = [r[0] for r in rows.select(place).distinct().collect()]
        if not touched:
            return
        existing = read_if_any(spark, path, rows.schema).filter(place.isin(touched))
        merged = dedup(existing.unionByName(rows))
        # Rebalance splits a large partition over several files and tasks.
        merged.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(path)


def upsert_months(rows: DataFrame, path: str, key: list[str] | None = None) -> None:
    """Route rows to ``year=/month=`` by their own ``data_date`` and merge.

    The identity of a row is every column but ``computed_at`` (a re-run with
    a changed value keeps both rows), or ``key`` when given; the last run of
    an identity stays.
    """
    date = F.col("data_date").try_cast("date")
    routed = rows.withColumns({"year": F.year(date), "month": F.month(date)})
    identity = key or [c for c in rows.columns if c != "computed_at"]

    def dedup(df: DataFrame) -> DataFrame:
        if key is None:
            return df.groupBy(*identity, *MONTHS).agg(F.max("computed_at").alias("computed_at")).select(*df.columns)
        return dedup_latest(df, [*identity, *MONTHS], "computed_at")

    merge_partitions(routed, path, MONTHS, dedup)


def with_months(schema: StructType) -> StructType:
    return StructType([*schema.fields, *[StructField(c, IntegerType()) for c in MONTHS]])


def read_history(spark: SparkSession, path: str, schema: StructType, csv: str | None = None,
                 since: str | None = None) -> DataFrame:
    """All months, always with ``data_date``, in no order.

    Without a gold table the CSV export is read, without that no rows. Older
    tables name the date ``ingest_date`` and have no month folders. The schema
    is declared, so no footer is read to plan, and ``since`` (``yyyy-MM-dd``)
    prunes month folders before rows are filtered.
    """
    declared = with_months(StructType([*schema.fields, StructField("ingest_date", StringType())]))
    found = _if_there(lambda: spark.read.schema(declared).parquet(path))
    if found is None:
        if csv is None:
            return spark.createDataFrame([], schema)
        found = spark.read.option("header", True).option("escape", '"').csv(csv)
    if "ingest_date" in found.columns:
        found = found.withColumn(
            "data_date",
            F.coalesce("data_date", "ingest_date") if "data_date" in found.columns else F.col("ingest_date"),
        )
    if since is not None:
        if set(MONTHS) <= set(found.columns):
            year, month = int(since[:4]), int(since[5:7])
            found = found.filter(
                F.col("year").isNull() | (F.col("year") > year) | ((F.col("year") == year) & (F.col("month") >= month))
            )
        found = found.filter(F.col("data_date") >= since)
    typed = [
        (F.col(f.name).try_cast(f.dataType) if f.name in found.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ]
    return found.select(*typed)


def write_csv(df: DataFrame, folder: str) -> None:
    (
        df.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    )


def read_csv(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Doubled quotes, and line breaks inside quotes, as the exports have them."""
    return (
        spark.read.schema(schema).option("header", True).option("escape", '"')
        .option("multiLine", True).csv(folder)
    )


def fingerprint(spark: SparkSession, path: str) -> str:
    """Changes when any file below ``path`` is added, replaced or removed.

    One row per file, whose content is not read, and order-free sums of
    per-file hashes, so no list of files is collected.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    files = _if_there(lambda: listing.load(path))
    if files is None:
        return "empty"
    each = files.select(F.xxhash64("path", "length", "modificationTime").alias("h"))
    row = each.agg(
        F.count("*").alias("n"),
        F.sum(F.col("h").cast("decimal(20,0)")).alias("total"),
        F.bit_xor("h").alias("mix"),
    ).select(F.sha2(F.concat_ws("|", "n", "total", "mix"), 256).alias("key"), "n").first()
    return row["key"] if row["n"] else "empty"


def day_schema(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("day", DateType())])


def text_schema(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])

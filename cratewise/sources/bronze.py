"""Raw snapshots and posts, and the append-only snapshot sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cratewise import schemas
from cratewise.functions.text import name_tokens, strip
from cratewise.session import materialize
from cratewise.sources.arrays import read_arrays

# Fixed value: the run stamp at the end of a post file's name.
STAMP = r"_(\d{8}_\d{6})\.json$"
PAGE_SIZE = 50


# --- chart snapshots --------------------------------------------------------------

def read_envelopes(spark: SparkSession, folder: str, schema: StructType, lines: bool = False) -> DataFrame:
    """One row per snapshot: a JSON document per file, or with ``lines`` one
    per line (splittable, the form ``write_snapshot`` appends). The payload's
    own ``_metadata`` hides the file columns of that name, so the path of the
    file is added explicitly."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    raw = reader.option("multiLine", not lines).json(folder)
    return raw.withColumn("file", raw.metadataColumn("_metadata")["file_path"])


def _accepted() -> Column:
    return F.col("error").isNull() & F.col("_metadata.ingested_at").isNotNull()


def split_errors(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(ok, rejects)``: an error payload or a missing envelope is a reject."""
    rejects = raw.filter(~_accepted()).select(
        "file", F.col("error").alias("code"),
        F.coalesce("message", F.lit("no snapshot envelope")).alias("message"),
    )
    return raw.filter(_accepted()), rejects


def explode_records(envelopes: DataFrame, data_key: str, record_key: str) -> DataFrame:
    """``(record, ingested_at)``: one row per chart entry."""
    return envelopes.select(
        F.explode(f"data.{data_key}.{record_key}").alias("record"),
        F.col("_metadata.ingested_at").alias("ingested_at"),
    )


def read_snapshots(
    spark: SparkSession, folder: str, data_key: str, record_key: str, lines: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)`` of all snapshots in a folder."""
    schema = {"artists": schemas.ARTIST_SNAPSHOT, "tracks": schemas.TRACK_SNAPSHOT}[data_key]
    ok, rejects = split_errors(read_envelopes(spark, folder, schema, lines))
    return explode_records(ok, data_key, record_key), rejects


def count_of(c) -> Column:
    """A count sent as text: missing is 0, unreadable is null (a reject)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), F.lit(0)).otherwise(strip(c.cast("string")).try_cast("long")).cast("long")


def _name(c: str) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def _id(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def flatten_artists(records: DataFrame) -> DataFrame:
    flat = records.select(
        _name("record.name").alias("name"),
        count_of("record.playcount").alias("playcount"),
        count_of("record.listeners").alias("listeners"),
        _id("record.mbid").alias("mbid"),
        "ingested_at",
    )
    return flat.withColumn("name_tokens", name_tokens("name")).select(*schemas.ARTISTS.names)


def flatten_tracks(records: DataFrame) -> DataFrame:
    flat = records.select(
        _name("record.name").alias("name"),
        count_of("record.duration").alias("duration_sec"),
        count_of("record.playcount").alias("playcount"),
        count_of("record.listeners").alias("listeners"),
        _id("record.mbid").alias("mbid"),
        _name("record.artist.name").alias("artist_name"),
        _id("record.artist.mbid").alias("artist_mbid"),
        "ingested_at",
    )
    return flat.withColumns({
        "name_tokens": name_tokens("name"),
        "artist_name_tokens": name_tokens("artist_name"),
    }).select(*schemas.TRACKS.names)


def validate_batch(envelopes: DataFrame, data_key: str, record_key: str) -> DataFrame:
    """``(file, ingested_at, count, top_name)`` of every snapshot file."""
    records = F.col(f"data.{data_key}.{record_key}")
    return envelopes.select(
        "file",
        F.col("_metadata.ingested_at").alias("ingested_at"),
        F.coalesce(F.size(records), F.lit(0)).cast("long").alias("count"),
        F.coalesce(F.get(records, F.lit(0))["name"], F.lit("N/A")).alias("top_name"),
    )


# --- the append-only sink ---------------------------------------------------------

def build_envelopes(
    df: DataFrame, page: Column, record_key: str, ingested_at, source: str, method: str,
    order: list | None = None,
) -> DataFrame:
    """One envelope per page of records: metadata with the record count, and
    the records themselves. ``page`` must bound the records of a page."""
    stamp = F.lit(ingested_at) if isinstance(ingested_at, str) else ingested_at
    entry = F.struct(*(order or []), F.struct(*df.columns).alias("r"))
    pages = df.groupBy(page.alias("page")).agg(
        F.count("*").alias("n"),
        F.array_sort(F.collect_list(entry)).alias("rows"),
        F.max(stamp).alias("stamp"),
    )
    return pages.select(
        "page",
        _envelope_metadata(F.col("stamp"), source, method, record_key),
        _envelope_data(F.transform("rows", lambda r: r["r"]), record_key),
    )


def _envelope_metadata(stamp: Column, source: str, method: str, record_key: str) -> Column:
    return F.struct(
        stamp.alias("ingested_at"), F.lit(source).alias("source"),
        F.lit(method).alias("method"), F.col("n").alias(f"{record_key}_count"),
    ).alias("_metadata")


def _envelope_data(records: Column, record_key: str) -> Column:
    return F.struct(F.struct(records.alias(record_key)).alias(f"{record_key}s")).alias("data")


def write_snapshot(
    df: DataFrame, folder: str, record_key: str, ingested_at: str, source: str, method: str,
    page_size: int = PAGE_SIZE,
) -> str:
    """Append the rows as immutable envelopes under a run-stamped folder.

    Pages follow the rows of each task, so no page holds more than
    ``page_size`` records and none needs a count of the whole input. The rows
    are materialised first: a repeated task then numbers them the same way.
    """
    df = materialize(df, "snapshot")
    row = F.monotonically_increasing_id()  # task in the upper bits, row in the lower 33
    task = F.shiftright(row, 33)
    page = F.struct(task.alias("task"), F.floor((row - F.shiftleft(task, 33)) / page_size).alias("n"))
    numbered = df.withColumn("_page", page).withColumn("_row", row)
    path = f"{folder}/run={ingested_at.replace(':', '').replace('-', '')}"
    pages = numbered.groupBy("_page").agg(
        F.count("*").alias("n"),
        F.array_sort(F.collect_list(F.struct("_row", F.struct(*df.columns).alias("r")))).alias("rows"),
    )
    envelope = pages.select(
        _envelope_metadata(F.lit(ingested_at), source, method, record_key),
        _envelope_data(F.transform("rows", lambda r: r["r"]), record_key),
    )
    envelope.write.mode("errorifexists").json(path)
    return path


# --- posts ------------------------------------------------------------------------

def read_posts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """``(posts, rejects)`` of all post files.

    Posts are ``(file, file_stamp, post_id, title, score, comments)``; a file
    that is no JSON list, a cut-off one too, is a reject ``(file, message)``.
    A post file is one JSON array of any length: it is read by byte ranges, and
    ``post_id`` runs over the files in name order.
    """
    rows, damaged = read_arrays(spark, folder, schemas.POSTS.elementType)
    file = F.regexp_extract("path", "([^/]+)$", 1)
    posts = rows.select(
        file.alias("file"), F.regexp_extract(file, STAMP, 1).alias("file_stamp"), F.col("id").alias("post_id"),
        "element.title", "element.score", "element.comments",
    )
    return posts, damaged.select(file.alias("file"), F.lit("no JSON list of posts").alias("message"))


def latest_stamp(posts: DataFrame) -> DataFrame:
    return posts.agg(F.max("file_stamp").alias("latest"))


def stamp_to_iso(stamp) -> Column:
    """``20260528_232927`` as ``2026-05-28T23:29:27``."""
    stamp = F.col(stamp) if isinstance(stamp, str) else stamp
    return F.regexp_replace(
        stamp, r"^(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})$", "$1-$2-$3T$4:$5:$6"
    )


def read_post_table(spark: SparkSession, path: str) -> DataFrame:
    """A post file as a plain table, schema inferred (for a look at the data)."""
    return spark.read.option("multiLine", True).json(path)

"""JSON arrays in files of any size, read by byte ranges.

A range does not know where it begins: inside a string, behind a backslash, how
deep. So every range is scanned for each state it may begin in, the ranges of a
file are chained through these short results, and then each range yields the
elements that begin in it, reading on behind its end for the last one. A file
that is not one list of objects, a cut-off one too, is a reject as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cratewise.files import located
from cratewise.session import materialize

RANGE_BYTES = 4 << 20
NO_LIST = "no JSON list of objects"
# States at a byte: outside strings, in a string, in a string behind a backslash.
OUTSIDE, STRING, ESCAPED = range(3)
QUOTE, BACKSLASH, COMMA, OPEN_LIST, CLOSE_LIST, OPEN, CLOSE = b'"\\,[]{}'
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0D]] = True
ELEMENT, SEPARATOR = "e", "s"


def scan(data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Depth after each byte, relative to the start, and the state at the end."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64), state
    at = np.arange(n)
    slash = data == BACKSLASH
    # Backslashes in a row right before each byte; one may stand before the range.
    last = np.maximum.accumulate(np.where(slash, -1 - (state == ESCAPED), at))
    run = np.r_[int(state == ESCAPED), (at - last)[:-1]]
    quote = (data == QUOTE) & (run % 2 == 0)
    inside = (np.cumsum(quote) + (state != OUTSIDE)) % 2 == 1
    step = ((data == OPEN) | (data == OPEN_LIST)).astype(np.int64) - ((data == CLOSE) | (data == CLOSE_LIST))
    depth = np.cumsum(np.where(inside, 0, step))
    if not inside[-1]:
        return depth, OUTSIDE
    return depth, ESCAPED if slash[-1] and (n - 1 - last[-1]) % 2 == 1 else STRING


def _read(path: str, start: int, size: int) -> np.ndarray:
    system, own = located(path)
    with system.open_input_file(own) as file:
        return np.frombuffer(file.read_at(size, start), dtype=np.uint8)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each state that a range may begin in: the state at its end, and how much deeper it is there."""
    for batch in batches:
        out = []
        for path, start, size in zip(*[c.to_pylist() for c in batch.columns]):
            data = _read(path, start, size)
            found = [scan(data, s) for s in (OUTSIDE, STRING, ESCAPED)]
            out.append([path, start, size, [s for _, s in found], [int(d[-1]) if len(d) else 0 for d, _ in found]])
        if out:
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0]), *[pa.array(c, pa.int64()) for c in columns[1:3]], *[pa.array(c, pa.list_(pa.int64())) for c in columns[3:]]],
                ["path", "start", "size", "states", "deeper"],
            )


def _chained(frame: pd.DataFrame) -> pd.DataFrame:
    """State and depth at the beginning of each range of a file, and whether the file ends closed."""
    state, depth, rows = OUTSIDE, 0, []
    for start, size, states, deeper in frame.sort_values("start")[["start", "size", "states", "deeper"]].itertuples(index=False):
        rows.append([frame["path"].iloc[0], start, size, state, depth])
        state, depth = int(states[state]), depth + int(deeper[state])
    closed = state == OUTSIDE and depth == 0
    return pd.DataFrame([[*r, closed] for r in rows], columns=["path", "start", "size", "state", "depth", "closed"])


def _rest(path: str, start: int, state: int, depth: int, step: int) -> bytes:
    """From ``start`` on, inside an element, to the byte that closes it (or the end of the file)."""
    out = []
    while True:
        data = _read(path, start, step)
        deep, state = scan(data, state)
        done = np.flatnonzero(depth + deep == 1)
        if len(done) or not len(data):
            return b"".join([*out, data[: done[0] + 1].tobytes() if len(done) else b""])
        out.append(data.tobytes())
        start, depth = start + len(data), depth + int(deep[-1])


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements that begin in each range, and a row about the range itself (without text)."""
    names = ["path", "start", "nth", "text", "elements", "lists", "first", "last", "wrong"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
    for batch in batches:
        for path, start, size, state, base, closed in zip(*[c.to_pylist() for c in batch.columns]):
            data = _read(path, start, size)
            deep, end = scan(data, state)
            after = base + deep
            before = np.r_[base, after[:-1]] if len(data) else after
            begins = np.flatnonzero((before == 1) & (after == 2))
            commas = np.flatnonzero((before == 1) & (after == 1) & (data == COMMA))
            flat = (before == after) & ~BLANK[data]
            wrong = (
                not closed or (after < 0).any() or (flat & (before == 0)).any() or (flat & (before == 1) & (data != COMMA)).any()
                or (data[begins] != OPEN).any() or (data[(before == 0) & (after == 1)] != OPEN_LIST).any()
                or (data[(before == 1) & (after == 0)] != CLOSE_LIST).any()
            )
            lists = int(((before == 0) & (after == 1)).sum())
            order = np.argsort(np.r_[begins, commas], kind="stable")
            events = np.r_[np.zeros(len(begins), int), np.ones(len(commas), int)][order]
            wrong = bool(wrong or (events[1:] == events[:-1]).any())
            kind = (ELEMENT, SEPARATOR)
            rows = [(path, start, None, None, len(begins), lists, kind[events[0]] if len(events) else None, kind[events[-1]] if len(events) else None, wrong)]
            if not wrong:
                closes = np.flatnonzero((before == 2) & (after == 1))
                for nth, at in enumerate(begins):
                    stop = closes[np.searchsorted(closes, at)] + 1 if len(closes) and closes[-1] > at else None
                    text = data[at:stop].tobytes()
                    if stop is None:
                        text += _rest(path, start + len(data), end, int(after[-1]), size)
                    rows.append((path, start, nth, text.decode("utf-8", "replace"), *[None] * 5))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _judged(frame: pd.DataFrame) -> pd.DataFrame:
    """Whether a file is a list: its ranges are sound, and elements and commas alternate across them."""
    frame = frame.sort_values("start")
    wrong, before = bool(frame["wrong"].any() or frame["lists"].sum() != 1), SEPARATOR
    for first, last in frame[["first", "last"]].itertuples(index=False):
        if first is not None:
            wrong |= first == before
            before = last
    empty = int(frame["elements"].sum()) == 0 and not frame["first"].notna().any()
    return pd.DataFrame({"path": [frame["path"].iloc[0]], "bad": [bool(wrong or (before == SEPARATOR and not empty))]})


def running_totals(counts: DataFrame, order: list[str], n: str) -> DataFrame:
    """``counts`` with ``before``: the sum of ``n`` over the rows that come first in ``order``.

    Rows are dealt out by ranges of the order; only one total per range is summed in one place.
    """
    ranged = materialize(counts.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "running")
    past = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum(n).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.join(F.broadcast(totals), "_range")  # one row per shuffle partition
    return summed.withColumn("before", F.col("_base") + F.coalesce(F.sum(n).over(within), F.lit(0))).drop("_range", "_base")


def read_arrays(spark: SparkSession, folder: str, element: StructType, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of the files below ``folder``, each one JSON list of objects.

    Rows are ``(path, id, element)``: ``id`` runs without gaps over all good files
    in the order of their names, ``element`` has the declared fields. A file is a
    reject ``(path, message)`` as a whole if it is no list of objects, is cut off,
    or has an element that does not parse. An empty list is a file without rows; a file
    without a byte is not listed by Spark and gives neither.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    ranges = materialize(listing.select("path", F.explode(starts).alias("start"), F.lit(range_bytes).cast("long").alias("size")), "ranges")
    tasks = max(1, min(ranges.count(), 4 * spark.sparkContext.defaultParallelism))
    dealt = ranges.repartition(tasks, "path", "start")
    ends = dealt.mapInArrow(_ends, "path string, start long, size long, states array<long>, deeper array<long>")
    known = ends.groupBy("path").applyInPandas(_chained, "path string, start long, size long, state long, depth long, closed boolean")
    found = materialize(
        known.repartition(tasks, "path", "start")
        .mapInArrow(_elements, "path string, start long, nth long, text string, elements long, lists long, first string, last string, wrong boolean"), "elements"
    )
    about = found.filter("nth is null")
    judged = about.select("path", "start", "elements", "lists", "first", "last", "wrong").groupBy("path").applyInPandas(_judged, "path string, bad boolean")
    broken = StructField("_broken", StringType())
    options = {"columnNameOfCorruptRecord": "_broken"}
    parsed = found.filter("nth is not null").select("path", "start", "nth", F.from_json("text", StructType([*element.fields, broken]), options).alias("e"))
    unfit = parsed.filter("e is null or e._broken is not null").select("path")
    bad = materialize(judged.filter("bad").select("path").unionByName(unfit).distinct(), "bad-files")
    counts = about.select("path", "start", "elements").join(bad, "path", "left_anti")
    counts = counts.withColumn("name", F.regexp_extract("path", "([^/]+)$", 1))
    first = running_totals(counts, ["name", "path", "start"], "elements").select("path", "start", "before")
    rows = parsed.join(first, ["path", "start"]).select(
        "path", (F.col("before") + F.col("nth")).alias("id"), F.struct(*[F.col(f"e.{f.name}") for f in element]).alias("element")
    )
    return rows, bad.select("path", F.lit(NO_LIST).alias("message"))

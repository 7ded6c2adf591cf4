"""Hilbert-curve shards for multidimensional file pruning.

Metadata columns are quantised, each row gets the index of its cell on a
Hilbert curve, and the rows in curve order are cut into runs of equal row
counts. Rows near each other in every dimension share a run, so the smallest
and largest values of a run prune it for filters on any of the dimensions.

There is no global sort. Cells are counted, a cell with many rows is split into
salted groups, and running totals over the counts give each group its first
rank; only rows of one small group are ever ordered together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratewise.functions.once import with_once
from cratewise.llm.stores import written

# Rows that are ordered together, at least; grows so that there are about GROUPS groups at most.
GROUP, GROUPS = 256, 1_000_000


def _prefix_number(name: str, skip: int) -> Column:
    """Seven bytes of a string, behind the bytes that all values share, as a number in string order."""
    part = F.substring(F.encode(F.col(name), "UTF-8"), skip + 1, 7)
    return F.conv(F.rpad(F.hex(part), 14, "0"), 16, 10).cast("long")


def _dimension(df: DataFrame, name: str, ends) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        low, high = (ends[f"{side}_{name}"] or "" for side in ("low", "high"))
        low, high = low.encode(), high.encode()
        skip = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        return _prefix_number(name, skip)
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.unix_seconds(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def quantised(df: DataFrame, dims: list[str], bits: int) -> DataFrame:
    """Add ``levels``: per dimension a whole number below 2**bits, by quantiles; null is 0.

    Two aggregates without grouping find the ends and 2**bits - 1 cut points of
    each dimension; only those numbers reach the driver.
    """
    ends = df.agg(*[f(name).alias(f"{side}_{name}") for name in dims for side, f in (("low", F.min), ("high", F.max))]).first()
    values = {name: _dimension(df, name, ends) for name in dims}
    steps = [i / 2**bits for i in range(1, 2**bits)]
    cuts = df.agg(*[F.percentile_approx(v, steps, 10_000).alias(name) for name, v in values.items()]).first()
    levels = [_level(value, sorted(set(cuts[name] or []))) for name, value in values.items()]
    return with_once(df, levels=F.array(*levels))


def _level(value: Column, cuts: list) -> Column:
    """The number of cut points up to a value."""
    if not cuts:
        return F.lit(0)
    return F.coalesce(F.when(value.isNotNull(), F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= value))), F.lit(0)).cast("int")


def with_hilbert(df: DataFrame, dims: int, bits: int) -> DataFrame:
    """Add ``cell``: the Hilbert index of ``levels`` (whole numbers below 2**bits)."""
    n, b = dims, bits
    q = f"shiftleft(1, {b - 1} - cast(k div {n} as int))"
    i = f"cast(k % {n} as int)"
    # Undo the curve's turns, from the highest bit down: invert the low bits of the first axis, or exchange them.
    turned = f"""aggregate(sequence(0, {(b - 1) * n - 1}), levels, (x, k) -> transform(x, (v, j) ->
        if((get(x, {i}) & {q}) <> 0, if(j = 0, v ^ ({q} - 1), v),
           if(j = 0 or j = {i}, v ^ ((get(x, 0) ^ get(x, {i})) & ({q} - 1)), v))))""" if b > 1 else "levels"
    gray = """aggregate(turned, cast(array() as array<int>), (y, v) -> concat(y, array(v ^ coalesce(get(y, size(y) - 1), 0))))"""
    flip = f"aggregate(sequence(1, {max(b - 1, 1)}), 0, (t, k) -> if((get(gray, {n - 1}) & shiftleft(1, k)) <> 0, t ^ (shiftleft(1, k) - 1), t))" if b > 1 else "0"
    index = f"""aggregate(sequence(0, {b * n - 1}), 0L, (acc, k) ->
        acc * 2 + (shiftright(get(gray, {i}) ^ flip, {b - 1} - cast(k div {n} as int)) & 1))"""
    for name, expression in (("turned", turned), ("gray", gray), ("flip", flip), ("cell", index)):
        df = with_once(df, **{name: F.expr(expression)})
    return df.drop("turned", "gray", "flip")


def ranked(df: DataFrame, bits: int) -> tuple[DataFrame, int]:
    """Add ``rank``, 0, 1, ... in order of ``cell`` (below 2**bits); and the number of rows.

    ``df`` is read several times: pass a written table of narrow rows.
    """
    cells = written(df.groupBy("cell").agg(F.count("*").alias("n")), "cells")
    total = cells.agg(F.sum("n")).first()[0] or 0
    group = max(GROUP, total // GROUPS)
    salts = cells.select("cell", F.ceil(F.col("n") / group).alias("salts"))
    row = F.xxhash64(*[c for c in df.columns if c != "levels"])
    dealt = df.join(salts, "cell").withColumn("salt", F.pmod(row, F.col("salts"))).drop("salts")
    counts = written(dealt.groupBy("cell", "salt").agg(F.count("*").alias("n")), "groups")
    # Running totals: within each of 1024 stretches of the curve, then over the stretches.
    stretch = F.shiftright("cell", max(bits - 10, 0))
    inside = counts.withColumn("stretch", stretch).withColumn(
        "before", F.sum("n").over(Window.partitionBy("stretch").orderBy("cell", "salt")) - F.col("n")
    )
    sums = counts.groupBy(stretch.alias("stretch")).agg(F.sum("n").alias("sum"))
    sums = sums.select("stretch", (F.sum("sum").over(Window.orderBy("stretch")) - F.col("sum")).alias("base"))
    first = written(
        inside.join(F.broadcast(sums), "stretch").select("cell", "salt", (F.col("before") + F.col("base")).alias("before")), "firsts"
    )
    order = [c for c in df.columns if c not in ("levels", "cell")]
    place = F.row_number().over(Window.partitionBy("cell", "salt").orderBy(*order))
    out = dealt.withColumn("place", place).join(first, ["cell", "salt"])
    return out.withColumn("rank", F.col("before") + F.col("place") - 1).drop("salt", "place", "before"), total


def hilbert_shards(rows: DataFrame, dims: list[str], shards: int, bits: int = 5) -> DataFrame:
    """Cut ``rows`` into ``shards`` runs along a Hilbert curve over ``dims``.

    Returns the columns of ``rows`` and ``cell`` (curve index), ``shard`` (0 to
    shards - 1; row counts differ by one at most) and ``slot`` (0, 1, ... in the
    shard). Rows of a cell are ordered by a hash and their columns; rows equal in
    every column are exchangeable. A null dimension counts as the lowest level.
    With fewer rows than shards some shards are empty; an empty table stays
    empty. Dimensions are numbers, dates, timestamps or strings; columns named
    ``levels``, ``cell``, ``shard`` or ``slot`` must be renamed first.
    """
    clash = {"levels", "cell", "shard", "slot", "rank", "salt", "place", "before"} & set(rows.columns)
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)}")
    spread = with_hilbert(quantised(rows, dims, bits), len(dims), bits).drop("levels")
    out, total = ranked(written(spread, "cells-of-rows"), bits * len(dims))
    out = out.withColumn("shard", F.expr(f"cast((rank * {shards}L) div {max(total, 1)}L as int)"))
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    return out.withColumn("slot", (F.col("rank") - first).cast("long")).drop("rank")


def shard_ranges(sharded: DataFrame, dims: list[str]) -> DataFrame:
    """Per shard, the smallest and largest value of each dimension: what a reader prunes by."""
    sides = [f(d).alias(f"{side}_{d}") for d in dims for side, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), *sides)


def shard_documents(docs: DataFrame, shards: int = 40, dims: tuple[str, ...] = ("source", "lang", "n_chars"), bits: int = 5) -> DataFrame:
    """Shards of documents by equal row counts: ``doc_id, size, text_crc32, law, shard,
    slot, grown_shard, cell``. Texts are read once and never shuffled. A null text
    has no bytes. Columns of ``docs`` beyond ``doc_id``, ``text`` and ``dims`` are ignored."""
    narrow = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), *[F.col(d).alias(f"dim_{d}") for d in dims],
    )
    out = hilbert_shards(written(narrow, "narrow"), [f"dim_{d}" for d in dims], shards, bits)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "cell"
    )

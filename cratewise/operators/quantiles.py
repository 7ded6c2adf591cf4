"""Quantiles, fences, capping and box-plot numbers.

Exact quantiles never sort a column in one place and never keep its distinct
values in one aggregation buffer. A first pass counts the values in bins of
about one percent relative width; the bin that holds a wanted rank and the
next one brackets both. If they lie in two bins, they are the ends of these
and known at once, however far the bins are apart. While a bracket holds too
many rows, further passes cut it into 4096 bins. The last pass counts what lies below each bracket and groups the
equal values inside it, and only the bins that hold the wanted ranks are
ordered. All passes are plain grouped counts, combined on the map side. The
rank is checked at the end, so a result is exact or the job fails.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.session import spread

# A bracket with at most this many rows is ordered, a larger one cut again.
SMALL = 1 << 22
CUTS = 4096
BINS = 512
FENCE = 1.5


def _numbers(df: DataFrame, cols: list[str]) -> DataFrame:
    """Numeric columns as double; NaN counts as missing."""
    return df.selectExpr(*[f"nullif(CAST(`{c}` AS DOUBLE), double('NaN')) AS `{c}`" for c in cols])


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literal(x: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if x is None else f"double('{x!r}')"


# Ranks `rank` and `rank + 1` against the rows a bin holds.
HOLDS = "rank + 1 >= upto - n AND rank < upto"


def _bracket_facts() -> list:
    """Aggregates over the one or two bins that hold a rank and the next. Of two bins,
    the lower one ends with the rank's value and the upper one begins with the next."""
    return [
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("inside"),
        F.when(F.count("*") == 2, F.struct(F.min("high").alias("v0"), F.max("low").alias("v1"))).alias("solved"),
    ]


def _open(brackets: list[dict], limit: int = 0) -> list[dict]:
    """Brackets not solved that hold more than ``limit`` rows and, with a limit, can be cut."""
    return [b for b in brackets if b["solved"] is None and (not limit or (b["inside"] > limit and b["low"] < b["high"]))]


def _first_brackets(numbers: DataFrame, cols: list[str], probs: list[float]) -> list[dict]:
    """Per column and probability: the wanted rank among 0..n-1 (``rank`` and
    a fractional ``part``), two values it lies between, and the rows there."""
    values = ", ".join(f"named_struct('j', {j}, 'value', `{c}`)" for j, c in enumerate(cols))
    grid = ", ".join(f"{float(p)!r}D" for p in probs)
    bins = (
        numbers.selectExpr(f"inline(array({values}))")
        .filter("value IS NOT NULL")
        .groupBy("j", F.expr("floor(greatest(least(signum(value) * log1p(abs(value)), 1000D), -1000D) * 100) AS bin"))
        .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    # At most 200,000 bins per column, whatever the data.
    rows = (
        bins.selectExpr(
            "*", "sum(n) OVER (PARTITION BY j ORDER BY bin ROWS UNBOUNDED PRECEDING) AS upto",
            "sum(n) OVER (PARTITION BY j) AS total",
        )
        .selectExpr("*", f"posexplode(array({grid})) AS (i, p)")
        .withColumn("rank", F.expr("floor(p * (total - 1))"))
        .filter(HOLDS)
        .groupBy("j", "i", "p", "total", "rank")
        .agg(*_bracket_facts())
        .collect()
    )
    return [
        {
            "k": k, "field": cols[r["j"]], "i": r["i"], "rank": r["rank"],
            "part": r["p"] * (r["total"] - 1) - r["rank"], "low": r["low"], "high": r["high"], "inside": r["inside"],
            "solved": r["solved"],
        }
        for k, r in enumerate(sorted(rows, key=lambda r: (r["j"], r["i"])))
    ]


def _in_brackets(numbers: DataFrame, brackets: list[dict], bins: int) -> DataFrame:
    """``(k, value, bin)`` of every value up to the bracket's high end; bin -1
    is below the bracket, the inside is cut evenly."""
    tested = ", ".join(
        f"named_struct('k', {b['k']}, 'value', `{b['field']}`, 'low', {_literal(b['low'])}, 'high', {_literal(b['high'])})"
        for b in brackets
    )
    return (
        numbers.selectExpr(f"inline(array({tested}))")
        .filter("value <= high")
        .selectExpr(
            "k", "value",
            f"""CASE WHEN value < low THEN -1L
                WHEN high > low THEN least(floor((value - low) / (high - low) * {bins}), {bins - 1}L)
                ELSE 0L END AS bin""",
        )
    )


def _ranks(brackets: list[dict]) -> str:
    """SQL array of the wanted ranks, addressed by ``k``."""
    ranks = {b["k"]: b["rank"] for b in brackets}
    return "array(" + ", ".join(f"{ranks.get(k, -2)}L" for k in range(max(ranks) + 1)) + ")"


def _narrow(numbers: DataFrame, brackets: list[dict]) -> bool:
    """Cut the given brackets once; False when none became smaller."""
    rows = (
        _in_brackets(numbers, brackets, CUTS)
        .groupBy("k", "bin")
        .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .selectExpr(
            "*", "sum(n) OVER (PARTITION BY k ORDER BY bin ROWS UNBOUNDED PRECEDING) AS upto",
            f"{_ranks(brackets)}[k] AS rank",
        )
        .filter(HOLDS)
        .groupBy("k")
        .agg(*_bracket_facts())
        .collect()
    )
    found = {r["k"]: r for r in rows}
    progress = False
    for b in brackets:
        row = found[b["k"]]
        progress |= row["solved"] is not None or row["inside"] < b["inside"]
        b.update(low=row["low"], high=row["high"], inside=row["inside"], solved=row["solved"])
    return progress


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Quantiles per column in the order of ``probs``, with linear
    interpolation between ranks; None for a column without values.

    Like ``DataFrame.approxQuantile`` this runs at once; a few numbers per
    column come back, never rows of the data.
    """
    numbers = spread(_numbers(df, cols))
    brackets = _first_brackets(numbers, cols, probs)
    result: dict[str, list[float | None]] = {c: [None] * len(probs) for c in cols}
    if not brackets:
        return result
    large = _open(brackets, SMALL)
    while large and _narrow(numbers, large):
        large = _open(large, SMALL)

    found = {b["k"]: tuple(b["solved"]) for b in brackets if b["solved"] is not None}
    if _open(brackets):
        found |= _picked(numbers, _open(brackets))
    for b in brackets:
        v0, v1 = found.get(b["k"], (None, None))
        if v0 is None or (v1 is None and b["part"] > 0):
            raise ArithmeticError(f"quantile rank of {b['field']} outside its bracket")
        result[b["field"]][b["i"]] = v0 + (v1 - v0) * b["part"] if b["part"] > 0 else v0
    return result


def _picked(numbers: DataFrame, brackets: list[dict]) -> dict[int, tuple]:
    """The values of each bracket's rank and the next, by ``k``."""
    counted = (
        _in_brackets(numbers, brackets, BINS)
        .selectExpr("k", "bin", "CASE WHEN bin >= 0 THEN value END AS value")
        .groupBy("k", "bin", "value")
        .agg(F.count("*").alias("hits"))
    )
    # The one or two bins per quantile that hold its neighbouring ranks.
    wanted = (
        counted.groupBy("k", "bin").agg(F.sum("hits").alias("n"))
        .selectExpr(
            "*", "sum(n) OVER (PARTITION BY k ORDER BY bin ROWS UNBOUNDED PRECEDING) AS upto",
            f"{_ranks(brackets)}[k] AS rank",
        )
        .filter(HOLDS)
        .selectExpr("k", "bin", "upto - n AS before", "rank")
    )
    picked = (
        counted.join(F.broadcast(wanted), ["k", "bin"])
        .selectExpr(
            "k", "value", "hits", "rank",
            "before + sum(hits) OVER (PARTITION BY k, bin ORDER BY value ROWS UNBOUNDED PRECEDING) AS upto",
        )
        .groupBy("k")
        .agg(
            F.expr("max(CASE WHEN rank >= upto - hits AND rank < upto THEN value END) AS v0"),
            F.expr("max(CASE WHEN rank + 1 >= upto - hits AND rank + 1 < upto THEN value END) AS v1"),
        )
    )
    return {row["k"]: (row["v0"], row["v1"]) for row in picked.collect()}


def approx_quantiles(df: DataFrame, cols: list[str], probs: list[float], err: float = 0.01) -> DataFrame:
    """``(field, n, quantiles)`` within ``err`` of the wanted rank, one pass."""
    grid = f"array({', '.join(f'{float(p)!r}D' for p in probs)})"
    facts = [
        f"named_struct('field', {_quoted(c)}, 'n', count(`{c}`), "
        f"'quantiles', percentile_approx(`{c}`, {grid}, {math.ceil(1 / err)}))"
        for c in cols
    ]
    return _numbers(df, cols).selectExpr(f"array({', '.join(facts)}) AS facts").select(F.inline("facts"))


def fences(quartiles: DataFrame) -> DataFrame:
    """``(field, n, q1, med, q3, iqr, lo, hi)`` from quantiles .25, .5, .75."""
    return quartiles.selectExpr(
        "field", "n", "quantiles[0] AS q1", "quantiles[1] AS med", "quantiles[2] AS q3",
        "quantiles[2] - quantiles[0] AS iqr",
        f"quantiles[0] - {FENCE}D * (quantiles[2] - quantiles[0]) AS lo",
        f"quantiles[2] + {FENCE}D * (quantiles[2] - quantiles[0]) AS hi",
    )


def _box(df: DataFrame, cols: list[str]) -> dict[str, tuple]:
    """Exact ``(q1, med, q3, iqr, lo, hi)`` per column."""
    box = {}
    for c, (q1, med, q3) in exact_quantiles(df, cols, [0.25, 0.5, 0.75]).items():
        if q1 is None:
            box[c] = (None,) * 6
        else:
            box[c] = (q1, med, q3, q3 - q1, q1 - FENCE * (q3 - q1), q3 + FENCE * (q3 - q1))
    return box


def iqr_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact quartiles, fences, outlier count and rate, whiskers per column.

    Whiskers are the outermost values inside the fences.
    """
    facts = []
    for c, numbers in _box(df, cols).items():
        q1, med, q3, iqr, lo, hi = map(_literal, numbers)
        outside = f"(`{c}` < {lo} OR `{c}` > {hi})"
        inside = f"CASE WHEN `{c}` >= {lo} AND `{c}` <= {hi} THEN `{c}` END"
        shown = {"q1": q1, "med": med, "q3": q3, "iqr": iqr, "lo": lo, "hi": hi,
                 "lo_whisker": f"min({inside})", "hi_whisker": f"max({inside})"}
        facts.append(
            f"named_struct('field', {_quoted(c)}, "
            + ", ".join(f"'{name}', round({value}, 2)" for name, value in shown.items())
            + f", 'n', count(`{c}`), 'n_out', count_if({outside}), "
            f"'rate', round(try_divide(count_if({outside}), count(*)) * 100, 2))"
        )
    return _numbers(df, cols).selectExpr(f"array({', '.join(facts)}) AS facts").select(F.inline("facts"))


def cap_outliers(df: DataFrame, cols: list[str], suffix: str = "_capped") -> DataFrame:
    """Clip each column to its exact fences into ``<col>_capped``.

    The fences are constants by then, so the rows are neither joined nor moved.
    """
    capped = []
    for c, (*_, lo, hi) in _box(df, cols).items():
        value = f"CAST(`{c}` AS DOUBLE)"
        clipped = value if lo is None else f"greatest(least({value}, {_literal(hi)}), {_literal(lo)})"
        capped.append(f"CASE WHEN `{c}` IS NOT NULL THEN {clipped} END AS `{c}{suffix}`")
    return df.selectExpr("*", *capped)


def outlier_rates(df: DataFrame, cols: list[str], err: float = 0.01) -> DataFrame:
    """``(field, rate)`` in percent of all rows, fences from approximate
    quartiles; a column with no spread has rate 0, a table without rows null
    rates. The fences reach the second pass as one scalar."""
    box = fences(approx_quantiles(df, cols, [0.25, 0.5, 0.75], err))
    limits = box.select(F.map_from_entries(F.collect_list(F.struct("field", F.struct("iqr", "lo", "hi"))))).scalar()
    facts = []
    for c in cols:
        own = f"_box[{_quoted(c)}]"
        outside = f"{own}.iqr <> 0 AND (`{c}` < {own}.lo OR `{c}` > {own}.hi)"
        facts.append(f"named_struct('field', {_quoted(c)}, 'rate', round(try_divide(count_if({outside}), count(*)) * 100, 4))")
    numbers = _numbers(df, cols).withColumn("_box", limits)
    return numbers.selectExpr(f"array({', '.join(facts)}) AS facts").select(F.inline("facts"))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column."""
    facts = []
    for c, quartiles in exact_quantiles(df, cols, [0.25, 0.5, 0.75]).items():
        q25, q50, q75 = map(_literal, quartiles)
        shown = {
            "mean": f"avg(`{c}`)", "std": f"stddev_samp(`{c}`)", "min": f"min(`{c}`)",
            "q25": q25, "q50": q50, "q75": q75, "max": f"max(`{c}`)",
        }
        facts.append(
            f"named_struct('field', {_quoted(c)}, 'count', count(`{c}`), "
            + ", ".join(f"'{name}', round({value}, 4)" for name, value in shown.items()) + ")"
        )
    return _numbers(df, cols).selectExpr(f"array({', '.join(facts)}) AS facts").select(F.inline("facts"))

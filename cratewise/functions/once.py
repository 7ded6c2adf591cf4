"""Columns that must not be computed more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    The optimizer copies a column's expression into every filter and
    projection above it, which multiplies long regular-expression chains. A
    one-row ``inline`` is a step it does not copy expressions across.
    """
    row = F.struct(*[value.alias(name) for name, value in cols.items()])
    return df.select("*", F.inline(F.array(row)))

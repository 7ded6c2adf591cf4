"""Every operator as a query over the given tables, with its SQL twin."""

from cratewise.registry import analytics, comments, history, quality, streams, tables, text, views  # noqa: F401
from cratewise.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

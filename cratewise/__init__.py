"""Popularity snapshots and community comments, cleaned and measured on Spark."""

__version__ = "0.1.0"

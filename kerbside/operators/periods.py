"""Trailing periods and ordered output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trailing_period(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days, counted back from the latest time in ``df``; the limit itself is included.

    The latest time is a scalar subquery: no join, and the limit reaches the scan as a value.
    """
    latest = df.agg(F.max(ts)).scalar()
    return df.filter(F.col(ts) >= latest - F.expr(f"interval {int(days)} days"))


def ordered(df: DataFrame, *order: Column, limit: int | None = None) -> DataFrame:
    """Sort for presentation; with ``limit`` Spark keeps only the top rows of each partition."""
    out = df.orderBy(*order)
    return out if limit is None else out.limit(limit)

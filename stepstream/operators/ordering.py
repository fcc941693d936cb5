"""Ordered and limited results. ``orderBy`` with ``limit`` keeps k rows per task; nothing is sorted whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_n(df: DataFrame, ts: str, tiebreak: Sequence[str], n: int) -> DataFrame:
    """The ``n`` newest rows, newest first."""
    return df.orderBy(F.desc(ts), *[F.desc(c) for c in tiebreak]).limit(n)


def top_counts(counts: DataFrame, n: int, count: str = "cnt", key: str = "value") -> DataFrame:
    """The ``n`` greatest counts; equal counts in order of the key."""
    return counts.orderBy(F.desc(count), F.asc(key)).limit(n)


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    """Up to ``n`` rows for a look; which ones is determined only with ``order_by``."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)

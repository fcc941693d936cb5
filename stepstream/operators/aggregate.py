"""Aggregations. Each one combines map-side first, so a hot key or window costs one
partial row per task in the shuffle, however many rows it holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepstream.functions.projections import words
from stepstream.functions.time import instant, is_wall_clock, wall_clock


def window_count(
    df: DataFrame, ts: str, duration: str, watermark: str | None = None, name: str = "total"
) -> DataFrame:
    """Row count per tumbling window, as ``window STRUCT<start, end>`` and ``total``.

    With ``watermark`` the window bounds are TIMESTAMP, as a watermark needs it;
    :func:`window_bounds` gives them back as wall-clock time.
    """
    if watermark is not None:
        df = df.select(instant(df, ts).alias(ts)).withWatermark(ts, watermark)
    return df.groupBy(F.window(ts, duration).alias("window")).agg(F.count("*").alias(name))


def window_bounds(counts: DataFrame, name: str = "total") -> DataFrame:
    """``window_start, window_end`` as wall-clock time, and the count."""
    start, end = F.col("window.start"), F.col("window.end")
    bounds = counts.select(start.alias("window_start"), end.alias("window_end"), name)
    if is_wall_clock(bounds, "window_start"):
        return bounds
    return bounds.select(
        wall_clock(F.col("window_start")).alias("window_start"),
        wall_clock(F.col("window_end")).alias("window_end"),
        name,
    )


def open_window_counts(state: DataFrame, name: str = "total") -> DataFrame:
    """The windows that a stream of :func:`window_count` still holds open, from its state; see ``StepHandle.finish``."""
    return state.select("key.window", F.col("value.count").alias(name))


def count_by(df: DataFrame, *keys: str, name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def word_count(df: DataFrame, text: str, drop_empty: bool = True) -> DataFrame:
    """Lower-cased words and their counts, as ``value, cnt``."""
    lowered = df.select(F.lower(text).alias("text"))
    return count_by(words(lowered, "text", "value", drop_empty), "value")


def keyed_sum(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(value))


def total(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Sum of a column as one row; NULL for empty input."""
    return df.agg(F.sum(column).alias(name or column))


def argmax(df: DataFrame, by: str, tiebreak: Sequence[str]) -> DataFrame:
    """The whole row with the greatest ``by``; ``tiebreak`` columns make it unique.

    NULL counts as smallest. Empty input gives no row.
    """
    best = df.agg(_greatest_row(by, tiebreak))
    return best.where(F.col("row").isNotNull()).select("row.*")


def latest(df: DataFrame, ts: str, tiebreak: Sequence[str]) -> DataFrame:
    """The latest row, without a sort."""
    return argmax(df, ts, tiebreak)


def latest_by_key(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str]
) -> DataFrame:
    """The latest row of each key. On a stream use ``update`` mode with an upsert, or ``complete``.

    Without ``keys`` it is the latest of all, and empty input gives no row.
    """
    best = df.groupBy(*keys).agg(_greatest_row(ts, tiebreak))
    return best.where(F.col("row").isNotNull()).select("row.*")


def _greatest_row(by: str, tiebreak: Sequence[str]):
    if not tiebreak:
        raise ValueError("without a tie-break column the greatest row is not determined")
    return F.max_by(F.struct("*"), F.struct(by, *tiebreak)).alias("row")

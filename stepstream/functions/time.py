"""Epoch values of timestamp columns that do not depend on the session time zone.

A TIMESTAMP_NTZ column is read as UTC wall-clock time. A cast to TIMESTAMP does
that only in a UTC session, where it is the fastest way; in other zones it would
shift the time, so its distance from the epoch is taken as an interval instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"
_UTC = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}


def is_wall_clock(df: DataFrame, ts: str) -> bool:
    return isinstance(df.schema[ts].dataType, T.TimestampNTZType)


def instant(df: DataFrame, ts: str) -> Column:
    """TIMESTAMP, which watermarks and epoch functions need."""
    if not is_wall_clock(df, ts):
        return F.col(ts)
    if df.sparkSession.conf.get("spark.sql.session.timeZone") in _UTC:
        return F.col(ts).cast("timestamp")
    since = F.col(ts) - F.expr(_EPOCH_NTZ)
    return F.timestamp_seconds(since.cast("interval second").cast("decimal(18,6)"))


def wall_clock(column: Column) -> Column:
    """TIMESTAMP to its UTC wall-clock time, the inverse of :func:`instant`."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(column), F.expr(_EPOCH_NTZ))


def duration_micros(duration: str) -> Column:
    """The length of a duration such as ``5 seconds`` or ``3 days``."""
    epoch = F.expr(_EPOCH_NTZ)
    return F.timestamp_diff("MICROSECOND", epoch, epoch + F.lit(duration).cast("interval"))


def epoch_micros(df: DataFrame, ts: str) -> Column:
    return F.unix_micros(instant(df, ts))


def epoch_millis(df: DataFrame, ts: str) -> Column:
    """Whole milliseconds, rounded down."""
    return F.unix_millis(instant(df, ts))


def epoch_seconds(df: DataFrame, ts: str) -> Column:
    """Whole seconds as INT, rounded down; an instant after 2038 overflows INT and raises."""
    return F.unix_seconds(instant(df, ts)).cast("int")

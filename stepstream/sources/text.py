"""Text lines as a stream with one column, ``value STRING``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def text_stream(spark: SparkSession, kind: str = "text", **options) -> DataFrame:
    """Lines from files (``kind="text"``, ``path=...``) or a socket (``kind="socket"``, ``host``, ``port``).

    A socket cannot be replayed after a failure and is read by one task; use
    files for anything that must be complete or large.
    """
    required = {"text": {"path"}, "socket": {"host", "port"}}
    if kind not in required:
        raise ValueError(f"kind must be 'text' or 'socket', not {kind!r}")
    missing = sorted(required[kind] - options.keys())
    if missing:
        raise ValueError(f"missing options for a {kind} stream: {', '.join(missing)}")
    return spark.readStream.format(kind).options(**options).load()

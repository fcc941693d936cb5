"""Row-to-row and row-to-rows functions. All work alike on batch and streaming input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepstream.schema import MAP_COLUMN, StepSchema, convert


def to_map_rows(df: DataFrame, names: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns to one ``MAP<STRING, STRING>`` column, keyed by column name."""
    names = list(df.columns if names is None else names)
    pairs = [part for n in names for part in (F.lit(n), F.col(n).cast("string"))]
    return df.select(*keep, F.create_map(*pairs).alias(MAP_COLUMN))


def typed_projection(
    df: DataFrame, schema: StepSchema, mode: str = "permissive", keep: Sequence[str] = ()
) -> DataFrame:
    """String-map rows to typed columns in declared order.

    A missing key, and in ``permissive`` mode a value that does not parse, gives NULL.
    """
    columns = [
        convert(F.col(MAP_COLUMN)[n], t, mode).alias(n) for n, t in zip(schema.names, schema.types)
    ]
    return df.select(*keep, *columns)


def with_arrival_time(df: DataFrame, name: str = "Now") -> DataFrame:
    """Add the arrival clock. It is one value per query or micro-batch, so order by it with a tie-break."""
    return df.withColumn(name, F.current_timestamp())


def words(df: DataFrame, text: str, name: str = "value", drop_empty: bool = True) -> DataFrame:
    r"""One row per word, splitting on ``\s+``.

    ``drop_empty=False`` keeps the empty word in front of leading white space and
    that of an empty line; the one behind trailing white space never counts.
    """
    line = F.col(text)
    if drop_empty:
        return df.select(F.explode(F.split(line, r"\s+")).alias(name)).where(F.col(name) != "")
    trimmed = F.regexp_replace(line, r"\s+$", "")
    blank = (trimmed == "") & (line != "")
    parts = F.when(~blank, F.split(trimmed, r"\s+"))
    return df.select(F.explode(parts).alias(name))


def squared_pairs(df: DataFrame, number: str, key: str = "k", n: str = "n") -> DataFrame:
    """``x -> (x * x, 1)``, squared as BIGINT so that no INT overflows."""
    x = F.col(number).cast("bigint")
    return df.select((x * x).alias(key), F.lit(1).alias(n))

"""The value of the row before, per key or over a whole table, with no group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepstream.functions.time import epoch_micros

_POINT, _SLICE, _VALUE, _CUTS = "_point", "_slice", "_value", "_cuts"
_BEFORE, _CARRY = "_before", "_carry"
_LOOKED_AT = 10  # rows looked at for each cut, which evens out the sizes of the slices
_SEED = 42
_PER_PARTITION = 4  # slices for each shuffle partition, which evens out the partitions
_INSTANTS = (T.TimestampType, T.TimestampNTZType)


def previous_value(
    df: DataFrame,
    value: Column,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    default=0,
    name: str = "previous",
    slices: int | None = None,
) -> DataFrame:
    """Add ``value`` of the row before in order of ``order_by``, or ``default`` for the first row.

    ``order_by`` must put the rows of a key in a total order. The table is cut into
    ``slices`` in order of ``(keys, order_by)``, so one key, or a table without
    keys, is spread over many tasks, and each row goes through one shuffle. A cut is
    the last row of its slice; the row that follows it takes its value from there.
    Any rows would do as cuts and give the same result; random ones make slices of
    about equal size. There are at most ``slices`` cuts, whatever the table's size.

    ``df`` is read more than once, so it must give the same rows each time: a
    table, or the rows of a micro-batch. ``value`` is a number or text.
    """
    if not order_by:
        raise ValueError("order_by must name at least one column")
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = slices or partitions * _PER_PARTITION
    fields = [*keys, *order_by]
    point = F.struct(*[_sortable(df, c).alias(f"c{i}") for i, c in enumerate(fields)])
    pointed = df.withColumns({_POINT: point, _VALUE: value})
    if isinstance(pointed.schema[_VALUE].dataType, _INSTANTS):
        raise TypeError("take the epoch value of a timestamp, e.g. epoch_millis(df, ts)")

    cuts = _cuts(pointed.select(F.struct(_POINT, _VALUE).alias("cut")), slices)
    sliced = _number_slices(pointed.withColumn(_CUTS, cuts), slices)
    carried = F.get(F.col(_CUTS), F.col(_SLICE) - 1)
    same_key = F.lit(True)
    for i in range(len(keys)):
        same_key &= carried[_POINT][f"c{i}"].eqNullSafe(F.col(_POINT)[f"c{i}"])
    # What a slice is handed by its cut, worked out here, so the cuts stay out of the shuffle.
    handed = F.when(carried.isNotNull() & same_key, F.struct(carried[_VALUE].alias(_VALUE)))
    sliced = sliced.select(*df.columns, _SLICE, _VALUE, handed.alias(_CARRY))
    in_slice = Window.partitionBy(*keys, _SLICE).orderBy(*order_by)
    before = F.coalesce(F.lag(F.struct(_VALUE)).over(in_slice), _CARRY)
    result = F.when(F.col(_BEFORE).isNotNull(), F.col(_BEFORE)[_VALUE]).otherwise(F.lit(default))
    return sliced.withColumn(_BEFORE, before).select(*df.columns, result.alias(name))


def _cuts(candidates: DataFrame, slices: int) -> Column:
    """Sorted array of at most ``slices`` rows that cut the table, as a scalar subquery.

    One pass draws the rows. The subquery keeps the cuts out of the text of the plan,
    which names them at every halving.
    """
    spark, kind = candidates.sparkSession, T.ArrayType(candidates.schema["cut"].dataType)
    drawn = candidates.orderBy(F.rand(_SEED)).limit(slices * _LOOKED_AT)
    looked_at = drawn.agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    turn = lambda i: F.floor(i * F.lit(slices) / F.greatest(F.size("cuts"), F.lit(1)))
    evenly = F.filter("cuts", lambda _, i: turn(i + 1) > turn(i))
    found = looked_at.select(F.to_json(evenly)).first()[0]
    return spark.createDataFrame([(found,)], "cuts string").select(F.from_json("cuts", kind)).scalar()


def _number_slices(df: DataFrame, slices: int) -> DataFrame:
    """Add how many cuts lie before the row, by a binary search with a projection for each halving.

    They stay in code generation, which a higher-order function over the cuts would leave.
    """
    df = df.withColumn(_SLICE, F.lit(0))
    for i in reversed(range(slices.bit_length())):
        tried = F.col(_SLICE) + (1 << i)
        passed = F.get(F.col(_CUTS), tried - 1)[_POINT] < F.col(_POINT)
        df = df.withColumn(_SLICE, F.when(passed, tried).otherwise(F.col(_SLICE)))
    return df


def _sortable(df: DataFrame, column: str) -> Column:
    """A column in a form that keeps its order and survives JSON unchanged."""
    if isinstance(df.schema[column].dataType, _INSTANTS):
        return epoch_micros(df, column)
    return F.col(column)

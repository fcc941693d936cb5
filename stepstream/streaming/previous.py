"""The value of the row before, carried from one micro-batch to the next.

:func:`previous_in_state` keeps what it carries in Spark's state store, so a batch costs its own keys. A key's rows of
one batch are put in order by one task. :class:`PreviousSink` spreads them over many, for keys that fill a batch and for tables
without keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepstream.operators.aggregate import latest_by_key
from stepstream.operators.previous import _sortable, previous_value
from stepstream.streaming.sinks import BATCH_ID, NTZ_MICROS, TIMESTAMP_MICROS, Sink, _read_parts, _sized
from stepstream.workspace import committed_parts, remove

_CARRIED, _VALUE = "_carried", "_value"
_FOLD = 16  # batches after which the state is written whole
_AS_TEXT = {**NTZ_MICROS, **TIMESTAMP_MICROS}


def previous_in_state(
    df: DataFrame, value: Column, order_by: Sequence[str], keys: Sequence[str], default=0, name: str = "previous"
) -> DataFrame:
    """Add to each row of a stream the ``value`` of the row before of its key, or ``default`` for the first row.

    For ``append`` mode. Rows of a key must arrive in order of ``order_by`` from batch to batch; inside a batch they may be in any
    order. For each key the state has order and value of the last row. One task takes the rows of a key in a
    batch and holds them in memory. ``order_by`` puts the rows of a key in a total order, NULL first; its columns and ``value`` are numbers, text
    or, in ``order_by``, instants. A NULL key is a key.
    """
    if not keys or not order_by:
        raise ValueError("keys and order_by must name at least one column each")
    valued = df.withColumn(_VALUE, value)
    kinds = {f"k{i}": F.col(c) for i, c in enumerate(keys)}
    carried = []  # a NULL would turn numbers into floats in Python, so each column goes with a mark
    for i, column in enumerate([*[_sortable(df, c) for c in order_by], F.col(_VALUE)]):
        kind = valued.select(column).schema[0].dataType
        nothing = F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)
        kinds |= {f"has{i}": column.isNotNull(), f"o{i}": F.coalesce(column, nothing)}
        carried += [f"has{i}", f"o{i}"]
    kinds["row"] = F.to_json(F.struct(*df.columns), _AS_TEXT)
    narrow = valued.select(*[column.alias(c) for c, column in kinds.items()])
    state = T.StructType([narrow.schema[c] for c in carried])
    out = T.StructType([narrow.schema["row"], T.StructField("first", T.BooleanType()), *state.fields[-2:]])
    by_key = narrow.groupBy(*[f"k{i}" for i in range(len(keys))])
    found = by_key.applyInPandasWithState(_in_order(carried), out, state, "append", "NoTimeout")
    had, before = carried[-2:]
    earlier = F.when(F.col("first"), F.lit(default)).when(F.col(had), F.col(before))
    row = F.from_json("row", df.schema, _AS_TEXT).alias("row")
    return found.select(row, earlier.alias("before")).select(*[F.col("row")[c].alias(c) for c in df.columns], F.col("before").alias(name))


def _in_order(carried: Sequence[str]):
    """A function over one key's rows of a batch and its state."""

    had, value = carried[-2:]

    def step(key, batches, state):
        # Arrays, as frames cost milliseconds for each key.
        parts = list(batches)
        rows = {name: np.concatenate([part[name].to_numpy() for part in parts]) for name in [*carried, "row"]}
        known = int(state.exists)
        if known:  # the last row of the batches before stands first
            for name, last in zip([*carried, "row"], [*state.get, None]):
                rows[name] = np.concatenate([np.array([last], dtype=rows[name].dtype), rows[name]])
        by = np.lexsort([rows[name] for name in reversed(carried[:-2])])
        state.update(tuple(x.item() if hasattr(x, "item") else x for x in (rows[name][by[-1]] for name in carried)))
        new = by >= known
        before = np.append(by[:1], by[:-1])[new]
        first = np.flatnonzero(new) == 0
        yield pd.DataFrame({"row": rows["row"][by[new]], "first": first, had: rows[had][before], value: rows[value][before]})

    return step


class PreviousSink(Sink):
    """Adds to each row the ``value`` of the row before of its key, over the whole stream.

    Between batches it keeps order and value of the last row of each key. In a batch
    those of its keys join the new rows and the batch operator does the rest, so a key that
    fills a batch is still spread over many tasks. Rows of a key must arrive in
    order of ``order_by`` from batch to batch; inside a batch they may be in any order.

    The state is a log: a batch writes the keys that it changed, and every 16th
    batch all of them; older parts are then removed. A batch reads at most that many parts, and of them its own keys only.
    """

    leased = True

    def __init__(
        self,
        path: str,
        schema: T.StructType,
        value: Callable[[DataFrame], Column],
        order_by: Sequence[str],
        keys: Sequence[str],
        default=0,
        name: str = "previous",
    ):
        self.path = path
        self.schema = schema
        self.value = value
        self.order_by = list(order_by)
        self.keys = list(keys)
        self.default = default
        self.name = name

    def attach(self, writer):
        return writer.foreachBatch(self._fenced(self._write))

    def _valued(self, rows):
        return rows.withColumn(_VALUE, self.value(rows))

    def _write(self, batch, batch_id):
        rows = self._valued(batch).persist()
        try:
            log = self._log(rows, batch_id)
            carried = self._last(log if not self.keys else self._of_keys(log, rows))
            both = rows.withColumn(_CARRIED, F.lit(False)).unionByName(
                carried.withColumn(_CARRIED, F.lit(True)), allowMissingColumns=True
            )
            result = previous_value(
                both, F.col(_VALUE), self.order_by, self.keys, self.default, self.name
            )
            out = f"{self.path}/rows/{BATCH_ID}={batch_id}"
            result = result.where(~F.col(_CARRIED)).drop(_CARRIED, _VALUE)
            result.write.mode("overwrite").parquet(out)
            last = rows.select(*log.columns)
            if batch_id % _FOLD == 0:
                last = last.unionByName(log)
            _sized(self._last(last)).write.mode("overwrite").parquet(f"{self.path}/state/{BATCH_ID}={batch_id}")
        finally:
            rows.unpersist()

    def _last(self, log):
        first, *rest = self.order_by
        return latest_by_key(log, self.keys, first, rest or [first])

    def _log(self, rows, batch_id):
        """The last rows of keys in the batches before, from the last that has all of them. What is older is removed."""
        spark, path = rows.sparkSession, f"{self.path}/state"
        names = [*self.keys, *[c for c in self.order_by if c not in self.keys], _VALUE]
        schema = rows.select(*names).schema
        whole = (batch_id - 1) // _FOLD * _FOLD
        parts = committed_parts(spark, path, BATCH_ID)
        for old in parts:
            if old < whole:  # a replay of this batch, or of the next ones, does not ask for it
                remove(spark, f"{path}/{BATCH_ID}={old}")
        return _read_parts(spark, path, schema, [i for i in parts if whole <= i < batch_id]).drop(BATCH_ID)

    def _of_keys(self, state, rows):
        """Those of the log whose key the batch has; structs compare with NULL equal to NULL."""
        key = F.struct(*self.keys).alias("_key")
        present = rows.select(key).distinct()
        return state.withColumn("_key", key).join(present, "_key", "left_semi").drop("_key")

    def version(self, spark):
        return [f"{BATCH_ID}={i}" for i in committed_parts(spark, f"{self.path}/rows", BATCH_ID)]

    def table(self, spark, version=None):
        empty = self._valued(spark.createDataFrame([], self.schema))
        value = F.when(F.lit(True), F.col(_VALUE)).otherwise(F.lit(self.default))
        schema = empty.select(*self.schema.names, value.alias(self.name)).schema
        parts = self.version(spark) if version is None else version
        return _read_parts(spark, f"{self.path}/rows", schema, [int(part.split("=")[1]) for part in parts]).drop(BATCH_ID)

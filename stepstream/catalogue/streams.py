"""Streaming queries: tables arrive in batches, and the result table is returned.

The batches of a query take in its whole table. They land and run one by one, so
what counts as late is the same at any size and on any number of executors.
"""

from __future__ import annotations

import time
from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepstream.catalogue.batch import EVENT_ROW, double_twice
from stepstream.functions import (
    epoch_micros,
    epoch_millis,
    squared_pairs,
    to_map_rows,
    typed_projection,
    with_arrival_time,
)
from stepstream.operators import (
    keyed_sum,
    latest_by_key,
    open_window_counts,
    preview,
    top_counts,
    window_bounds,
    window_count,
    word_count,
)
from stepstream.sources import BatchQueue, RowLanding, read_table, table_stream
from stepstream.streaming import (
    BatchSink,
    CompleteSink,
    FileSink,
    LateRowsSink,
    PreviousSink,
    UpsertSink,
    run_step,
)
from stepstream.streaming.handle import AVAILABLE_NOW, ROCKSDB_STATE
from stepstream.workspace import new_dir, remove

SPANS = 4
_BATCH = "_batch"


def in_batches(batches, step, make_sink, mode="append", landed_as="parquet", conf=None, last=None):
    """Feed ``batches`` one by one through ``step`` into a sink and return the handles of the runs.

    With ``last``, the table is finished by it. ``make_sink`` gets a path and the schema of the step's result. What the batches were stored in,
    landing and checkpoint are removed at the end; the result belongs to the caller.
    """
    spark = batches[0].sparkSession
    schema = T.StructType(batches[0].schema.fields[:1]) if landed_as == "text" else batches[0].schema
    landing = RowLanding(spark, new_dir(spark, "landing"), schema, landed_as)
    queue = BatchQueue(landing)
    for batch in batches:
        queue.put(batch)
    stepped = step(landing.stream())
    sink = make_sink(new_dir(spark, "result"), stepped.schema)
    try:
        runs = queue.drain(lambda: run_through(stepped, sink, mode, conf))
        if last is not None:
            runs[-1].finish(last)
        return runs
    finally:
        _clear(batches, landing, sink)


def run_through(stepped, sink, mode="append", conf=None, checkpoint=None):
    """Run a step on all rows that are there, and return its handle once it has ended."""
    handle = run_step(stepped, f"step-{uuid4().hex}", sink, mode, AVAILABLE_NOW, checkpoint, conf)
    try:
        handle.wait()
    finally:
        handle.stop()
    return handle


def _clear(batches, landing, sink):
    for path in (getattr(batches, "path", None), landing.path, landing.staged, landing.landed, sink.checkpoint):
        if path:
            remove(landing.spark, path)


class Batches(list):
    """A table split by ``number``, 0 to ``count`` - 1, and stored so in one pass over it."""

    def __init__(self, df, number, count):
        spark = df.sparkSession
        self.path = new_dir(spark, "batches")
        df.withColumn(_BATCH, number.cast("int")).write.partitionBy(_BATCH).parquet(self.path)
        schema = T.StructType([*df.schema.fields, T.StructField(_BATCH, T.IntegerType())])
        stored = spark.read.schema(schema).parquet(self.path)
        super().__init__(stored.where(F.col(_BATCH) == i).drop(_BATCH) for i in range(count))


def _bounds(events):
    """Starts of all spans but the first: four equal parts of the time that the events cover."""
    ends = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    low, high = ends.select(epoch_micros(ends, "low"), epoch_micros(ends, "high")).first()
    if low is None:
        return []
    epoch = "timestamp_ntz'1970-01-01 00:00:00'"
    starts = [low + (high - low) * i // SPANS for i in range(1, SPANS)]
    return [F.expr(f"timestampadd(MICROSECOND, {start}L, {epoch})") for start in starts]


def _span_of(events):
    number = F.lit(0)
    for i, start in enumerate(_bounds(events), 1):
        number = F.when(F.col("ts") >= start, i).otherwise(number)
    return number


def _spans(events):
    """One batch per span; events without a time come with the first."""
    return Batches(events, _span_of(events), SPANS)


def _spans_with_delay(events):
    """As :func:`_spans`, but each error event arrives with the span after its own."""
    late = F.coalesce(F.col("event_type") == "error", F.lit(False)).cast("int")
    return Batches(events, _span_of(events) + late, SPANS + 1)


def append_rows(spark, folder):
    """Events as string maps, span by span; then the default row, and one with values of its own."""
    batches = _spans(read_table(spark, folder, "events"))
    landing = RowLanding(spark, new_dir(spark, "landing"), EVENT_ROW)
    stepped = typed_projection(landing.stream(), EVENT_ROW)
    sink = FileSink(new_dir(spark, "result"), stepped.schema)
    for part in batches:
        landing.add_rows(to_map_rows(part))
        run_through(stepped, sink)
    landing.add_row()
    landing.add_row(["-2", "2024-01-01 00:00:00", "0", "end", None, "{}"])
    table = run_through(stepped, sink).table()
    _clear(batches, landing, sink)
    return table


def land_once(spark, folder):
    """Each span is added twice under its key, as a caller does that does not know whether the first call ended."""
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts")
    batches = _spans(events)
    landing = RowLanding(spark, new_dir(spark, "landing"), events.schema)
    sink = FileSink(new_dir(spark, "result"), events.schema)
    for i, part in enumerate(batches):
        for _ in range(2):
            landing.add_rows(part, key=f"span-{i}")
            run_through(landing.stream(), sink)
    _clear(batches, landing, sink)
    return sink.table(spark)


def restart(spark, folder):
    """The step stops after two spans. A new sink and stream on the same table take the other two, and no row twice."""
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts")
    batches = _spans(events)
    path = new_dir(spark, "result")
    landing = RowLanding(spark, new_dir(spark, "landing"), events.schema)
    for parts in (batches[:2], batches[2:]):
        for part in parts:
            landing.add_rows(part)
        run_through(landing.stream(), FileSink(path, events.schema))
    sink = FileSink(path, events.schema)
    _clear(batches, landing, sink)
    return sink.table(spark)


def step_chain(spark, folder):
    """Reads the table's own files as a stream, without landing them first."""
    stepped = table_stream(spark, folder, "lineitem").transform(double_twice)
    return run_through(stepped, FileSink(new_dir(spark, "result"), stepped.schema)).table()


def words(spark, folder):
    """Documents arrive as lines of text in four batches."""
    documents = read_table(spark, folder, "documents").select(F.col("text").alias("value"), "doc_id")
    runs = in_batches(
        Batches(documents, F.coalesce(F.pmod("doc_id", F.lit(4)), F.lit(0)), 4),
        lambda lines: word_count(lines, "value"),
        CompleteSink,
        "complete",
        landed_as="text",
        conf=ROCKSDB_STATE,
    )
    return runs[-1].table()


def top_words(spark, folder):
    """Reads the table's own files as a stream; only changed counts are written."""
    counts = word_count(table_stream(spark, folder, "documents"), "text")
    sink = UpsertSink(new_dir(spark, "result"), counts.schema, ["value"])
    return top_counts(run_through(counts, sink, "update", ROCKSDB_STATE).table(), 10)


def _windows(spark, folder, mode, make_sink, batches=_spans, watermark="5 seconds", last=None):
    events = read_table(spark, folder, "events").select("event_type", "ts")
    runs = in_batches(
        batches(events),
        lambda df: window_count(df, "ts", "1 hour", watermark),
        make_sink,
        mode,
        last=last,
    )
    return window_bounds(runs[-1].table())


def _upsert_windows(path, schema):
    return UpsertSink(path, schema, ["window"])


def windows_append(spark, folder):
    return _windows(spark, folder, "append", FileSink)


def windows_finished(spark, folder):
    """Also the windows that no later row has closed."""
    return _windows(spark, folder, "append", FileSink, last=open_window_counts)


def windows_update(spark, folder):
    return _windows(spark, folder, "update", _upsert_windows)


def windows_complete(spark, folder):
    return _windows(spark, folder, "complete", CompleteSink)


def late_append(spark, folder):
    return _windows(spark, folder, "append", FileSink, _spans_with_delay, "3 days")


def late_finished(spark, folder):
    """All windows, without the rows that came too late for theirs."""
    return _windows(spark, folder, "append", FileSink, _spans_with_delay, "3 days", open_window_counts)


def late_update(spark, folder):
    return _windows(spark, folder, "update", _upsert_windows, _spans_with_delay, "3 days")


def late_complete(spark, folder):
    return _windows(spark, folder, "complete", CompleteSink, _spans_with_delay, "3 days")


def late_table(spark, folder):
    """Every event with whether it came too late for its window, by the watermark that its batch met."""
    events = read_table(spark, folder, "events").select("event_id", "event_type", "ts")

    def make_sink(path, schema):
        return LateRowsSink(path, schema, "ts", "1 hour", "3 days")

    return in_batches(_spans_with_delay(events), lambda df: df, make_sink)[-1].table()


def windows_of_arrival(spark, folder):
    """Which window a row falls in depends on the clock; that it is one of 5 seconds around now, and counted once, does not."""
    events = read_table(spark, folder, "events").select("event_id", "ts")
    asked_at = time.time()
    runs = in_batches(
        _spans(events),
        lambda df: window_count(with_arrival_time(df), "Now", "5 seconds", "5 seconds"),
        _upsert_windows,
        "update",
    )
    start, end = F.unix_millis("window.start"), F.unix_millis("window.end")
    near = (start / 1e3 > F.lit(asked_at) - 60) & (end / 1e3 < F.lit(time.time()) + 60)
    return runs[-1].table().agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("sum_counts"),
        F.coalesce(F.min(end - start), F.lit(5000)).cast("bigint").alias("shortest_ms"),
        F.coalesce(F.max(end - start), F.lit(5000)).cast("bigint").alias("longest_ms"),
        F.coalesce(F.every(start % 5000 == 0), F.lit(True)).alias("aligned"),
        F.coalesce(F.every(near), F.lit(True)).alias("around_now"),
    )


def _per_order(spark, folder, step, schema):
    """Four batches by order key; ``step`` sees each batch alone."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    batches = Batches(lines, F.coalesce(F.pmod("l_orderkey", F.lit(4)), F.lit(0)), 4)

    def make_sink(path, _):
        return BatchSink(path, schema, step)

    return in_batches(batches, lambda df: df, make_sink)[-1].table()


def squares_per_batch(spark, folder):
    schema = T.StructType.fromDDL("k BIGINT, n BIGINT")
    return _per_order(
        spark, folder, lambda b: keyed_sum(squared_pairs(b, "l_linenumber"), "k", "n"), schema
    )


def preview_per_batch(spark, folder):
    schema = T.StructType.fromDDL("l_orderkey BIGINT, l_linenumber INT")
    order = ["l_orderkey", "l_linenumber"]
    return _per_order(spark, folder, lambda b: preview(b.select(*order), 10, order), schema)


def latest_per_key(spark, folder):
    runs = in_batches(
        _spans(read_table(spark, folder, "events")),
        lambda df: latest_by_key(df, ["user_id"], "ts", ["event_id"]),
        lambda path, schema: UpsertSink(path, schema, ["user_id"]),
        "update",
    )
    return runs[-1].table()


def previous_event(spark, folder):
    """The last row of each user is carried from span to span."""
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts")

    def make_sink(path, schema):
        return PreviousSink(path, schema, lambda df: epoch_millis(df, "ts"), ["ts", "event_id"], ["user_id"], name="last_ms")

    rows = in_batches(_spans(events), lambda df: df, make_sink)[-1].table()
    return rows.select("event_id", "user_id", epoch_millis(rows, "ts").alias("current_ms"), "last_ms")


def previous_event_global(spark, folder):
    """Without keys: each span is spread over many tasks."""
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts")

    def make_sink(path, schema):
        return PreviousSink(path, schema, lambda df: epoch_millis(df, "ts"), ["ts", "event_id"], [], name="last_ms")

    rows = in_batches(_spans(events), lambda df: df, make_sink)[-1].table()
    return rows.select("event_id", "user_id", epoch_millis(rows, "ts").alias("current_ms"), "last_ms")


def previous_amount(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts", "value")

    def make_sink(path, schema):
        return PreviousSink(path, schema, lambda df: F.col("value"), ["ts", "event_id"], ["user_id"], name="last_value")

    rows = in_batches(_spans(events), lambda df: df, make_sink)[-1].table()
    return rows.select("event_id", "user_id", "value", "last_value")


def progress(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "ts")
    runs = in_batches(_spans(events), lambda df: df, FileSink)
    return runs[-1].progress().where("num_input_rows > 0").select("batch_id", "num_input_rows")


def live_and_snapshot(spark, folder):
    """Count a live table and a snapshot of it, both taken after the first of two batches, after the second. The snapshot copies no rows."""
    events = read_table(spark, folder, "events").select("event_id", "ts")
    batches = _spans(events)
    landing = RowLanding(spark, new_dir(spark, "landing"), events.schema)
    sink = FileSink(new_dir(spark, "result"), events.schema)

    def run(parts):
        for part in parts:
            landing.add_rows(part)
        return run_through(landing.stream(), sink)

    handle = run(batches[:1])
    snapshot = handle.snapshot()
    run(batches[1:])
    _clear(batches, landing, sink)
    live = handle.table().agg(F.count("*").alias("n")).select(F.lit("live").alias("kind"), "n")
    return live.unionByName(
        snapshot.agg(F.count("*").alias("n")).select(F.lit("snapshot").alias("kind"), "n")
    )


STREAM_QUERIES = {
    "append_rows_stream": append_rows,
    "append_rows_once_stream": land_once,
    "restart_stream": restart,
    "step_chain_stream": step_chain,
    "word_count_stream": words,
    "top_words_stream": top_words,
    "window_count_stream_append": windows_append,
    "window_count_stream_finished": windows_finished,
    "window_count_stream_update": windows_update,
    "window_count_stream_complete": windows_complete,
    "window_count_arrival": windows_of_arrival,
    "late_rows_append": late_append,
    "late_rows_finished": late_finished,
    "late_rows_update": late_update,
    "late_rows_complete": late_complete,
    "late_rows_table": late_table,
    "keyed_sum_per_batch": squares_per_batch,
    "batch_preview": preview_per_batch,
    "latest_per_key_stream": latest_per_key,
    "previous_event_stream": previous_event,
    "previous_event_global_stream": previous_event_global,
    "previous_amount_stream": previous_amount,
    "stream_progress": progress,
    "live_vs_snapshot": live_and_snapshot,
}

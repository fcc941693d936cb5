import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepstream.catalogue.streams import STREAM_QUERIES, in_batches, run_through
from stepstream.functions import epoch_millis, squared_pairs, with_arrival_time
from stepstream.operators import (
    argmax,
    keyed_sum,
    latest_by_key,
    latest_n,
    preview,
    previous_value,
    total,
    window_bounds,
    window_count,
    word_count,
)
from stepstream.plans import chain, step_exprs
from stepstream.sources import RowLanding
from stepstream.streaming import (
    BatchSink,
    CompleteSink,
    ConsoleSink,
    FileSink,
    MemorySink,
    PreviousSink,
    UpsertSink,
    previous_in_state,
    read_json,
    run_step,
    write_json,
)
from stepstream.streaming.handle import AVAILABLE_NOW, ROCKSDB_STATE
from stepstream.workspace import new_dir

T0 = dt.datetime(2024, 1, 1)
CLOCK = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("now", T.TimestampNTZType())]
)
NUMBERS = T.StructType([T.StructField("n", T.LongType())])


def clock_batches(spark, batches):
    ids = iter(range(100))
    return [
        spark.createDataFrame([(next(ids), T0 + dt.timedelta(seconds=s)) for s in batch], CLOCK)
        for batch in batches
    ]


def by_key(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def upsert_windows(path, schema):
    return UpsertSink(path, schema, ["window"])


ROUNDS = [(0, 3), (3, 8), (8, 16)]
LATE = [[1, 2, 3], [4, 6, 16], [17], [2, 30]]


@pytest.mark.parametrize(
    "mode, make_sink, expected",
    [
        ("update", upsert_windows, {0: 4, 5: 1, 15: 2, 30: 1}),
        ("append", FileSink, {0: 4, 5: 1, 15: 2}),
        ("complete", CompleteSink, {0: 5, 5: 1, 15: 2, 30: 1}),
    ],
)
def test_late_rows(spark, zone, mode, make_sink, expected):
    runs = in_batches(
        clock_batches(spark, LATE),
        lambda df: window_count(df, "now", "5 seconds", "5 seconds"),
        make_sink,
        mode,
    )
    counts = window_bounds(runs[-1].table()).collect()
    assert {(r.window_start - T0).seconds: r.total for r in counts} == expected
    dropped = runs[-1].progress().agg(F.sum("late_groups_dropped")).first()[0]  # of all runs on the table
    assert dropped == (0 if mode == "complete" else 1)


def test_late_rows_in_one_run_of_many_batches(spark):
    """The same rows, but all landed before one run that takes a file per batch."""
    landing = RowLanding(spark, new_dir(spark, "landing"), CLOCK)
    for batch in clock_batches(spark, LATE):
        landing.add_rows(batch.coalesce(1))
    counts = window_count(landing.stream(files_per_batch=1), "now", "5 seconds", "5 seconds")
    sink = upsert_windows(new_dir(spark, "out"), counts.schema)
    rows = window_bounds(run_through(counts, sink, "update").table()).collect()
    assert {(r.window_start - T0).seconds: r.total for r in rows} == {0: 4, 5: 1, 15: 2, 30: 1}


def test_update_table_does_not_count_a_window_twice(spark):
    """An in-memory table in update mode holds every version of a window; the upserted one does not."""
    batches = clock_batches(spark, [[0, 1, 2], [3, 4, 5, 6, 7], [8, 9, 10, 11, 12, 13, 14]])
    runs = in_batches(
        batches,
        lambda df: window_count(df, "now", "5 seconds", "5 seconds"),
        upsert_windows,
        "update",
    )
    assert total(runs[-1].table(), "total").first()[0] == 15


def test_compaction_keeps_the_newest_versions(spark):
    landing = RowLanding(spark, new_dir(spark, "landing"), CLOCK)
    counts = window_count(landing.stream(), "now", "5 seconds", "1 hour")
    sink, checkpoint = upsert_windows(new_dir(spark, "log"), counts.schema), new_dir(spark, "check")
    batches = clock_batches(spark, [[1, 6], [2], [3, 7, 11]])
    for batch in batches[:2]:
        landing.add_rows(batch)
        run_through(counts, sink, "update", checkpoint=checkpoint)
    before = by_key(sink.table(spark))
    folded = sink.compact(spark, new_dir(spark, "folded"))
    assert by_key(folded.table(spark)) == before
    landing.add_rows(batches[2])
    run_through(counts, folded, "update", checkpoint=checkpoint)
    assert sorted(r.total for r in folded.table(spark).collect()) == [1, 2, 3]


def test_upsert_of_several_values(spark):
    schema = T.StructType.fromDDL("k STRING, a INT, b STRING")
    sink = UpsertSink(new_dir(spark, "log"), schema, ["k"])
    assert sink.table(spark).collect() == []
    sink.write_batch(spark.createDataFrame([("x", 1, "p"), ("y", 2, "q")], schema), 0)
    sink.write_batch(spark.createDataFrame([("x", 9, None)], schema), 1)
    sink.write_batch(spark.createDataFrame([("x", None, "r")], schema), 1)  # a replay
    assert by_key(sink.table(spark)) == [("x", None, "r"), ("y", 2, "q")]


def test_complete_sink_keeps_the_last_result_only(spark):
    lines = T.StructType.fromDDL("value STRING")
    batches = [spark.createDataFrame([(text,)], lines) for text in ("a b", "A", "c a")]
    runs = in_batches(
        batches,
        lambda df: word_count(df, "value"),
        CompleteSink,
        "complete",
        landed_as="text",
        conf=ROCKSDB_STATE,
    )
    assert by_key(runs[-1].table()) == [("a", 3), ("b", 1), ("c", 1)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != (
        ROCKSDB_STATE["spark.sql.streaming.stateStore.providerClass"]
    )
    assert CompleteSink(new_dir(spark, "none"), lines).table(spark).collect() == []


def test_streaming_order_needs_complete_mode(spark):
    landing = RowLanding(spark, new_dir(spark, "landing"), T.StructType.fromDDL("value STRING"), "text")
    counts = word_count(landing.stream(), "value").orderBy(F.desc("cnt"))
    with pytest.raises(AnalysisException):
        run_step(counts, "ordered", MemorySink(), "update")
    landing.add_rows([("b a b",)])
    handle = run_step(counts, "ordered", MemorySink(), "complete", AVAILABLE_NOW)
    handle.wait()
    assert [tuple(r) for r in handle.table().collect()] == [("b", 2), ("a", 1)]


def test_keyed_sum_starts_afresh_in_each_batch(spark):
    ints = T.StructType.fromDDL("x INT")
    batches = [spark.range(1, 1001, 1, 10).selectExpr("cast(id as int) x") for _ in range(2)]
    schema = T.StructType.fromDDL("k BIGINT, n BIGINT")

    def make_sink(path, _):
        return BatchSink(path, schema, lambda b: keyed_sum(squared_pairs(b, "x"), "k", "n"))

    assert batches[0].schema.names == ints.names
    table = in_batches(batches, lambda df: df, make_sink)[-1].table()
    checks = table.groupBy("batch_id").agg(F.count("*"), F.sum("n"), F.max("k")).collect()
    assert sorted(tuple(r) for r in checks) == [(0, 1000, 1000, 10**6), (1, 1000, 1000, 10**6)]


def test_preview_of_each_batch(spark):
    batches = [spark.range(lo, lo + 30).toDF("n") for lo in (0, 100)]

    def make_sink(path, schema):
        return BatchSink(path, schema, lambda b: preview(b, 10, ["n"]))

    table = in_batches(batches, lambda df: df, make_sink)[-1].table()
    assert by_key(table) == sorted(
        [(lo + i, b) for b, lo in enumerate((0, 100)) for i in range(10)], key=repr
    )


KEYED = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("id", T.IntegerType()),
    ]
)


def keyed_batches(spark):
    """Three batches in time order; one key fills a third of each, others come and go, one is NULL."""
    batches = []
    for b in range(3):
        rows = []
        for i in range(60):
            k = "hot" if i % 3 == 0 else [None, "a", f"only{b}"][i % 5 % 3]
            rows.append((k, T0 + dt.timedelta(seconds=b * 100 + i // 2), b * 100 + i))
        batches.append(spark.createDataFrame(rows, KEYED))
    return batches


def test_previous_value_on_a_stream_equals_batch(spark, zone):
    batches = keyed_batches(spark)

    def make_sink(path, schema):
        value = lambda df: epoch_millis(df, "ts")
        return PreviousSink(path, schema, value, ["ts", "id"], ["k"])

    table = in_batches(batches, lambda df: df, make_sink)[-1].table()
    whole = batches[0].union(batches[1]).union(batches[2])
    assert table.columns == [*KEYED.names, "previous"]
    assert by_key(table) == by_key(
        previous_value(whole, epoch_millis(whole, "ts"), ["ts", "id"], ["k"])
    )


def test_previous_value_in_state_equals_batch(spark, zone):
    batches = keyed_batches(spark)
    for value, default in ((lambda df: epoch_millis(df, "ts"), 0), (lambda df: F.when(F.col("id") % 7 > 0, F.col("id").cast("string")), "none")):
        step = lambda df: previous_in_state(df, value(df), ["ts", "id"], ["k"], default)  # noqa: B023, E731
        table = in_batches(batches, step, FileSink, conf=ROCKSDB_STATE)[-1].table()
        whole = batches[0].union(batches[1]).union(batches[2])
        assert table.columns == [*KEYED.names, "previous"]
        assert by_key(table) == by_key(previous_value(whole, value(whole), ["ts", "id"], ["k"], default))


def test_previous_value_in_state_keeps_every_value(spark):
    """Numbers beyond 2^53, NULLs, NaN and NULL in the order go through Python unchanged."""
    big, kind = 2**60 + 1, "k BIGINT, a BIGINT, b DOUBLE, s STRING, at TIMESTAMP"
    at = dt.datetime(2024, 5, 1, 1, 2, 3, 456789)
    rows = [[(big, None, 1.5, "x", at), (big, big, None, None, None)], [(big, big + 1, float("nan"), "", at), (None, 1, 0.1, "é\n", at)]]
    batches = [spark.createDataFrame(r, kind) for r in rows]
    for column in ("a", "s", "b"):
        table = in_batches(batches, lambda df: previous_in_state(df, F.col(column), ["a"], ["k"], None, "p"), FileSink)[-1].table()  # noqa: B023
        whole = batches[0].union(batches[1])
        expected = previous_value(whole, F.col(column), ["a"], ["k"], None, "p")
        assert repr(by_key(table)) == repr(by_key(expected))  # NaN is not equal to itself


def test_previous_sink_takes_a_replayed_batch(spark):
    batches = keyed_batches(spark)
    value = lambda df: F.col("id")
    sink = PreviousSink(new_dir(spark, "previous"), KEYED, value, ["ts", "id"], ["k"], default=-1)
    for batch_id, batch in [(0, 0), (1, 1), (1, 1), (2, 2), (2, 2)]:
        sink._write(batches[batch], batch_id)
    whole = batches[0].union(batches[1]).union(batches[2])
    expected = previous_value(whole, F.col("id"), ["ts", "id"], ["k"], default=-1)
    assert by_key(sink.table(spark)) == by_key(expected)


def test_latest_by_key_on_a_stream_equals_batch(spark):
    batches = keyed_batches(spark)
    whole = batches[0].union(batches[1]).union(batches[2])
    expected = by_key(latest_by_key(whole, ["k"], "ts", ["id"]))
    for mode, make_sink in [
        ("update", lambda path, schema: UpsertSink(path, schema, ["k"])),
        ("complete", CompleteSink),
    ]:
        runs = in_batches(
            batches, lambda df: latest_by_key(df, ["k"], "ts", ["id"]), make_sink, mode
        )
        assert by_key(runs[-1].table()) == expected


def test_split_into_batches_does_not_change_the_counts(spark, events):
    day = F.dayofmonth("ts")
    cuts = [[(0, 32)], [(0, 3), (3, 32)], [(0, 9), (9, 10), (10, 32)]]
    expected = by_key(window_bounds(window_count(events, "ts", "1 day")))
    for cut in cuts:
        runs = in_batches(
            [events.where((day >= lo) & (day < hi)) for lo, hi in cut],
            lambda df: window_count(df, "ts", "1 day", "1 second"),
            upsert_windows,
            "update",
        )
        assert by_key(window_bounds(runs[-1].table())) == expected


def test_restart_takes_only_new_rows(spark):
    landing = RowLanding(spark, new_dir(spark, "landing"), NUMBERS)
    sink, checkpoint = FileSink(new_dir(spark, "out"), NUMBERS), new_dir(spark, "check")
    for lo, count in ((0, 10), (10, 20)):
        landing.add_rows(spark.range(lo, lo + 10).toDF("n"))
        run_through(landing.stream(), sink, checkpoint=checkpoint)
        assert sink.table(spark).distinct().count() == sink.table(spark).count() == count


def test_live_table_and_snapshot(spark):
    landing = RowLanding(spark, new_dir(spark, "landing"), NUMBERS)
    handle = run_step(landing.stream(), "live", MemorySink())
    try:
        landing.add_row((1,))
        handle.process_all()
        snapshot = handle.snapshot()
        assert handle.table().collect() == snapshot.collect()
        landing.add_rows([(n,) for n in range(10)])
        handle.process_all()
        assert handle.table().count() == len(handle.table().collect()) == 11
        assert snapshot.count() == len(snapshot.collect()) == 1
    finally:
        handle.stop()


def test_snapshots_by_name_without_a_copy(spark):
    landing = RowLanding(spark, new_dir(spark, "landing"), NUMBERS)
    counts = landing.stream().groupBy((F.col("n") % 3).alias("k")).agg(F.count("*").alias("cnt"))
    makes = [
        (landing.stream(), lambda path, schema: FileSink(path, schema), "append"),
        (counts, lambda path, schema: UpsertSink(path, schema, ["k"]), "update"),
        (counts, CompleteSink, "complete"),
        (landing.stream(), lambda path, schema: BatchSink(path, schema, lambda b: b), "append"),
    ]
    sinks = [(step, make(new_dir(spark, "out"), step.schema), mode) for step, make, mode in makes]
    seen = []
    for round_ in range(4):
        landing.add_rows(spark.range(10 * round_, 10 * round_ + 10).toDF("n"))
        for i, (step, sink, mode) in enumerate(sinks):
            handle = run_through(step, sink, mode)
            if round_ == 1:
                before = set(os.listdir(sink.path))
                snapshot = handle.snapshot("second")
                assert set(os.listdir(sink.path)) == before
                seen.append((by_key(snapshot), snapshot))
            if round_ == 3:
                rows, snapshot = seen[i]
                assert by_key(handle.table()) != rows == by_key(snapshot) == by_key(handle.table("second"))
                assert by_key(type(handle)(handle.query, sink, step, handle._log).table(as_of="second")) == rows
                handle.release("second")
                with pytest.raises(KeyError):
                    handle.table("second")


def test_steps_over_a_live_table(spark):
    """Typed rows get an arrival time; two steps and the latest row are read from the live table."""
    record = T.StructType(
        [T.StructField("ColumnOne", T.StringType()), T.StructField("ColumnTwo", T.IntegerType())]
    )
    steps = chain(
        step_exprs("*", "ColumnTwo * 2 ColumnFour"), step_exprs("*", "ColumnFour * 2 ColumnFive")
    )
    landing = RowLanding(spark, new_dir(spark, "landing"), record)
    stream = with_arrival_time(landing.stream())
    handle = run_step(stream, "chained", FileSink(new_dir(spark, "out"), stream.schema))
    try:
        for n in (10, 30, 20):
            landing.add_row(("ValueOne", n))
            handle.process_all()
            newest = latest_n(handle.table().transform(steps), "Now", ["ColumnTwo"], 1).first()
            assert (newest.ColumnTwo, newest.ColumnFour, newest.ColumnFive) == (n, n * 2, n * 4)
        greatest = argmax(handle.table().transform(steps), "ColumnFive", ["Now"]).first()
        assert greatest.ColumnTwo == 30
        handle.view()
        assert spark.sql("SELECT sum(ColumnTwo) FROM chained").first()[0] == 60
    finally:
        handle.stop()


def test_rounds_counted_by_arrival(spark):
    rounds = [spark.range(lo, hi).selectExpr("cast(id as int) value") for lo, hi in ROUNDS]
    sums = []
    for n in (1, 2, 3):
        runs = in_batches(
            rounds[:n],
            lambda df: window_count(with_arrival_time(df, "now"), "now", "5 seconds", "5 seconds"),
            upsert_windows,
            "update",
        )
        sums.append(total(runs[-1].table().select("window", "total"), "total").first()[0])
    assert sums == [3, 8, 16]


def test_handle(spark):
    landing = RowLanding(spark, new_dir(spark, "landing"), NUMBERS)
    landing.add_rows(spark.range(5).toDF("n"))
    sink = FileSink(new_dir(spark, "out"), NUMBERS)
    handle = run_step(landing.stream(), "handled", sink, trigger="1 second")
    try:
        assert handle.step_id == "handled" and handle.is_active
        assert "message" in handle.status
        assert handle.wait(0.1) is False
        with pytest.raises(ValueError, match="already running"):
            run_step(landing.stream(), "handled", sink)
        handle.process_all()
        progress = handle.progress()
        assert progress.agg(F.sum("num_input_rows")).first()[0] == 5
        assert progress.where("source LIKE 'FileStreamSource%'").count() == progress.count()
    finally:
        handle.stop()
    assert not handle.is_active
    assert handle.wait(5) is True


def test_failure_reaches_the_caller(spark):
    landing = RowLanding(spark, new_dir(spark, "landing"), NUMBERS)
    landing.add_row((0,))
    bad = landing.stream().select((F.lit(1) / F.col("n")).alias("n"))
    with pytest.raises(StreamingQueryException):
        run_through(bad, FileSink(new_dir(spark, "out"), bad.schema))


def test_modes_are_checked(spark):
    landing = RowLanding(spark, new_dir(spark, "landing"), NUMBERS)
    with pytest.raises(ValueError, match="mode"):
        run_step(landing.stream(), "m", MemorySink(), mode="replace")
    with pytest.raises(ValueError, match="two versions"):
        CompleteSink("somewhere", NUMBERS, versions=1)


def test_console_sink(spark):
    landing = RowLanding(spark, new_dir(spark, "landing"), NUMBERS)
    landing.add_row((42,))
    handle = run_step(landing.stream(), "console", ConsoleSink(5, False), trigger=AVAILABLE_NOW)
    handle.wait()
    report = handle.query.lastProgress
    assert report.numInputRows == 1 and "Console" in report.sink.description
    with pytest.raises(TypeError):
        handle.table()


PRECISE = [(1, dt.datetime(2024, 3, 10, 2, 30, 0, 123456)), (2, None)]


def test_json_keeps_microseconds_and_structs(spark, zone):
    df = spark.createDataFrame(PRECISE, "id INT, ts TIMESTAMP_NTZ")
    df = df.withColumn("at", F.timestamp_micros(F.lit(1_710_037_800_123_457)))
    df = df.withColumn("window", F.struct(F.col("ts").alias("start"), F.col("at").alias("end")))
    path = new_dir(spark, "json")
    for _ in range(2):  # overwrites
        write_json(df, path)
    assert by_key(read_json(spark, path, df.schema)) == by_key(df)


def test_json_as_a_streaming_sink(spark):
    batches = [
        spark.createDataFrame([row], "id INT, ts TIMESTAMP_NTZ") for row in PRECISE
    ]
    runs = in_batches(batches, lambda df: df, lambda p, s: FileSink(p, s, "json"))
    assert by_key(runs[-1].table()) == by_key(batches[0].union(batches[1]))


@pytest.mark.parametrize("name", ["previous_event_stream", "previous_amount_stream"])
def test_previous_queries_call_no_python_for_a_key(spark, folder, monkeypatch, name):
    """What a call costs would grow with users times batches."""

    def refuse(*_, **__):
        raise AssertionError("a Python function for each key")

    monkeypatch.setattr(GroupedData, "applyInPandasWithState", refuse)
    assert STREAM_QUERIES[name](spark, folder).count() == spark.read.parquet(f"{folder}/events.parquet").count()

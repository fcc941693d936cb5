"""What a step leaves behind: restarts, replays, commits, files and folders."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepstream.catalogue import QUERIES
from stepstream.catalogue.streams import in_batches, run_through
from stepstream.operators import count_by, previous_value
from stepstream.sources import RowLanding
from stepstream.streaming import BatchSink, CompleteSink, FileSink, MemorySink, PreviousSink, UpsertSink, run_step
from stepstream.streaming.handle import AVAILABLE_NOW
from stepstream.streaming.sinks import FAN
from stepstream.workspace import committed_parts, new_dir

ROWS = T.StructType().add("k", "string").add("ts", T.LongType()).add("amount", "double").add("label", "string")
VERSIONS = T.StructType().add("k", "string").add("v", "double")
COUNTS = T.StructType().add("k", "string").add("cnt", T.LongType())


def rows(spark, *values):
    return spark.createDataFrame([(*v, str(v[2])) for v in values], ROWS)


def ten(spark, start):
    return rows(spark, *[("a", start + i, float(i)) for i in range(10)])


@pytest.fixture
def landing(spark):
    return RowLanding(spark, new_dir(spark, "landing"), ROWS)


def test_a_file_table_goes_on_after_a_restart(spark, landing):
    path = new_dir(spark, "result")
    for start in (0, 10):
        landing.add_rows(ten(spark, start))
        run_through(landing.stream(), FileSink(path, ROWS))
    found = FileSink(path, ROWS).table(spark)
    assert sorted(r["ts"] for r in found.collect()) == list(range(20))


def test_an_upsert_table_goes_on_after_a_restart(spark, landing):
    path = new_dir(spark, "result")
    for start in (0, 10, 20):
        landing.add_rows(ten(spark, start))
        run_through(count_by(landing.stream(), "k"), UpsertSink(path, COUNTS, ["k"]), "update")
    assert [tuple(r) for r in UpsertSink(path, COUNTS, ["k"]).table(spark).collect()] == [("a", 30)]


def previous_sink(path, column="amount", keys=("k",), default=-1):
    return PreviousSink(path, ROWS, lambda df: F.col(column), ["ts"], keys, default, "before")


def test_a_previous_table_goes_on_after_a_restart(spark, landing):
    path = new_dir(spark, "result")
    for start in (0, 10):
        landing.add_rows(ten(spark, start))
        run_through(landing.stream(), previous_sink(path))
    found = {r["ts"]: r["before"] for r in previous_sink(path).table(spark).collect()}
    assert found == {ts: -1.0 if ts == 0 else (ts - 1) % 10 for ts in range(20)}


@pytest.mark.parametrize("column, default, expected", [("amount", 0, [0.0, 10.0, 30.0]), ("label", "", ["", "10.0", "30.0"])])
def test_previous_values_of_any_type(spark, column, default, expected):
    batches = [rows(spark, ("a", 1, 10.0)), rows(spark, ("a", 2, 30.0)), rows(spark, ("a", 3, 5.0), ("b", 1, 1.0))]
    table = in_batches(batches, lambda df: df, lambda path, _: previous_sink(path, column, default=default))[-1].table()
    assert [r["before"] for r in table.where("k = 'a'").orderBy("ts").collect()] == expected
    assert [r["before"] for r in table.where("k = 'b'").collect()] == [default]


def test_previous_without_keys_after_an_empty_batch(spark):
    sink = previous_sink(new_dir(spark, "result"), keys=())
    for i, batch in enumerate([rows(spark).limit(0), rows(spark, ("a", 1, 7.0)), rows(spark, ("b", 2, 8.0))]):
        sink._write(batch, i)
    assert [r["before"] for r in sink.table(spark).orderBy("ts").collect()] == [-1.0, 7.0]


def test_previous_state_is_folded(spark):
    """Key ``rare`` comes back after more batches than a fold takes."""
    sink = previous_sink(new_dir(spark, "result"))
    for i in range(20):
        key = "rare" if i in (0, 19) else "often"
        sink._write(rows(spark, (key, i, float(i))), i)
    assert {r["ts"]: r["before"] for r in sink.table(spark).collect()}[19] == 0.0
    assert committed_parts(spark, f"{sink.path}/state", "batch_id") == [16, 17, 18, 19]


def test_a_replay_after_compaction_replaces_its_own_rows_only(spark):
    sink = UpsertSink(new_dir(spark, "result"), COUNTS, ["k"])
    sink.write_batch(spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], COUNTS), 0)
    sink.write_batch(spark.createDataFrame([("x", 5)], COUNTS), 1)
    folded = sink.compact(spark, new_dir(spark, "folded"))
    folded.write_batch(spark.createDataFrame([("x", 9)], COUNTS), 1)
    assert sorted(map(tuple, folded.table(spark).collect())) == [("x", 9), ("y", 2), ("z", 3)]
    assert folded.checkpoint == sink.checkpoint


def test_a_complete_result_may_become_empty(spark):
    sink = CompleteSink(new_dir(spark, "result"), COUNTS)
    for i, values in enumerate([[("x", 1)], [("x", 2), ("y", 1)], []]):
        sink._write(spark.createDataFrame(values, COUNTS), i)
        assert sink.table(spark).count() == len(values)
    assert committed_parts(spark, sink.path, "batch_id") == [1, 2]


def test_a_batch_shows_once_it_is_committed(spark):
    sink = BatchSink(new_dir(spark, "result"), COUNTS, lambda batch: batch)
    for i in range(2):
        sink.write_batch(spark.createDataFrame([("x", i)], COUNTS), i)
    os.remove(f"{sink.path}/batch_id=1/_SUCCESS")
    assert [tuple(r) for r in sink.table(spark).collect()] == [("x", 0, 0)]


def test_progress_is_whole_after_many_batches_and_a_restart(spark, landing):
    """The session remembers three reports; the log has those of all batches of both runs."""
    sink = FileSink(new_dir(spark, "result"), ROWS)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        for run in range(2):
            for i in range(12):
                landing.add_rows(ten(spark, 10 * i).coalesce(1))
            handle = run_through(landing.stream(files_per_batch=1), FileSink(sink.path, ROWS))
            deadline = time.time() + 20
            while handle.progress().where("num_input_rows > 0").count() < 12 * (run + 1) and time.time() < deadline:
                time.sleep(0.2)
            found = handle.progress().where("num_input_rows > 0").select("batch_id", "num_input_rows").collect()
            assert sorted(map(tuple, found)) == [(i, 10) for i in range(12 * (run + 1))]
        assert len(handle.query.recentProgress) <= 3
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_progress_without_files_is_whole_or_refused(spark, landing):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        for i in range(5):
            landing.add_rows(ten(spark, 10 * i).coalesce(1))
        handle = run_step(landing.stream(files_per_batch=1), "in_memory", MemorySink(), trigger=AVAILABLE_NOW)
        handle.wait()
        with pytest.raises(RuntimeError, match="numRecentProgressUpdates"):
            handle.progress()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def upserts(spark, sink, batches, replay=()):
    """Batch i changes the keys i % 5 and i % 7; its versions are i, and after a replay i + 0.5."""
    for i in batches:
        for version in (float(i), i + 0.5) if i in replay else (float(i),):
            sink.write_batch(spark.createDataFrame([(str(k), version) for k in {i % 5, 10 + i % 7}], VERSIONS), i)


def newest(n, replay=()):
    return {str(k): i + 0.5 * (i in replay) for i in range(n) for k in (i % 5, 10 + i % 7)}


def test_an_update_log_has_few_parts(spark):
    """Parts are bounded after 80 batches, and every version is the newest, also of batches that were replayed at a merge."""
    sink, replay, most = UpsertSink(new_dir(spark, "result"), VERSIONS, ["k"]), {7, 12, 15, 63, 71}, 0
    for n in range(80):
        upserts(spark, sink, [n], replay)
        most = max(most, len(sink.version(spark)))
        if n in (6, 7, 8, 63, 64, 79):
            assert {r["k"]: r["v"] for r in sink.table(spark).collect()} == newest(n + 1, replay)
    assert most <= 2 * FAN
    assert sink.version(spark) == ["merged=0-63", "merged=64-71", "merged=72-79"]
    kept = [n for n in os.listdir(sink.path) if "=" in n]
    assert len(kept) <= 4 * FAN


def test_a_merge_that_fails_loses_nothing(spark, monkeypatch):
    sink = UpsertSink(new_dir(spark, "result"), VERSIONS, ["k"])
    upserts(spark, sink, range(FAN - 1))
    log, fails = UpsertSink._log, [True]

    def broken(self, spark, names):
        rows = log(self, spark, names)
        return rows.withColumn("v", F.raise_error(F.lit("lost")).cast("double")) if fails and len(names) == FAN and fails.pop() else rows

    monkeypatch.setattr(UpsertSink, "_log", broken)
    with pytest.raises(Exception, match="lost"):
        upserts(spark, sink, [FAN - 1])
    assert {r["k"]: r["v"] for r in sink.table(spark).collect()} == newest(FAN)
    upserts(spark, sink, [FAN - 1])  # the replay
    assert sink.version(spark) == [f"merged=0-{FAN - 1}"]
    assert {r["k"]: r["v"] for r in sink.table(spark).collect()} == newest(FAN)


def test_a_snapshot_keeps_its_parts(spark):
    sink = UpsertSink(new_dir(spark, "result"), VERSIONS, ["k"])
    upserts(spark, sink, range(5))
    sink.pin(spark, "five", sink.version(spark))
    upserts(spark, sink, range(5, 26))
    assert {r["k"]: r["v"] for r in sink.table(spark, sink.pinned(spark, "five")).collect()} == newest(5)
    assert {r["k"]: r["v"] for r in sink.table(spark).collect()} == newest(26)
    assert set(range(5)) < set(committed_parts(spark, sink.path, "batch_id"))
    sink.unpin(spark, "five")
    upserts(spark, sink, [26])
    assert not set(range(5)) & set(committed_parts(spark, sink.path, "batch_id"))


def test_a_stateful_step_writes_few_files(spark, landing):
    landing.add_rows(rows(spark, *[(f"k{i}", i, 0.0) for i in range(200)]))
    sink = UpsertSink(new_dir(spark, "result"), COUNTS, ["k"])
    run_through(count_by(landing.stream(), "k"), sink, "update", conf={"spark.sql.shuffle.partitions": "32"})
    assert len(glob.glob(f"{sink.path}/batch_id=0/*.parquet")) <= spark.sparkContext.defaultParallelism
    assert sink.table(spark).count() == 200


def test_the_cuts_stand_in_the_plan_once(spark, events):
    def plan(slices):
        df = previous_value(events, F.col("value"), ["ts", "event_id"], ["user_id"], slices=slices)
        return len(df._jdf.queryExecution().toString())

    assert plan(8000) < 4 * plan(80)


@pytest.mark.parametrize("name", ["live_vs_snapshot", "word_count_stream", "keyed_sum_per_batch", "previous_amount_stream"])
def test_streams_of_empty_tables(spark, folder, tmp_path, name):
    for table in ("events", "documents", "lineitem"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    found = QUERIES[name](spark, str(tmp_path)).collect()
    assert [r["n"] for r in found] == [0, 0] if name == "live_vs_snapshot" else found == []


def test_nothing_but_the_result_is_left(spark, folder):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    QUERIES["keyed_sum_per_batch"](spark, folder).collect()
    assert {n.split("-")[0] for n in set(os.listdir(shared)) - before} == {"result"}

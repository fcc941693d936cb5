"""Windows that are still open when a stream ends."""

import pytest
from pyspark.sql import functions as F
from test_late_and_landing import SECONDS, batches, late_sink

from stepstream.catalogue.streams import in_batches, run_through
from stepstream.operators import open_window_counts, window_count
from stepstream.sources import RowLanding
from stepstream.streaming import FileSink, UpsertSink
from stepstream.streaming.handle import ROCKSDB_STATE
from stepstream.workspace import committed_names, new_dir, remove

STATES = pytest.mark.parametrize("conf", [None, ROCKSDB_STATE], ids=["memory", "rocksdb"])


def windows(df):
    return window_count(df, "ts", "5 seconds", "5 seconds")


def counts(table):
    return sorted(map(tuple, table.select(F.unix_seconds("window.start"), "total").collect()))


class Run:
    """A step of window counts that may be run again on its table."""

    def __init__(self, spark, parts, conf=None):
        self.landing = RowLanding(spark, new_dir(spark, "landing"), parts[0].schema)
        self.path = new_dir(spark, "result")
        self.conf = conf
        for part in parts:
            self.handle = self.add(part)

    def add(self, part):
        self.landing.add_rows(part)
        return self.again()

    def again(self):
        stepped = windows(self.landing.stream())
        return run_through(stepped, FileSink(self.path, stepped.schema), conf=self.conf)


@STATES
def test_all_windows_without_the_late_rows_before_the_end(spark, conf):
    run = Run(spark, batches(spark), conf)
    given = counts(run.handle.table())
    finished = counts(run.handle.finish(open_window_counts))
    assert set(given) < set(finished)
    kept = in_batches(batches(spark), lambda df: df, late_sink)[-1].sink.kept(spark).where("ts IS NOT NULL")
    expected = window_count(kept.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "5 seconds")
    assert finished == counts(expected)
    assert sum(n for _, n in finished) == sum(map(len, SECONDS)) - 3  # two late rows, one without a time


def test_a_finished_table_stays_as_it_is(spark):
    run = Run(spark, batches(spark)[:2])
    run.handle.snapshot("before")
    given = counts(run.handle.table())
    finished = counts(run.handle.finish(open_window_counts))
    assert counts(run.handle.finish(lambda state: state.limit(0))) == finished  # the second call does nothing
    assert counts(run.handle.table(as_of="before")) == given
    assert counts(run.handle.snapshot("after")) == finished
    with pytest.raises(ValueError, match="finished"):
        run.add(batches(spark)[2])
    assert counts(run.handle.table()) == finished


def test_a_failed_end_adds_nothing_and_can_be_repeated(spark):
    run = Run(spark, batches(spark)[:2])
    given = counts(run.handle.table())
    broken = F.raise_error(F.lit("lost")).cast("bigint").alias("total")
    with pytest.raises(Exception, match="lost"):
        run.handle.finish(lambda state: state.select("key.window", broken))
    assert counts(run.handle.table()) == given
    assert committed_names(spark, run.handle.sink._end, "last") == []
    assert sum(n for _, n in counts(run.handle.finish(open_window_counts))) == 6


def test_the_last_batch_must_be_committed(spark):
    run = Run(spark, batches(spark)[:3])
    checkpoint = run.handle.sink.checkpoint
    last = run.handle._batches("commits")
    remove(spark, f"{checkpoint}/commits/{last}")
    with pytest.raises(RuntimeError, match="not committed"):
        run.handle.finish(open_window_counts)
    assert sum(n for _, n in counts(run.again().finish(open_window_counts))) == 7


def test_a_stream_without_rows(spark):
    empty = batches(spark)[0].limit(0)
    assert counts(Run(spark, [empty]).handle.finish(open_window_counts)) == []


def test_steps_that_hold_nothing_back(spark):
    rows = in_batches(batches(spark)[:1], lambda df: df, FileSink)[-1]
    with pytest.raises(TypeError, match="one aggregate|state"):
        in_batches(batches(spark)[:1], lambda df: df, FileSink, last=open_window_counts)
    assert rows.table().count() == 3
    with pytest.raises(TypeError, match="has no end"):
        in_batches(batches(spark)[:1], windows, lambda path, schema: UpsertSink(path, schema, ["window"]), "update", last=open_window_counts)

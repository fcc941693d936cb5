"""Late rows as a table, and landings that may be repeated."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepstream.catalogue.streams import in_batches, run_through
from stepstream.operators import window_count
from stepstream.sources import RowLanding, landing as landings
from stepstream.streaming import FileSink, LateRowsSink, UpsertSink
from stepstream.workspace import committed_parts, file_names, new_dir

TIMES = T.StructType().add("id", T.LongType()).add("ts", T.TimestampNTZType())
SECONDS = [[1, 2, 3], [4, 6, 16], [17], [2, 30, None], [], [24, 25]]  # 24 lies in a window that ended at 25


def batches(spark):
    base = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    made = []
    for seconds in SECONDS:
        rows = spark.createDataFrame([(s,) for s in seconds], "id BIGINT").coalesce(1)
        made.append(rows.select("id", F.timestamp_add("SECOND", F.col("id").cast("int"), base).alias("ts")))
    return made


def late_sink(path, schema=TIMES):
    return LateRowsSink(path, schema, "ts", "5 seconds", "5 seconds")


def test_late_rows_are_those_that_the_windows_miss(spark, zone):
    handle = in_batches(batches(spark), lambda df: df, late_sink)[-1]
    late = [(r["id"], r["batch_id"]) for r in handle.sink.late(spark).collect()]
    assert sorted(late) == [(2, 3), (24, 5)]
    kept = handle.sink.kept(spark)
    assert kept.count() + len(late) == sum(map(len, SECONDS))
    assert kept.where("ts IS NULL").count() == 1
    if zone == "UTC":
        windows = in_batches(
            batches(spark),
            lambda df: window_count(df, "ts", "5 seconds", "5 seconds"),
            lambda path, schema: UpsertSink(path, schema, ["window"]),
            "update",
        )[-1].table()
        counted = {r["at"]: r["total"] for r in windows.select(F.unix_seconds("window.start").alias("at"), "total").collect()}
        expected = window_count(kept.where("ts IS NOT NULL"), "ts", "5 seconds")
        start = F.unix_seconds(F.col("window.start").cast("timestamp")).alias("at")
        assert counted == {r["at"]: r["total"] for r in expected.select(start, "total").collect()}


def test_a_replayed_batch_is_judged_as_before(spark):
    sink = late_sink(new_dir(spark, "result"))
    made = batches(spark)
    for i in (0, 1, 1, 2, 3, 3):
        sink.write_batch(made[i], i)
    assert [r["id"] for r in sink.late(spark).collect()] == [2]
    assert sink.table(spark).count() == 10
    assert committed_parts(spark, f"{sink.checkpoint}/marks", "batch_id") == [2, 3]


def test_late_rows_of_an_empty_stream(spark):
    sink = late_sink(new_dir(spark, "result"))
    sink.write_batch(spark.createDataFrame([], TIMES), 0)
    assert sink.late(spark).count() == sink.kept(spark).count() == 0


def test_a_column_named_late_is_refused(spark):
    with pytest.raises(ValueError):
        late_sink("x", T.StructType().add("late", "int").add("ts", "timestamp"))


NUMBERS = T.StructType().add("id", T.LongType())


@pytest.fixture
def landing(spark):
    return RowLanding(spark, new_dir(spark, "landing"), NUMBERS)


@pytest.mark.parametrize("step", ["move_files", "write_text", "remove"])
def test_a_landing_that_failed_may_be_repeated(spark, landing, monkeypatch, step):
    rows = spark.range(20).repartition(3)
    works = getattr(landings, step)

    def fails(*args):
        raise OSError("stopped")

    monkeypatch.setattr(landings, step, fails)
    with pytest.raises(OSError):
        landing.add_rows(rows, key="a")
    monkeypatch.setattr(landings, step, works)
    for _ in range(2):
        landing.add_rows(rows, key="a")
    assert sorted(r["id"] for r in landing.table().collect()) == list(range(20))
    assert file_names(spark, landing.staged) == [] and file_names(spark, landing.landed) == ["a"]


def test_a_landing_stopped_while_files_move(spark, landing):
    """Half of the files are in the landing already; the repeated call moves the rest."""
    rows = spark.range(20).repartition(4)
    rows.write.parquet(f"{landing.staged}/a")
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(landing.path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop.Path(landing.path))
    moved = [n for n in file_names(spark, f"{landing.staged}/a") if n.startswith("part")][:2]
    for name in moved:
        files.rename(hadoop.Path(f"{landing.staged}/a/{name}"), hadoop.Path(f"{landing.path}/a-{name}"))
    landing.add_rows(rows, key="a")
    assert sorted(r["id"] for r in landing.table().collect()) == list(range(20))


def test_a_stream_sees_rows_of_a_key_once(spark, landing):
    sink = FileSink(new_dir(spark, "result"), NUMBERS)
    for key in ("a", "a", "b", "a"):
        landing.add_rows(spark.range(5), key=key)
        run_through(landing.stream(), sink)
    assert sink.table(spark).count() == 10


def test_keys_are_names(spark, landing):
    with pytest.raises(ValueError):
        landing.add_rows(spark.range(1), key="../a")

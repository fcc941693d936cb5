import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from stepstream.functions import epoch_millis
from stepstream.operators import (
    argmax,
    count_by,
    keyed_sum,
    latest,
    latest_by_key,
    latest_n,
    preview,
    previous_value,
    top_counts,
    total,
    window_bounds,
    window_count,
    word_count,
)

TIES = "id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE"
T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_window_count_of_wall_clock_time(spark, zone):
    df = spark.createDataFrame([(i, at(s), 0.0) for i, s in enumerate([0, 4, 5, 14])], TIES)
    expected = [(at(0), at(5), 2), (at(10), at(15), 1), (at(5), at(10), 1)]  # in order of text
    assert rows_of(window_bounds(window_count(df, "ts", "5 seconds"))) == expected
    late = window_count(df, "ts", "5 seconds", watermark="5 seconds")
    assert rows_of(window_bounds(late)) == expected


def test_window_totals_add_up(events):
    counts = window_count(events, "ts", "7 minutes")
    assert total(counts, "total").first()[0] == events.count()


def test_total_of_nothing_is_null(spark):
    assert total(spark.createDataFrame([], "n BIGINT"), "n").first()[0] is None


def test_word_count(spark):
    lines = spark.createDataFrame([(" a  b ",), ("",), ("A a",), (None,)], "line STRING")
    assert rows_of(word_count(lines, "line")) == [("a", 3), ("b", 1)]
    assert rows_of(word_count(lines, "line", drop_empty=False)) == [("", 2), ("a", 3), ("b", 1)]


def test_count_and_sum_by_key_keep_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5)], "k STRING, n INT")
    assert rows_of(count_by(df, "k")) == [("a", 2), (None, 1)]
    assert rows_of(keyed_sum(df, "k", "n")) == [("a", 3), (None, 5)]


def test_latest_breaks_ties(spark):
    df = spark.createDataFrame([(1, at(1), 5.0), (3, at(1), 4.0), (2, at(1), 5.0)], TIES)
    assert tuple(latest(df, "ts", ["id"]).first()) == (3, at(1), 4.0)
    assert tuple(argmax(df, "value", ["id"]).first()) == (2, at(1), 5.0)
    assert [r.id for r in latest_n(df, "ts", ["id"], 2).collect()] == [3, 2]


def test_latest_needs_a_tie_break(spark):
    with pytest.raises(ValueError, match="tie-break"):
        latest(spark.createDataFrame([], TIES), "ts", [])


def test_argmax_takes_null_as_smallest(spark):
    df = spark.createDataFrame([(1, at(1), None), (2, at(1), -1.0)], TIES)
    assert argmax(df, "value", ["id"]).first().id == 2
    assert argmax(df.where("id = 1"), "value", ["id"]).first().id == 1


def test_latest_of_nothing_is_no_row(spark):
    nothing = spark.createDataFrame([], TIES)
    assert latest(nothing, "ts", ["id"]).collect() == []
    assert latest(nothing, "ts", ["id"]).columns == nothing.columns
    assert latest_by_key(nothing, ["id"], "ts", ["id"]).collect() == []


def test_latest_by_key(spark):
    rows = [("a", 1, 1), ("a", 1, 2), ("b", 3, 1), (None, 0, 9)]
    df = spark.createDataFrame(rows, "k STRING, t INT, id INT")
    assert rows_of(latest_by_key(df, ["k"], "t", ["id"])) == [("a", 1, 2), ("b", 3, 1), (None, 0, 9)]


def test_top_counts_and_preview(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9)], "value STRING, cnt BIGINT")
    assert [tuple(r) for r in top_counts(df, 2).collect()] == [("c", 9), ("a", 2)]
    assert [r.value for r in preview(df, 2, ["value"]).collect()] == ["a", "b"]
    assert preview(df, 2).count() == 2


def brute_force(rows, keyed, default=0):
    """Rows ``(k, t, id, v)`` with the ``v`` of the row before, one at a time."""
    last, found = {}, []
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    for k, t, i, v in order:
        key = k if keyed else "all"
        found.append((k, t, i, v, last.get(key, default)))
        last[key] = v
    return sorted(found, key=repr)


def skewed_rows(n, seed):
    """A third of the rows in one key, a third at one time, and keys of a single row."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None, f"only{i}"])
        t = 50 if i % 3 == 1 else rng.randrange(100)
        rows.append((key, t, i, rng.choice([None, i * 10])))
    return rows


SKEWED = "k STRING, t INT, id INT, v INT"


@pytest.mark.parametrize("slices", [1, 2, 7, 64])
@pytest.mark.parametrize("keys", [["k"], []])
def test_previous_value_equals_brute_force_on_skewed_rows(spark, keys, slices):
    rows = skewed_rows(2000, slices)
    df = spark.createDataFrame(rows, SKEWED).repartition(5)
    result = previous_value(df, F.col("v"), ["t", "id"], keys, slices=slices)
    assert result.columns == ["k", "t", "id", "v", "previous"]
    assert rows_of(result) == brute_force(rows, bool(keys))


def test_previous_value_spreads_a_hot_key(spark):
    """A table that is all one key, at one time, still makes tasks of about equal size."""
    df = spark.range(20_000).select(
        (F.col("id") >= 0).alias("k"), (F.col("id") < 0).alias("t"), F.col("id").alias("n")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would merge tasks this small
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        result = previous_value(df, F.col("n"), ["t", "n"], ["k"], default=-1)
        assert result.where(F.col("previous") != F.col("n") - 1).count() == 0
        by_task = result.groupBy(F.spark_partition_id()).agg(F.count("previous"))
        sizes = [r[1] for r in by_task.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert sum(sizes) == 20_000
    assert len(sizes) > 20 and max(sizes) < 20_000 / 8


def test_previous_value_of_little_or_nothing(spark):
    nothing = spark.createDataFrame([], SKEWED)
    assert previous_value(nothing, F.col("v"), ["t"], ["k"]).collect() == []
    one = spark.createDataFrame([("a", 1, 1, 5)], SKEWED)
    assert previous_value(one, F.col("v"), ["t"], ["k"], default=-1).first().previous == -1


def test_previous_value_refuses_what_it_cannot_carry(spark, events):
    with pytest.raises(ValueError, match="order_by"):
        previous_value(events, F.col("event_id"), [])
    with pytest.raises(TypeError, match="epoch"):
        previous_value(events, F.col("ts"), ["ts", "event_id"])


def test_previous_value_of_times(events, zone):
    current = epoch_millis(events, "ts")
    found = previous_value(events, current, ["ts", "event_id"], ["event_type"])
    window = Window.partitionBy("event_type").orderBy("ts", "event_id")
    expected = events.withColumn("previous", F.lag(current, 1, 0).over(window))
    assert rows_of(found) == rows_of(expected)


keys = st.one_of(st.none(), st.sampled_from(["a", "b", 'q"\\', "é\n"]))
numbers = st.one_of(st.none(), st.floats(allow_nan=False), st.just(math.inf))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(keys, st.one_of(st.none(), st.floats(allow_nan=False)), numbers), max_size=40))
def test_previous_value_property(spark, drawn):
    """Text and float keys come through the cuts unchanged, NULL first in the order."""
    rows = [(k, t, i, v) for i, (k, t, v) in enumerate(drawn)]
    df = spark.createDataFrame(rows, "k STRING, t DOUBLE, id INT, v DOUBLE")
    found = previous_value(df, F.col("v"), ["t", "id"], ["k"], default=-1.0, slices=5)
    last, expected = defaultdict(lambda: -1.0), []
    for k, t, i, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0.0, r[2])):
        expected.append((k, t, i, v, last[k]))
        last[k] = v
    assert rows_of(found) == sorted(expected, key=repr)

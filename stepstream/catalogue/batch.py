"""Batch queries. Each takes ``(spark, folder)`` and returns a DataFrame."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from stepstream.functions import (
    epoch_millis,
    epoch_seconds,
    instant,
    squared_pairs,
    to_map_rows,
    typed_projection,
    with_arrival_time,
)
from stepstream.operators import (
    argmax,
    keyed_sum,
    latest,
    latest_by_key,
    latest_n,
    previous_value,
    top_counts,
    total,
    window_bounds,
    window_count,
    word_count,
)
from stepstream.plans import chain, sql_step, step_exprs
from stepstream.schema import StepSchema
from stepstream.sources import read_table
from stepstream.streaming import read_json, write_json
from stepstream.workspace import new_dir

EVENT_ROW = StepSchema(
    ["event_id", "ts", "user_id", "event_type", "value", "props"],
    ["bigint", "timestamp_ntz", "bigint", "string", "double", "string"],
    ["-1", "2024-01-01 00:00:00", "0", "start", "0.5", "{}"],
)
double_twice = chain(
    step_exprs("l_orderkey", "l_linenumber ColumnTwo", "l_linenumber * 2 ColumnFour"),
    step_exprs("l_orderkey", "ColumnTwo", "ColumnFour", "ColumnFour * 2 ColumnFive"),
)


def flagship(spark, folder):
    """Events as string-map rows, typed again, taken through two steps; the ten latest of them."""
    steps = chain(
        lambda df: to_map_rows(df, EVENT_ROW.names),
        lambda df: typed_projection(df, EVENT_ROW),
        step_exprs("event_id", "ts", "user_id", "value", "value * 2 doubled"),
        step_exprs("*", "doubled * 2 redoubled"),
    )
    return latest_n(read_table(spark, folder, "events").transform(steps), "ts", ["event_id"], 10)


def typed_map_projection(spark, folder):
    return typed_projection(to_map_rows(read_table(spark, folder, "events")), EVENT_ROW)


def typed_map_malformed(spark, folder):
    """``code`` does not parse for errors, and ``absent`` is in no map."""
    user = F.col("user_id").cast("string")
    code = F.when(F.col("event_type") == "error", F.concat(user, F.lit("?"))).otherwise(user)
    coded = read_table(spark, folder, "events").withColumn("code", code)
    schema = StepSchema(["code", "value", "absent"], ["Integer", "Double", "String"])
    return typed_projection(to_map_rows(coded, ["code", "value"], ["event_id"]), schema, keep=["event_id"])


def step_chain(spark, folder):
    return read_table(spark, folder, "lineitem").transform(double_twice)


def sql_text_step(spark, folder):
    step = sql_step("SELECT o_orderkey, o_orderstatus, o_totalprice * 2 doubled FROM {src}")
    return read_table(spark, folder, "orders").transform(step)


def event_epoch_seconds(spark, folder):
    events = read_table(spark, folder, "events")
    return events.select("event_id", epoch_seconds(events, "ts").alias("now"))


def arrival_timestamp(spark, folder):
    """The clock itself differs from run to run: show that it came after the event, and how many hours it is off."""
    asked_at = F.lit(time.time())
    events = with_arrival_time(read_table(spark, folder, "events"))
    arrived_after = F.col("Now") > instant(events, "ts")
    hours_off = F.floor((F.unix_micros("Now") / 1e6 - asked_at) / 3600).cast("int")
    return events.select("event_id", arrived_after.alias("arrived_after"), hours_off.alias("hours_off"))


def document_words(spark, folder):
    return word_count(read_table(spark, folder, "documents"), "text")


def top_words(spark, folder):
    return top_counts(document_words(spark, folder), 10)


def hourly_counts(spark, folder):
    return window_bounds(window_count(read_table(spark, folder, "events"), "ts", "1 hour"))


def window_total(spark, folder):
    return hourly_counts(spark, folder).select("window_start", "total")


def sum_of_counts(spark, folder):
    return total(hourly_counts(spark, folder), "total", "sum_counts")


def squares(spark, folder):
    return keyed_sum(squared_pairs(read_table(spark, folder, "lineitem"), "l_linenumber"), "k", "n")


def latest_row(spark, folder):
    return latest(read_table(spark, folder, "events"), "ts", ["event_id"])


def latest_rows(spark, folder):
    return latest_n(read_table(spark, folder, "events"), "ts", ["event_id"], 10)


def latest_per_key(spark, folder):
    return latest_by_key(read_table(spark, folder, "events"), ["user_id"], "ts", ["event_id"])


def argmax_row(spark, folder):
    return argmax(read_table(spark, folder, "events"), "value", ["event_id"])


def previous_event(spark, folder, keys=("user_id",)):
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts")
    current = epoch_millis(events, "ts")
    before = previous_value(events, current, ["ts", "event_id"], keys, name="last_ms")
    return before.select("event_id", "user_id", current.alias("current_ms"), "last_ms")


def previous_event_global(spark, folder):
    return previous_event(spark, folder, keys=())


def json_round_trip(spark, folder):
    events = read_table(spark, folder, "events")
    path = new_dir(spark, "json")
    write_json(events, path)
    return read_json(spark, path, events.schema)


BATCH_QUERIES = {
    "typed_map_latest": flagship,
    "typed_map_projection": typed_map_projection,
    "typed_map_malformed": typed_map_malformed,
    "step_chain": step_chain,
    "sql_step": sql_text_step,
    "epoch_seconds": event_epoch_seconds,
    "arrival_timestamp": arrival_timestamp,
    "word_count": document_words,
    "top_words": top_words,
    "window_count": hourly_counts,
    "window_total": window_total,
    "sum_of_counts": sum_of_counts,
    "keyed_sum": squares,
    "latest_row": latest_row,
    "latest_n": latest_rows,
    "latest_per_key": latest_per_key,
    "argmax_row": argmax_row,
    "previous_event": previous_event,
    "previous_event_global": previous_event_global,
    "json_round_trip": json_round_trip,
}

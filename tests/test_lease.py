"""Two sessions that run a step on one table."""

import pytest
from test_late_and_landing import TIMES, batches

from stepstream.sources import RowLanding
from stepstream.streaming import BatchSink, CompleteSink, PreviousSink, UpsertSink, run_step
from stepstream.workspace import file_names, new_dir

SINKS = {
    "batch": (lambda path: BatchSink(path, TIMES, lambda b: b), "append"),
    "upsert": (lambda path: UpsertSink(path, TIMES, ["id"]), "append"),
    "previous": (lambda path: PreviousSink(path, TIMES, lambda df: df["id"], ["ts", "id"], []), "append"),
    "complete": (lambda path: CompleteSink(path, TIMES), "append"),
}


@pytest.mark.parametrize("name", SINKS)
def test_a_later_run_takes_the_table_over(spark, name):
    make, mode = SINKS[name]
    path, parts = new_dir(spark, "result"), batches(spark)
    handles, landings = [], []
    for session in (spark, spark.newSession()):
        session.conf.set("spark.sql.shuffle.partitions", "2")
        landing = RowLanding(session, new_dir(spark, "landing"), TIMES)
        landings.append(landing)
        checkpoint = new_dir(spark, "checkpoint")  # of its own: Spark itself ends an earlier run on the same one
        handles.append(run_step(landing.stream(), f"lease-{len(handles)}", make(path), mode, checkpoint=checkpoint))
        handles[-1].process_all()  # a batch that is under way is not fenced
    older, newer = handles
    try:
        landings[1].add_rows(parts[1])
        newer.process_all()
        table = sorted(r["id"] for r in newer.table().collect())
        landings[0].add_rows(parts[0])
        with pytest.raises(Exception, match="taken over"):
            older.process_all()
        assert sorted(r["id"] for r in newer.table().collect()) == table == [4, 6, 16]
        assert file_names(spark, f"{path}-leases") == ["2"]
    finally:
        for handle in handles:
            handle.stop()

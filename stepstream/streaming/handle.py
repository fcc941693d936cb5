"""Starting a step on a stream, and handling the running query."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stepstream.streaming.progress import ProgressLog
from stepstream.streaming.sinks import MemorySink, Sink
from stepstream.workspace import file_names, new_dir

OUTPUT_MODES = ("append", "update", "complete")
AVAILABLE_NOW = "available-now"
# Keeps the state of a step on the executors' disks; for steps with very many keys.
ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}


class StepHandle:
    """A started step: its streaming query and the table that its sink fills."""

    def __init__(self, query: StreamingQuery, sink: Sink, source: DataFrame, log: ProgressLog, checkpoint: str | None = None):
        self.query = query
        self._checkpoint = checkpoint
        self.sink = sink
        self.spark = source.sparkSession
        self._log = log

    @property
    def step_id(self) -> str:
        return self.query.name

    @property
    def is_active(self) -> bool:
        return self.query.isActive

    @property
    def status(self) -> dict:
        return self.query.status

    def process_all(self) -> None:
        """Block until all rows that are there now are processed. Not for a source that never runs dry."""
        self.query.processAllAvailable()

    def wait(self, seconds: float | None = None) -> bool:
        """Wait for the query to end; with ``seconds``, tell whether it did. Raises if it failed."""
        if seconds is None:
            self.query.awaitTermination()
            ended = True
        else:
            ended = self.query.awaitTermination(seconds)
        if ended:
            self._log.close(self.query)
        return ended

    def stop(self) -> None:
        self.query.stop()
        self._log.close(self.query)

    def finish(self, rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Add to the table what the step still holds back, as no more rows will come, and return the table.

        In ``append`` mode a window is given out once the watermark has passed it, so the last ones never are. They are
        taken from the state store as the last batch left it: ``rows`` turns its ``key`` and ``value`` into rows of the table, for a
        window count :func:`open_window_counts`. Late rows are in no state, so they stay out as before.

        The step must have ended, with its last batch committed; rows that the source has and the step did not take are not
        counted. It must keep the state of one aggregate. A finished table takes no more runs. After a failure :meth:`finish` can be called
        again; once it has succeeded it does nothing. A step that never had a row gives none.
        """
        if self.is_active:
            raise RuntimeError(f"step {self.step_id!r} is running; stop it first")
        if self.sink.finished(self.spark):
            return self.table()
        begun, ended = (self._batches(log) for log in ("offsets", "commits"))
        if begun != ended:
            raise RuntimeError(f"the last batch of step {self.step_id!r} was not committed; run the step to its end first")
        if ended < 0:
            self.sink.finish(self.spark.createDataFrame([], self.sink.schema))
            return self.table()
        kept = self.spark.read.format("state-metadata").load(self._checkpoint).select("operatorName").collect()
        if [row[0] for row in kept] != ["stateStoreSave"]:
            raise TypeError(f"step {self.step_id!r} does not keep the state of one aggregate")
        self.sink.finish(rows(self.spark.read.format("statestore").load(self._checkpoint)))
        return self.table()

    def _batches(self, log: str) -> int:
        """The number of the last batch in a log of the checkpoint, -1 if there is none."""
        names = file_names(self.spark, f"{self._checkpoint}/{log}")
        return max((int(name) for name in names if name.isdecimal()), default=-1)

    def table(self, as_of: str | None = None) -> DataFrame:
        """The result so far, planned anew at each call, so it shows rows that came since the last one; or that of a named snapshot."""
        return self.sink.table(self.spark, None if as_of is None else self.sink.pinned(self.spark, as_of))

    def view(self) -> DataFrame:
        """Register the result so far as a view named after the step, for SQL text, and return it."""
        now = self.table()
        if not isinstance(self.sink, MemorySink):  # Spark has named that one already
            now.createOrReplaceTempView(f"`{self.step_id}`")
        return now

    def snapshot(self, name: str | None = None) -> DataFrame:
        """The result as it is now, which later rows do not change, without a copy of its rows.

        The files or parts that it consists of are listed under ``name`` beside the table and not removed before
        :meth:`release`. ``table(as_of=name)`` shows it again, in later sessions too. A table in memory has no files, so its rows are copied.
        """
        if self.sink.path is None:
            path, now = new_dir(self.spark, "snapshot"), self.table()
            now.write.parquet(path)
            return self.spark.read.schema(now.schema).parquet(path)
        version = self.sink.version(self.spark)
        self.sink.pin(self.spark, name or uuid.uuid4().hex, version)
        return self.sink.table(self.spark, version)

    def release(self, name: str) -> None:
        """Forget a snapshot; what only it consists of may then be removed."""
        self.sink.unpin(self.spark, name)

    def progress(self) -> DataFrame:
        """Rows read per micro-batch and source, from the progress reports of all runs on this table.

        ``late_groups_dropped`` counts what the watermark dropped after partial
        aggregation; it is not a count of input rows. Reports are kept in files beside the table. Of a sink without a path they
        are those of this run alone, which the session keeps, and it raises if there are too many for that.
        """
        return self._log.reports(self.query)


def run_step(
    df: DataFrame,
    step_id: str,
    sink: Sink,
    mode: str = "append",
    trigger: str | None = None,
    checkpoint: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> StepHandle:
    """Start a streaming DataFrame under ``step_id`` and return its handle.

    ``trigger`` is an interval (``"3 seconds"``), :data:`AVAILABLE_NOW` to process
    what is there and end, or ``None`` to start each micro-batch when the last one
    is done. A run with the ``checkpoint`` of an earlier one goes on where that ended. By default a
    sink that keeps files has its own, so a step that starts again on its table takes new rows only.
    A second run on the table of a ``foreachBatch`` sink, from any session, takes it over: the first fails at its next batch.
    A batch that it has begun to write is not stopped, and may meet one of the second run in the same folder; stop the first
    where it can be reached. ``conf`` holds session settings for this query alone, e.g. :data:`ROCKSDB_STATE`.
    """
    if mode not in OUTPUT_MODES:
        raise ValueError(f"mode must be one of {', '.join(OUTPUT_MODES)}, not {mode!r}")
    spark = df.sparkSession
    if any(q.name == step_id for q in spark.streams.active):
        raise ValueError(f"step {step_id!r} is already running")
    if sink.finished(spark):
        raise ValueError(f"the table of step {step_id!r} is finished")
    sink.bind(step_id)
    if sink.leased:
        sink.take_over(spark)
    writer = sink.attach(df.writeStream.queryName(step_id).outputMode(mode))
    if checkpoint is not None or sink.recoverable:
        checkpoint = checkpoint or sink.checkpoint or new_dir(spark, "checkpoint")
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger == AVAILABLE_NOW:
        writer = writer.trigger(availableNow=True)
    elif trigger is not None:
        writer = writer.trigger(processingTime=trigger)
    log = ProgressLog(spark, step_id, sink.path and f"{sink.path.rstrip('/')}-progress")
    with _settings(spark, conf or {}):  # a query keeps the settings it was started with
        try:
            return StepHandle(writer.start(), sink, df, log, checkpoint)
        except BaseException:
            log.close()
            raise


@contextlib.contextmanager
def _settings(spark, conf):
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)

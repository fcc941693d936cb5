"""Progress reports of a step, kept for as long as its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from stepstream.workspace import file_names, write_text

# The fields of Spark's report that are read.
_REPORT = (
    "name STRING, runId STRING, batchId BIGINT, timestamp STRING, "
    "sources ARRAY<STRUCT<description: STRING, numInputRows: BIGINT>>, "
    "stateOperators ARRAY<STRUCT<numRowsDroppedByWatermark: BIGINT>>"
)


class ProgressLog(StreamingQueryListener):
    """Writes each report of a step to a file of its own, named so that a report that comes again replaces itself.

    Spark tells a listener of every report, while the query itself remembers the last hundred only. It tells so a little later, so what the
    query remembers is written as well when reports are asked for, and at the end.
    """

    def __init__(self, spark: SparkSession, step_id: str, path: str | None):
        self.spark, self.step_id, self.path = spark, step_id, path
        self._kept: set[str] = set()
        self._open = path is not None
        if self._open:
            spark.streams.addListener(self)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        if event.progress.name == self.step_id:
            self._keep(event.progress)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def _keep(self, report) -> None:
        moment = "".join(c for c in report.timestamp if c.isdigit())
        name = f"{report.batchId:012d}-{moment}-{report.runId}.json"
        if name not in self._kept:
            write_text(self.spark, f"{self.path}/{name}", report.json.replace("\n", " "))
            self._kept.add(name)

    def close(self, query: StreamingQuery | None = None) -> None:
        """Write what is still to be written, and listen no longer."""
        if self._open:
            self._open = False
            for report in query.recentProgress if query else ():
                self._keep(report)
            self.spark.streams.removeListener(self)

    def reports(self, query: StreamingQuery) -> DataFrame:
        """``step_id, batch_id, started, source, num_input_rows, late_groups_dropped`` of each report and source."""
        recent = query.recentProgress
        if self.path is None:
            most = int(self.spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))
            if len(recent) >= most - 1:  # Spark makes room before it adds one
                raise RuntimeError("reports may have been dropped; raise spark.sql.streaming.numRecentProgressUpdates")
            lines = self.spark.createDataFrame([(report.json,) for report in recent], "value STRING")
            found = lines.select(F.from_json("value", _REPORT).alias("r")).select("r.*")
        else:
            for report in recent:
                self._keep(report)
            if file_names(self.spark, self.path):
                found = self.spark.read.schema(_REPORT).json(self.path)
            else:
                found = self.spark.createDataFrame([], _REPORT)
        dropped = F.aggregate("stateOperators", F.lit(0).cast("bigint"), lambda a, s: a + s["numRowsDroppedByWatermark"])
        rows = found.select("name", "batchId", "timestamp", dropped.alias("dropped"), F.explode("sources").alias("source"))
        return rows.select(
            F.col("name").alias("step_id"),
            F.col("batchId").alias("batch_id"),
            F.col("timestamp").alias("started"),
            F.col("source.description").alias("source"),
            F.col("source.numInputRows").alias("num_input_rows"),
            F.col("dropped").alias("late_groups_dropped"),
        )

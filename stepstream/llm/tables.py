"""Tables that a job keeps on the way, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stepstream.workspace import new_dir


def settled(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once to the folder of ``spark.checkpoint.dir`` and read from there.

    What follows no longer depends on the executors that made them, and Spark can
    remove the files once nothing refers to them. A session without that setting
    (a test) gets a folder of its own first.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(new_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)

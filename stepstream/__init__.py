"""Step-based analytics over Spark tables and streams.

A *step* is a function ``DataFrame -> DataFrame``. Rows are described at run
time by names, types and values; steps are chained over them; and the same step
runs on a batch table or on a Structured Streaming source.
"""

from stepstream.schema import StepSchema
from stepstream.streaming.handle import StepHandle, run_step

__all__ = ["StepHandle", "StepSchema", "run_step"]

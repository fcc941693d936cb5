from stepstream.streaming.handle import StepHandle, run_step
from stepstream.streaming.late import LateRowsSink
from stepstream.streaming.previous import PreviousSink, previous_in_state
from stepstream.streaming.sinks import (
    BatchSink,
    CompleteSink,
    ConsoleSink,
    FileSink,
    MemorySink,
    UpsertSink,
    read_json,
    write_json,
)

__all__ = [
    "BatchSink",
    "CompleteSink",
    "ConsoleSink",
    "FileSink",
    "LateRowsSink",
    "MemorySink",
    "PreviousSink",
    "StepHandle",
    "UpsertSink",
    "previous_in_state",
    "read_json",
    "run_step",
    "write_json",
]

"""Rows appended to a directory and read back as a stream."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stepstream.schema import MAP_ROW, StepSchema
from stepstream.workspace import committed_names, file_names, move_files, remove, write_text


class RowLanding:
    """Append-only directory of files that feeds a live step.

    With a :class:`StepSchema` the rows are string maps and :meth:`add_row` takes
    their values; with a ``StructType`` they are typed records, or lines if it is
    one string column and ``file_format`` is ``text``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StepSchema | T.StructType,
        file_format: str = "parquet",
    ):
        self.spark = spark
        self.path = path
        self.file_format = file_format
        self.step_schema = schema if isinstance(schema, StepSchema) else None
        self.schema = MAP_ROW if self.step_schema else schema
        # Beside the landing, as the stream reads all that lies in it.
        self.staged, self.landed = (f"{path.rstrip('/')}-{kind}" for kind in ("staged", "landed"))

    def add_rows(self, rows: DataFrame | Iterable, key: str | None = None) -> None:
        """Append a DataFrame of any size, or a few rows that the driver holds, as one write.

        With ``key`` the rows land once, however often the call is repeated with it, also after a failure in the middle
        of it: they are written beside the landing, their files move in once all are written, and a marker
        named after the key ends it. The rows of the first call that wrote them all are those that land. One caller at a time may use a key.
        """
        if not isinstance(rows, DataFrame):
            rows = self._local_rows(rows)
        rows = rows.select(*self.schema.names)
        if key is None:
            rows.write.mode("append").format(self.file_format).save(self.path)
        elif re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", key):
            self._add_once(rows, key)
        else:
            raise ValueError(f"a key consists of letters, digits and the signs _.-, not {key!r}")

    def _add_once(self, rows: DataFrame, key: str) -> None:
        staged = f"{self.staged}/{key}"
        if key not in file_names(self.spark, self.landed):
            if not committed_names(self.spark, self.staged, key):
                rows.write.mode("overwrite").format(self.file_format).save(staged)
            move_files(self.spark, staged, self.path, f"{key}-")
            write_text(self.spark, f"{self.landed}/{key}", "")
        remove(self.spark, staged)

    def add_row(self, values: Sequence[str | None] | None = None) -> None:
        """Append one row, by default that of the step schema. Each call writes a file."""
        if self.step_schema is None:
            if values is None:
                raise ValueError("a landing of typed records has no default row")
            self.add_rows([tuple(values)])
        else:
            self.add_rows([values])

    def _local_rows(self, rows: Iterable) -> DataFrame:
        if self.step_schema:
            rows = [(self.step_schema.row_map(values),) for values in rows]
        return self.spark.createDataFrame(list(rows), self.schema).coalesce(1)

    def stream(self, files_per_batch: int | None = None, **options) -> DataFrame:
        """Rows that have landed and those to come. ``files_per_batch`` bounds a micro-batch.

        ``options`` are those of Spark's file source, e.g. ``maxBytesPerTrigger`` or
        ``cleanSource`` to keep the directory small.
        """
        nothing = self.spark.createDataFrame([], self.schema)
        # The source needs the directory to exist.
        nothing.write.mode("ignore").format(self.file_format).save(self.path)
        reader = self.spark.readStream.schema(self.schema).format(self.file_format)
        reader = reader.options(**options)
        if files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.load(self.path)

    def table(self) -> DataFrame:
        return self.spark.read.schema(self.schema).format(self.file_format).load(self.path)


class BatchQueue:
    """Queued DataFrames, of which exactly one makes up each micro-batch.

    Queueing costs nothing: a DataFrame is a plan. A batch lands as any number of
    files, written and read in parallel, and is run before the next one lands, so
    its bounds do not depend on file times or sizes.
    """

    def __init__(self, landing: RowLanding):
        self.landing = landing
        self._waiting: deque[DataFrame] = deque()
        self._landed = False

    def put(self, batch: DataFrame) -> None:
        self._waiting.append(batch)

    def __len__(self) -> int:
        return len(self._waiting)

    def drain(self, run_pending: Callable[[], object]) -> list:
        """Land the batches one by one, calling ``run_pending`` for each, and return its results.

        If it raises, the batch stays queued; the next call runs it without landing it again.
        """
        results = []
        while self._waiting:
            if not self._landed:
                self.landing.add_rows(self._waiting[0])
                self._landed = True
            results.append(run_pending())
            self._waiting.popleft()
            self._landed = False
        return results

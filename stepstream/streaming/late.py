"""Rows that come behind the watermark, kept as a table of their own."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepstream.functions.time import duration_micros, epoch_micros
from stepstream.streaming.sinks import BATCH_ID, BatchSink, _read_parts, _sized
from stepstream.workspace import committed_parts, remove

LATE = "late"
_GREATEST = "greatest"


class LateRowsSink(BatchSink):
    """All rows of a stream, split into those in time and those too late for a tumbling window.

    Spark drops late rows inside an aggregate and counts no more than groups. Here a row is ``late`` if its window of
    ``duration`` ended at or before the watermark: the greatest ``ts`` of all batches before its own, less ``delay``.
    That is what :func:`window_count` drops with the same settings if each batch is run to its end before the next one comes; within one
    run over many batches Spark may lag one batch behind and keep more. A row without a time is never late. An empty
    batch leaves the watermark where it is.

    The stream goes in as it is, in ``append`` mode. A batch takes one pass, and one over ``ts`` of what it wrote. The greatest
    time so far, one value, is kept per batch in the checkpoint, so a batch that is replayed finds the one
    that it was judged by; all but the last two are removed. Rows lie in a folder for each of both kinds, so reading one skips the other.
    """

    def __init__(self, path: str, schema: T.StructType, ts: str, duration: str, delay: str):
        if LATE in schema.names:
            raise ValueError(f"a column is named {LATE!r} already")
        super().__init__(path, T.StructType([*schema.fields, T.StructField(LATE, T.BooleanType())]), lambda batch: batch)
        self.ts, self.duration, self.delay = ts, duration, delay

    @property
    def _marks(self) -> str:
        return f"{self.checkpoint}/marks"

    def _mark_before(self, spark, batch_id: int) -> int | None:
        earlier = [i for i in committed_parts(spark, self._marks, BATCH_ID) if i < batch_id]
        if not earlier:
            return None
        return spark.read.schema(f"{_GREATEST} bigint").parquet(f"{self._marks}/{BATCH_ID}={earlier[-1]}").first()[0]

    def _judged(self, batch, greatest: int | None):
        us, span = epoch_micros(batch, self.ts), duration_micros(self.duration)
        window_end = us - F.pmod(us, span) + span
        watermark = F.lit(greatest).cast("bigint") - duration_micros(self.delay)
        return batch.withColumn(LATE, F.coalesce(window_end <= watermark, F.lit(False)))

    def write_batch(self, batch, batch_id):
        spark = batch.sparkSession
        before = self._mark_before(spark, batch_id)
        place = f"{self.path}/{BATCH_ID}={batch_id}"
        _sized(self._judged(batch, before)).write.mode("overwrite").partitionBy(LATE).parquet(place)
        written = _read_parts(spark, self.path, self.schema, [batch_id])
        known = F.lit(before).cast("bigint")
        greatest = written.agg(F.greatest(F.max(epoch_micros(written, self.ts)), known).alias(_GREATEST))
        greatest.write.mode("overwrite").parquet(f"{self._marks}/{BATCH_ID}={batch_id}")
        for i in committed_parts(spark, self._marks, BATCH_ID):
            if i < batch_id - 1:
                remove(spark, f"{self._marks}/{BATCH_ID}={i}")

    def late(self, spark):
        return self.table(spark).where(LATE)

    def kept(self, spark):
        return self.table(spark).where(~F.col(LATE))

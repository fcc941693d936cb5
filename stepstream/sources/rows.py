"""Generated rows, batch and streaming. Spark makes them in the tasks; the driver holds none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepstream.schema import StepSchema


def generate_rows(
    spark: SparkSession,
    schema: StepSchema,
    n: int,
    id_column: str | None = None,
    partitions: int | None = None,
    mode: str = "permissive",
) -> DataFrame:
    """``n`` copies of the default row, optionally numbered from 0 in ``id_column``."""
    numbered = spark.range(0, n, 1, partitions)
    ids = [F.col("id").alias(id_column)] if id_column else []
    return numbered.select(*ids, *schema.default_columns(mode))


def generate_rows_stream(
    spark: SparkSession,
    schema: StepSchema,
    rows_per_batch: int,
    start_ms: int = 0,
    advance_ms: int = 1000,
    partitions: int | None = None,
    mode: str = "permissive",
) -> DataFrame:
    """The default row over and over, ``rows_per_batch`` per micro-batch, with its ``timestamp``.

    The source never runs dry: bound the query by time, not by ``process_all``.
    """
    reader = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("startTimestamp", start_ms)
        .option("advanceMillisPerBatch", advance_ms)
    )
    if partitions is not None:
        reader = reader.option("numPartitions", partitions)
    return reader.load().select("timestamp", *schema.default_columns(mode))


def int_range(
    spark: SparkSession, first: int, last: int, slices: int | None = None, name: str = "x"
) -> DataFrame:
    """The integers ``first..last``, both included, in ``slices`` partitions."""
    return spark.range(first, last + 1, 1, slices).select(F.col("id").alias(name))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A few rows that the driver already holds, as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)

"""Stored tables as batch input or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``<folder>/<name>.parquet``, a file or a directory of files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(
    spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None, **options
) -> DataFrame:
    """The same table as a stream over its own files, without copying them.

    ``files_per_batch`` bounds a micro-batch; without it all new files make one.
    ``options`` are those of Spark's file source.
    """
    reader = spark.readStream.schema(read_table(spark, folder, name).schema).options(**options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # The bracket makes a glob of the path: the file source takes a lone file only through one.
    return reader.parquet(f"{folder}/{name}.parque[t]")

"""Where steps put landing files, checkpoints and results.

Files are looked up and removed through the JVM's file systems, which a Spark Connect session does not offer.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="stepstream-")


def new_dir(spark: SparkSession, label: str) -> str:
    """Path of a fresh directory in the shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a temporary
    folder; on a cluster every executor must see the files, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, which may be any that Spark writes to, and the path in its terms."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it; it need not exist."""
    files, there = _hadoop(spark, path)
    files.delete(there, True)


def committed_names(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """The names of the folders in ``path`` that fit ``pattern`` and whose write has been committed.

    Spark puts a ``_SUCCESS`` file into a folder once all of its files are in place.
    """
    files, found = _hadoop(spark, f"{path}/{pattern}/_SUCCESS")
    return sorted(status.getPath().getParent().getName() for status in files.globStatus(found) or [])


def committed_parts(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers n, in order, of the folders ``<path>/<name>=n`` whose write has been committed."""
    return sorted(int(found.split("=")[1]) for found in committed_names(spark, path, f"{name}=*"))


def file_names(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder, which need not exist."""
    files, found = _hadoop(spark, f"{path}/*")
    return sorted(status.getPath().getName() for status in files.globStatus(found) or [])


def move_files(spark: SparkSession, source: str, target: str, prefix: str) -> None:
    """Move the data files of a folder to another one. Called again after a failure, it moves what is left."""
    files, found = _hadoop(spark, f"{source}/*")
    into = spark._jvm.org.apache.hadoop.fs.Path
    files.mkdirs(into(target))
    for status in files.globStatus(found) or []:
        here = status.getPath()
        there = into(f"{target}/{prefix}{here.getName()}")
        if here.getName().startswith(("_", ".")):
            continue
        if files.exists(there):  # a store that copies was stopped before it removed the source
            files.delete(here, False)
        elif not files.rename(here, there):
            raise OSError(f"cannot move {here} to {there}")


def claim(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if it is there already."""
    files, there = _hadoop(spark, path)
    return files.createNewFile(there)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole, in place of any that is there."""
    files, there = _hadoop(spark, path)
    out = files.create(there, True)
    try:
        out.write(text.encode())
    finally:
        out.close()

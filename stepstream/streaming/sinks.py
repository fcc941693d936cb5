"""Sinks of a step and the tables they fill.

Sinks built on ``foreachBatch`` write a batch to a place that its id alone
decides, so a batch that is replayed after a failure replaces its own output. Readers
see a batch once its write has been committed, and not before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from stepstream.workspace import claim, committed_names, committed_parts, file_names, remove, write_text

BATCH_ID = "batch_id"
BASE = -1  # stands below all batches
FAN = 8  # parts of an update log that are merged into one of the next level
_MERGED = "merged"
_LAST = "last"
NTZ_MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
TIMESTAMP_MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


class Sink:
    recoverable = True
    path: str | None = None
    leased = False  # whether batches are written by functions of ours, which Spark does not keep from meeting those of another run
    _checkpoint: str | None = None

    @property
    def checkpoint(self) -> str | None:
        """Where a step that writes here keeps how far it has come: beside the table, so a restart goes on."""
        return self._checkpoint or (self.path and f"{self.path.rstrip('/')}-checkpoint")

    def bind(self, step_id: str) -> None:
        """Called with the id of the step that is about to write here."""

    def attach(self, writer: DataStreamWriter) -> DataStreamWriter:
        raise NotImplementedError

    def table(self, spark: SparkSession, version: Sequence[str] | None = None) -> DataFrame:
        """The result so far, or as it was when :meth:`version` gave ``version``."""
        raise NotImplementedError

    def version(self, spark: SparkSession) -> list[str]:
        """Names of what the table consists of now. Files and parts of a table are never changed, only added and removed."""
        raise TypeError(f"a {type(self).__name__} keeps no versions")

    def take_over(self, spark: SparkSession) -> None:
        """Number the run that is about to start. Batches of earlier runs on the table, in any session, are refused from then on."""
        number = max(self._leases(spark), default=0) + 1
        while not claim(spark, f"{self._lease_folder}/{number}"):  # another session was faster
            number += 1
        self._lease = number
        for older in self._leases(spark):
            if older < number:
                remove(spark, f"{self._lease_folder}/{older}")

    @property
    def _lease_folder(self) -> str:
        return f"{self.path.rstrip('/')}-leases"

    def _leases(self, spark) -> list[int]:
        return [int(name) for name in file_names(spark, self._lease_folder) if name.isdecimal()]

    def _fenced(self, write):
        """``write`` for the batches of this run, as long as no later one has taken the table over."""
        lease = self._lease

        def write_if_last(batch, batch_id):
            if max(self._leases(batch.sparkSession), default=0) != lease:
                raise RuntimeError(f"a later run has taken over {self.path}; batch {batch_id} is not written")
            write(batch, batch_id)

        return write_if_last

    def finished(self, spark: SparkSession) -> bool:
        """Whether :meth:`finish` has ended the table."""
        return False

    def finish(self, rows: DataFrame) -> None:
        """Add the last rows to the table, all or none. Called again, it replaces what it added."""
        raise TypeError(f"the table of a {type(self).__name__} has no end")

    @property
    def _pins(self) -> str:
        return f"{self.path.rstrip('/')}-snapshots"

    def pin(self, spark: SparkSession, name: str, version: Sequence[str]) -> None:
        """Keep ``version`` under ``name``: what it consists of is not removed until :meth:`unpin`."""
        write_text(spark, f"{self._pins}/{name}", "".join(f"{part}\n" for part in version))

    def unpin(self, spark: SparkSession, name: str) -> None:
        remove(spark, f"{self._pins}/{name}")

    def pinned(self, spark: SparkSession, name: str | None = None) -> list[str]:
        """The version kept under ``name``, or all that any name keeps."""
        kept = file_names(spark, self._pins)
        if name is not None and name not in kept:
            raise KeyError(f"no snapshot {name!r}")
        if not kept:
            return []
        return [row[0] for row in spark.read.text(f"{self._pins}/{name or '*'}").collect()]


class MemorySink(Sink):
    """In-memory table named after the step. The driver holds it whole: for tests and small results."""

    recoverable = False

    def __init__(self):
        self.step_id: str | None = None

    def bind(self, step_id):
        self.step_id = step_id

    def attach(self, writer):
        return writer.format("memory")

    def table(self, spark, version=None):
        return spark.table(f"`{self.step_id}`")


class ConsoleSink(Sink):
    """Prints each batch, up to ``rows`` rows, for people to read."""

    recoverable = False

    def __init__(self, rows: int = 20, truncate: bool = True):
        self.rows = rows
        self.truncate = truncate

    def attach(self, writer):
        return (
            writer.format("console").option("numRows", self.rows).option("truncate", self.truncate)
        )

    def table(self, spark, version=None):
        raise TypeError("a console sink keeps no table")


class FileSink(Sink):
    """Appends to files, exactly once per row: the table of an ``append`` step at any size.

    Spark lists the files of its batches in a log of its own, so the rows that end the table lie in a folder beside them.
    """

    def __init__(self, path: str, schema: T.StructType, file_format: str = "parquet"):
        self.path = path
        self.schema = schema
        self.file_format = file_format
        self.options = {**NTZ_MICROS, **TIMESTAMP_MICROS} if file_format == "json" else {}

    def attach(self, writer):
        return writer.format(self.file_format).options(**self.options).option("path", self.path)

    def table(self, spark, version=None):
        reader = spark.read.schema(self.schema).format(self.file_format).options(**self.options)
        if version is not None:
            return reader.load(list(version)) if version else spark.createDataFrame([], self.schema)
        rows = reader.load(self.path)
        return rows.unionByName(reader.load(f"{self._end}/{_LAST}")) if self.finished(spark) else rows

    def version(self, spark):
        return sorted(self.table(spark).inputFiles())

    @property
    def _end(self) -> str:
        return f"{self.path.rstrip('/')}-end"

    def finished(self, spark):
        return bool(committed_names(spark, self._end, _LAST))

    def finish(self, rows):
        typed = rows.select(*(F.col(field.name).cast(field.dataType) for field in self.schema))
        typed.write.format(self.file_format).options(**self.options).mode("overwrite").save(f"{self._end}/{_LAST}")


class BatchSink(Sink):
    """Runs a step on every micro-batch alone and keeps its result with the ``batch_id``."""

    leased = True

    def __init__(self, path: str, schema: T.StructType, step: Callable[[DataFrame], DataFrame]):
        self.path = path
        self.schema = schema
        self.step = step

    def attach(self, writer):
        return writer.foreachBatch(self._fenced(self.write_batch))

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        place = f"{self.path}/{BATCH_ID}={batch_id}"
        _sized(self.step(batch)).write.mode("overwrite").parquet(place)

    def version(self, spark):
        return [f"{BATCH_ID}={i}" for i in committed_parts(spark, self.path, BATCH_ID)]

    def table(self, spark, version=None):
        parts = self.version(spark) if version is None else version
        return _read_parts(spark, self.path, self.schema, [int(part.split("=")[1]) for part in parts])


class UpsertSink(BatchSink):
    """The newest version of each key, for ``update`` mode.

    A batch writes only the keys it changed, as a part of its own; :meth:`table` takes for each key the
    values of its last batch. Parts are merged in levels while the step runs: every 8th batch writes the newest versions of
    the last 8 batches as one part, every 64th those of the last 64, and so on, so a table of n batches has some
    8 log(n) parts and a row is written again log(n) times. A part that lies in a merged one is not read any more. It is
    removed 8 batches later, so a batch that is replayed finds what it merges, and a reader can end; or later, if a snapshot has it.
    """

    def __init__(self, path: str, schema: T.StructType, keys: Sequence[str]):
        super().__init__(path, schema, lambda batch: batch)
        self.keys = list(keys)

    def _newest(self, log: DataFrame, *extra) -> DataFrame:
        rest = [n for n in self.schema.names if n not in self.keys]
        if len(rest) == 1:
            newest = F.max_by(rest[0], BATCH_ID).alias(rest[0])
            return log.groupBy(*self.keys).agg(newest, *extra)
        newest = F.max_by(F.struct(*rest), BATCH_ID).alias("newest")
        return (
            log.groupBy(*self.keys)
            .agg(newest, *extra)
            .withColumns({n: F.col("newest")[n] for n in rest})
            .drop("newest")
        )

    def write_batch(self, batch, batch_id):
        super().write_batch(batch, batch_id)
        if batch_id > BASE:
            self._merge(batch.sparkSession, batch_id)
            self._remove_merged(batch.sparkSession, batch_id)

    def _parts(self, spark) -> list[tuple[int, int, str]]:
        """First and last batch, and the name, of all committed parts, in order; of those that begin alike the widest first."""
        single = [(i, i, f"{BATCH_ID}={i}") for i in committed_parts(spark, self.path, BATCH_ID)]
        merged = [(*map(int, name.split("=")[1].split("-")), name) for name in committed_names(spark, self.path, f"{_MERGED}=*")]
        return sorted(single + merged, key=lambda part: (part[0], -part[1]))

    @staticmethod
    def _live(parts):
        """Those that lie in no other."""
        live, reach = [], BASE - 1
        for part in parts:
            if part[1] > reach:
                live.append(part)
                reach = part[1]
        return live

    def _merge(self, spark, batch_id):
        """At the end of a level, the newest versions of all its batches as one part."""
        span = 1
        while (batch_id + 1) % (span * FAN) == 0:
            span *= FAN
        first = batch_id + 1 - span
        merged = f"{_MERGED}={first}-{batch_id}"  # a replay finds the one of its first run, and replaces it
        others = [part for part in self._parts(spark) if part[2] != merged]
        inside = [name for a, b, name in self._live(others) if first <= a and b <= batch_id]
        if len(inside) > 1:
            newest = self._newest(self._log(spark, inside), F.max(BATCH_ID).alias(BATCH_ID))
            _sized(newest.select(*self.schema.names, BATCH_ID)).write.mode("overwrite").parquet(f"{self.path}/{merged}")

    def _remove_merged(self, spark, batch_id):
        parts = self._parts(spark)
        live = {name for *_, name in self._live(parts)}
        old = [part for part in parts if part[2] not in live and part[1] < batch_id - FAN]
        old = [part for part in old if any(a <= part[0] and part[1] <= b < batch_id - FAN for a, b, name in parts if name != part[2])]
        if old:
            pinned = set(self.pinned(spark))
            for *_, name in old:
                if name not in pinned:
                    remove(spark, f"{self.path}/{name}")

    def _log(self, spark, names):
        """The rows of parts with their ``batch_id``."""
        log = _read_parts(spark, self.path, self.schema, [int(n.split("=")[1]) for n in names if n.startswith(BATCH_ID)])
        merged = [f"{self.path}/{name}" for name in names if name.startswith(_MERGED)]
        return log.unionByName(spark.read.schema(log.schema).parquet(*merged)) if merged else log

    def version(self, spark):
        return [name for *_, name in self._live(self._parts(spark))]

    def table(self, spark, version=None):
        log = self._log(spark, self.version(spark) if version is None else version)
        return self._newest(log).select(*self.schema.names)

    def compact(self, spark: SparkSession, path: str) -> UpsertSink:
        """Write the newest versions to ``path`` as one part and return a sink there for the next run of the step.

        Call it between runs. They stand below all batches, so a batch that is replayed replaces
        its own rows only. The new sink goes on from the checkpoint of this one. The log as
        it was stays in place until its owner removes it.
        """
        folded = UpsertSink(path, self.schema, self.keys)
        folded._checkpoint = self.checkpoint
        folded.write_batch(self.table(spark), BASE)
        return folded


class CompleteSink(Sink):
    """The whole result of the last batch, for ``complete`` mode.

    The last ``versions`` results are kept, so a reader of the last one is not disturbed by the next.
    """

    leased = True

    def __init__(self, path: str, schema: T.StructType, versions: int = 2):
        if versions < 2:
            raise ValueError("at least two versions are needed")
        self.path = path
        self.schema = schema
        self.versions = versions

    def attach(self, writer):
        return writer.foreachBatch(self._fenced(self._write))

    def _write(self, batch, batch_id):
        spark = batch.sparkSession
        _sized(batch).write.mode("overwrite").parquet(f"{self.path}/{BATCH_ID}={batch_id}")
        old = committed_parts(spark, self.path, BATCH_ID)[: -self.versions]
        pinned = set(self.pinned(spark)) if old else ()
        for i in old:
            if f"{BATCH_ID}={i}" not in pinned:
                remove(spark, f"{self.path}/{BATCH_ID}={i}")

    def version(self, spark):
        return [f"{BATCH_ID}={i}" for i in committed_parts(spark, self.path, BATCH_ID)[-1:]]

    def table(self, spark, version=None):
        parts = self.version(spark) if version is None else version
        newest = [int(part.split("=")[1]) for part in parts]
        return _read_parts(spark, self.path, self.schema, newest).select(*self.schema.names)


def _sized(df):
    """At most one file per core, where a stateful step would write one per state partition.

    Spark runs stateful micro-batches without adaptive execution; where that is on, it sizes the files.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        return df
    return df.coalesce(max(1, spark.sparkContext.defaultParallelism))


def _read_parts(spark, path, schema, batch_ids):
    """The given batches of a sink with their ``batch_id``; an empty table when there are none."""
    full = T.StructType([*schema.fields, T.StructField(BATCH_ID, T.LongType())])
    if not batch_ids:
        return spark.createDataFrame([], full)
    places = [f"{path}/{BATCH_ID}={batch_id}" for batch_id in batch_ids]
    return spark.read.schema(full).option("basePath", path).parquet(*places)


def write_json(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with JSON lines that keep microseconds."""
    df.write.mode("overwrite").options(**NTZ_MICROS, **TIMESTAMP_MICROS).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**NTZ_MICROS, **TIMESTAMP_MICROS).json(path)

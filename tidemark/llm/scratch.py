"""Intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries inside drop their shuffle files as they end, instead of when the driver collects its garbage.

    For queries that run once: what they write is read from the shared folder afterwards.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


_recording: list[Scratch] = []


@contextmanager
def recorded(spark: SparkSession) -> Iterator[Scratch]:
    """Collects what operators leave in the shared folder for the frames they return.

    Drop it when these frames have been written; they cannot be read afterwards.
    """
    left = Scratch(spark)
    _recording.append(left)
    try:
        yield left
    finally:
        _recording.remove(left)


def _write(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, purpose)
    for left in _recording:
        left.paths.setdefault(purpose, []).append(path)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write the frame to a table in the shared folder and read it again: cuts lineage, survives executors."""
    return _write(df, purpose)[0]


class Scratch:
    """Intermediate tables by name, each deleted as soon as nothing reads it any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """As :func:`written`; an earlier table of the name stays until it is dropped."""
        out, path = _write(df, name)
        self.paths.setdefault(name, []).append(path)
        return out

    def drop(self, *names: str) -> None:
        """Delete the tables of these names; names that are not there, and tables already gone, are passed over."""
        for name in names:
            for folder in self.paths.pop(name, ()):
                path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def free(name: str, df: DataFrame) -> str:
    """The name for an internal column, or a longer one if the frame has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Rows of text that go to Python in one Arrow batch.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """Let texts go to Python in small batches, unless the session has a size of its own.

    Spark's 10 000 rows of a few kilobytes each are buffered on both sides of every task.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(key) == "10000":
        conf.set(key, str(BATCH_ROWS))
    return df

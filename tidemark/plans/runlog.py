"""The run log of load pipelines: an append-only table of run events."""

from __future__ import annotations

import datetime as dt
import time
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timebucket import EPOCH
from tidemark.sources.tables import Tables, quoted

LOG_TABLE = "pipeline_runs"
# The log's columns.
LOG_SCHEMA = (
    "run_id bigint, pipeline_name string, started_at timestamp, finished_at timestamp, "
    "status string, rows_extracted bigint, rows_transformed bigint, rows_loaded bigint, "
    "error_message string, error_traceback string, watermark_time timestamp, "
    "watermark_number bigint, watermark_text string, event_no int"
)
# A high-water mark has one of these columns.
MARKS = {dt.datetime: "watermark_time", int: "watermark_number", str: "watermark_text"}


class EtlError(RuntimeError):
    """A pipeline run failed."""


def mark_column(value: Any) -> str:
    """The log column that holds a mark of this type."""
    for kind, column in MARKS.items():
        if isinstance(value, kind) and not isinstance(value, bool):
            return column
    raise EtlError(f"a high-water mark cannot be a {type(value).__name__}")


def _literal(value: Any) -> Column:
    # timestamps as text with their offset, so that no local time zone gets in between
    return F.lit(value.isoformat() if isinstance(value, dt.datetime) else value)


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class RunLog:
    """Each run writes a ``running`` event and one final event; the newest event counts."""

    def __init__(self, tables: Tables, table: str = LOG_TABLE):
        self.tables, self.table = tables, table

    def init(self) -> None:
        """Create the log when it is missing."""
        if not self.tables.exists(self.table):
            empty = self.tables.spark.createDataFrame([], LOG_SCHEMA)
            self.tables.publish(empty, self.table)

    def _write(self, row: dict) -> None:
        fields = [part.split() for part in LOG_SCHEMA.split(", ")]
        event = self.tables.spark.range(0, 1, 1, 1).select(*[
            _literal(row.get(name)).cast(kind).alias(name) for name, kind in fields])
        event.write.insertInto(quoted(self.table))

    def start(self, pipeline: str) -> dict:
        run = {"run_id": time.time_ns(), "pipeline_name": pipeline, "started_at": utc_now(),
               "status": "running", "event_no": 0}
        self._write(run)
        return run

    def finish(self, run: dict, status: str, **fields: Any) -> dict:
        done = {**run, "finished_at": utc_now(), "status": status, "event_no": 1, **fields}
        self._write(done)
        return done

    def runs(self) -> DataFrame:
        """One row per run: its newest event."""
        log = self.tables.read(self.table)
        state = F.struct(*[c for c in log.columns if c not in ("run_id", "event_no")])
        return log.groupBy("run_id").agg(F.max_by(state, "event_no").alias("s")).select(
            "run_id", "s.*")

    def history(self, pipeline: str, limit: int = 100) -> DataFrame:
        """Newest runs first."""
        return self.runs().filter(F.col("pipeline_name") == pipeline).orderBy(
            F.desc("run_id")).limit(limit)

    def last_run(self, pipeline: str) -> DataFrame:
        """The newest run, or no row."""
        return self.history(pipeline, 1)

    def last_mark(self, pipeline: str) -> Any:
        """High-water mark of the newest successful run that recorded one.

        A time comes back as an instant in UTC.
        """
        columns = list(MARKS.values())
        newest = self.runs().filter(
            (F.col("pipeline_name") == pipeline) & (F.col("status") == "success")
            & F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()
        ).agg(F.max_by(F.struct(
            F.unix_micros("watermark_time").alias("watermark_time"), *columns[1:]), "run_id").alias("w")).first()["w"]
        if newest is None:
            return None
        if newest["watermark_time"] is not None:
            return EPOCH.replace(tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=newest["watermark_time"])
        return newest["watermark_number"] if newest["watermark_number"] is not None else newest["watermark_text"]

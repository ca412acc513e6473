"""Extract, transform, load: one source, one target, one pass.

Everything between source and target is one lazy plan with a staged write.  Counts and the
high-water mark are observed right at the write; only transforms need a count of their own.
"""

from __future__ import annotations

import datetime as dt
import re
import traceback
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timebucket import EPOCH, micros_of
from tidemark.operators import rows
from tidemark.operators.filters import newer_than
from tidemark.plans.runlog import EtlError, RunLog, mark_column, utc_now
from tidemark.sources.tables import Tables, Watch, quoted

# Load modes, and below the fields of a pipeline and of a result.
LOAD_MODES = ("append", "replace", "upsert")
Step = Callable[[DataFrame], DataFrame]


def pandas_step(fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> Step:
    """A transform step from a row-local pandas function, run batch by batch on executors."""
    def step(df: DataFrame) -> DataFrame:
        def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield fn(frame)
        return df.mapInPandas(batches, schema)
    step.__name__ = getattr(fn, "__name__", "pandas_step")
    return step


@dataclass(frozen=True)
class Pipeline:
    """Descriptor of a load.  ``source`` is a table name or a query."""

    name: str
    source: str
    target: str
    load_mode: str = "append"
    conflict_columns: tuple[str, ...] = ()
    transform: Step | tuple[Step, ...] | list[Step] | None = None
    extract_limit: int | None = None
    incremental_column: str | None = None

    def __post_init__(self):
        for label in ("name", "source", "target"):
            if not str(getattr(self, label) or "").strip():
                raise ValueError(f"{label} must not be empty")
        if isinstance(self.conflict_columns, str):
            raise ValueError("conflict_columns must be a list of names, not a single text")
        object.__setattr__(self, "conflict_columns", tuple(self.conflict_columns))
        if self.load_mode not in LOAD_MODES:
            raise ValueError(f"load_mode must be one of {', '.join(LOAD_MODES)}")
        if self.load_mode == "upsert" and not self.conflict_columns:
            raise ValueError("upsert needs conflict_columns")
        limit = self.extract_limit
        if limit is not None and (isinstance(limit, bool) or not isinstance(limit, int)
                                  or limit < 1):
            raise ValueError("extract_limit must be a positive integer")
        if self.incremental_column is not None and self.load_mode != "upsert":
            raise ValueError("incremental_column needs load_mode='upsert'")

    @property
    def steps(self) -> list[Step]:
        if self.transform is None:
            return []
        return [self.transform] if callable(self.transform) else list(self.transform)

    @property
    def source_is_query(self) -> bool:
        text = self.source.strip()
        return bool(re.search(r"\s", text)) or bool(re.match(r"(?i)(select|with)\b", text))


@dataclass(frozen=True)
class RunResult:
    """Outcome of a run.  ``rows_extracted`` counts source rows, before any transform."""

    pipeline_name: str
    status: str
    run_id: int | None
    rows_extracted: int
    rows_transformed: int
    rows_loaded: int
    started_at: dt.datetime
    finished_at: dt.datetime
    error: str | None = None
    watermark_used: Any = None
    watermark_recorded: Any = None


def transformed(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    """Apply the steps; a failing one is named with its position."""
    for number, step in enumerate(steps, start=1):
        label = getattr(step, "__name__", type(step).__name__)
        try:
            df = step(df)
        except Exception as error:
            raise EtlError(f"transform step {number} ({label}) failed: {error}") from error
        if not isinstance(df, DataFrame):
            raise EtlError(f"transform step {number} ({label}) did not return a DataFrame")
    return df


class Etl:
    """Runs pipelines over the tables of one folder."""

    def __init__(self, tables: Tables, log_table: str = "pipeline_runs"):
        self.tables, self.spark = tables, tables.spark
        self.log = RunLog(tables, log_table)

    # --- extract ------------------------------------------------------------------

    def extract(self, pipeline: Pipeline, mark: Any = None) -> DataFrame:
        """Source rows above the mark, then the limit.

        With a mark column, the limit counts rows in its order and takes every row that ties with
        the last one, so that what is left is above the mark that the run records.  Rows without a
        mark come with the first run only.  Without a mark column any rows will do.
        """
        if pipeline.source_is_query:
            df = self.spark.sql(re.sub(r";\s*$", "", pipeline.source.strip()))
        else:
            df = self.spark.table(quoted(pipeline.source.strip()))
        column = pipeline.incremental_column
        if column is not None:
            if column not in df.columns:
                raise EtlError(f"incremental column not in the source: {column}")
            _check_mark_type(df.schema[column])
            df = newer_than(df, column, mark)
            if pipeline.extract_limit:
                # only the mark column is ordered
                lowest = df.select(column).filter(F.col(column).isNotNull()).orderBy(column)
                last = lowest.limit(pipeline.extract_limit).agg(F.max(column).alias("last"))
                cut = F.broadcast(last)  # one row
                df = df.join(cut, F.col(column).isNull() | (F.col(column) <= F.col("last")), "left_semi")
            return df
        return df.limit(pipeline.extract_limit) if pipeline.extract_limit else df

    @staticmethod
    def _measures(df: DataFrame, column: str | None, counted: Column | None = None) -> dict:
        """Rows and largest mark; ``counted`` says which rows count."""
        one = F.lit(1) if counted is None else F.when(counted, 1)
        measures = {"n": F.count(one)}
        if column is not None:
            is_time = isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType))
            value = micros_of(F.col(column)) if is_time else F.col(column)
            measures["mark"] = F.max(value if counted is None else F.when(counted, value))
        return measures

    def _raw(self, df: DataFrame, column: str | None) -> dict:
        """Rows and largest mark of the source rows, by a query of their own.

        Counting while transforms run would count again whatever Spark reads twice, such as the
        sample of a sort, or repeats after a lost executor.  The query reads the mark column only.
        """
        return df.agg(*[c.alias(n) for n, c in self._measures(df, column).items()]).first().asDict()

    @staticmethod
    def _mark_of(value: Any, field: T.StructField | None) -> Any:
        if field is None or value is None:
            return None
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            moment = EPOCH + dt.timedelta(microseconds=value)
            if isinstance(field.dataType, T.TimestampType):
                return moment.replace(tzinfo=dt.timezone.utc)
            return moment
        return value

    # --- run ----------------------------------------------------------------------

    def run(self, pipeline: Pipeline, dry_run: bool = False) -> RunResult:
        """Run once.  A failure is logged and raised; the target is then unchanged."""
        if dry_run:
            return self._dry_run(pipeline)
        self.log.init()
        run = self.log.start(pipeline.name)
        try:
            outcome = self._load(pipeline)
        except Exception as error:
            self.log.finish(run, "failed", rows_extracted=0, rows_transformed=0, rows_loaded=0,
                            error_message=str(error), error_traceback=traceback.format_exc())
            raise
        mark = outcome["recorded"] if outcome["loaded"] else None
        done = self.log.finish(
            run, "success", rows_extracted=outcome["extracted"],
            rows_transformed=outcome["transformed"], rows_loaded=outcome["loaded"],
            **({} if mark is None else {mark_column(mark): mark}))
        return RunResult(
            pipeline.name, "success", run["run_id"], outcome["extracted"],
            outcome["transformed"], outcome["loaded"], run["started_at"], done["finished_at"],
            watermark_used=outcome["used"], watermark_recorded=mark)

    def _plan(self, pipeline: Pipeline, mark: Any):
        raw = self.extract(pipeline, mark)
        return raw, rows.nan_to_null(transformed(raw, pipeline.steps))

    def _load(self, pipeline: Pipeline) -> dict:
        """Measures are taken right at the write, above every shuffle, so repeats do not add up."""
        mark = self.log.last_mark(pipeline.name) if pipeline.incremental_column else None
        target, mode, column = pipeline.target, pipeline.load_mode, pipeline.incremental_column
        if mode != "replace" and not self.tables.exists(target):
            raise EtlError(f"target table does not exist: {target}")
        raw, ready = self._plan(pipeline, mark)
        if isinstance(mark, dt.datetime) and isinstance(raw.schema[column].dataType, T.TimestampNTZType):
            mark = mark.replace(tzinfo=None)
        found = self._raw(raw, column) if pipeline.steps else None
        try:
            written = self._write(pipeline, ready, column)
        except EtlError:
            raise
        except Exception as error:
            raise self._named(raw, pipeline.steps, error) from error
        found = found or written
        return {"extracted": found["n"] or 0, "transformed": written["n"] or 0, "loaded": written["n"] or 0,
                "used": mark, "recorded": self._mark_of(found.get("mark"), raw.schema[column] if column else None)}

    def _write(self, pipeline: Pipeline, ready: DataFrame, column: str | None) -> dict:
        target, mode = pipeline.target, pipeline.load_mode
        if mode == "append":
            return self.tables.append_watched(ready, target).get()
        if mode == "replace":
            result = ready
            if self.tables.exists(target):
                result = rows.align(ready, self.tables.read(target).schema)
            watch = Watch(result)
        else:
            keyed = self.tables.keyed(target)
            if keyed:
                measured = column if column in keyed.read().columns else None
                return keyed.upsert(ready, list(pipeline.conflict_columns),
                                    measured=self._measures(keyed.read(), measured, F.col("_changed")))
            if ready.isEmpty():
                return {"n": 0}
            merged = rows.upsert(self.tables.read(target), ready, list(pipeline.conflict_columns), mark="_changed")
            measured = column if column in merged.columns else None
            watch = Watch(merged, **self._measures(merged, measured, F.col("_changed")))
            result = merged.drop("_changed")
        path = self.tables.stage(watch.df.drop("_changed"), target)
        # an empty batch leaves the target as it is, even for replace
        if watch.n:
            self.tables.point_at(target, path, result)
        else:
            self.tables.discard(path)
        return watch.get()

    @staticmethod
    def _named(raw: DataFrame, steps: list[Step], error: Exception) -> Exception:
        """Steps are lazy, so a failing one shows when rows are written; find which it is."""
        for number in range(len(steps) + 1):
            try:
                transformed(raw, steps[:number]).write.format("noop").mode("overwrite").save()
            except EtlError as known:
                return known
            except Exception as cause:  # noqa: BLE001 - any error of the step itself
                if not number:
                    return error
                label = getattr(steps[number - 1], "__name__", type(steps[number - 1]).__name__)
                return EtlError(f"transform step {number} ({label}) failed: {cause}")
        return error

    def _dry_run(self, pipeline: Pipeline) -> RunResult:
        started = utc_now()
        mark = None
        if pipeline.incremental_column and self.tables.exists(self.log.table):
            mark = self.log.last_mark(pipeline.name)
        raw, ready = self._plan(pipeline, mark)
        watch = Watch(ready)
        watch.df.write.format("noop").mode("overwrite").save()
        extracted = self._raw(raw, None)["n"] if pipeline.steps else watch.n
        return RunResult(
            pipeline.name, "dry_run", None, extracted, watch.n, 0,
            started, utc_now(), watermark_used=mark)

    def history(self, name: str, limit: int = 100) -> DataFrame:
        return self.log.history(name, limit)

    def last_run(self, name: str) -> DataFrame:
        return self.log.last_run(name)


def _check_mark_type(field: T.StructField) -> None:
    allowed = (T.TimestampType, T.TimestampNTZType, T.IntegralType, T.StringType)
    if not isinstance(field.dataType, allowed):
        raise EtlError(
            f"incremental column {field.name} is {field.dataType.simpleString()}; "
            "it must be a timestamp, a whole number or text")


def batch_watermark(df: DataFrame, column: str) -> DataFrame:
    """One row with the largest value; NULL when there is none."""
    _check_mark_type(df.schema[column])
    return df.agg(F.max(column).alias("watermark"))

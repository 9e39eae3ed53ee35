"""Execution records: one per run, kept as an append-only table of events.

A run appends a ``running`` row, perhaps progress rows, and a closing row; the history shows the
last event of each id. Every event has a folder of its own, grouped by day, so that runs of
different tables can record at the same time; :meth:`ExecutionTable.compact` puts past days into one file
each. Failing to record never fails a load.
"""

from __future__ import annotations

import logging
import random
import uuid
from collections.abc import Mapping
from datetime import date, datetime, timedelta, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.storage import Storage

logger = logging.getLogger(__name__)

# Columns of the execution history, in order.
HISTORY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        *[
            T.StructField(name, T.StringType())
            for name in [
                "status",
                "schema_name",
                "name",
                "target_schema_name",
                "target_name",
                "mode",
                "source_type",
                "source_runtime",
                "target_type",
                "target_runtime",
                "strategy_type",
                "strategy_reference_column",
            ]
        ],
        T.StructField("strategy_lookback_periods", T.IntegerType()),
        T.StructField("partition_type", T.StringType()),
        T.StructField("partition_reference_column", T.StringType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("duration_seconds", T.DoubleType()),
    ]
)
_SEQUENCE = "event"
# Between the day and a unique ending in the name of a folder that holds a whole day.
_PACKED = "-packed-"
_EVENTS = T.StructType([*HISTORY.fields, T.StructField(_SEQUENCE, T.IntegerType())])


class ExecutionTable:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        self._root = f"{root.rstrip('/')}/executions"
        self._storage = Storage(spark, self._root)

    def start(self, **task_fields: Any) -> "Execution":
        """Open a record with status ``running``."""
        started = datetime.now(timezone.utc)
        # Time-ordered and unique without a counter that concurrent runs would fight over.
        number = int(started.timestamp() * 1_000_000) * 1000 + random.randrange(1000)
        execution = Execution(self, {"id": number, "started_at": started, "status": "running", **task_fields})
        execution.record()
        return execution

    def append(self, event: Mapping[str, Any]) -> None:
        row = self._spark.range(0, 1, 1, 1).select(
            *[F.lit(event.get(f.name)).cast(f.dataType).alias(f.name) for f in _EVENTS.fields]
        )
        day = event["started_at"].date().isoformat()
        row.write.mode("errorifexists").parquet(f"{self._root}/{day}/{event['id']}-{event[_SEQUENCE]}")

    def history(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """One row per run: its last event. ``first`` and ``last`` limit it to runs that started on these days (UTC)."""
        folders = self._folders(first, last)
        if not folders:
            return self._spark.createDataFrame([], HISTORY)
        events = self._events(folders)
        last_event = F.max_by(F.struct(*[c for c in HISTORY.names if c != "id"]), _SEQUENCE).alias("last")
        return events.groupBy("id").agg(last_event).select("id", "last.*")

    def compact(self, before: date) -> int:
        """Put the events of each day before ``before`` into one file. Returns the number of days written.

        A day's new file is complete before its old folders go, and an event that is there twice counts once, so a crash in
        between, or a run that is recorded meanwhile, loses and changes nothing.
        """
        days: dict[str, list[str]] = {}
        for folder in self._folders(None, before - timedelta(days=1)):
            days.setdefault(folder[:10], []).append(folder)
        open_days = {day: folders for day, folders in days.items() if folders != [f for f in folders if _PACKED in f][:1]}
        for day, folders in open_days.items():
            old = [path for folder in folders for path in ([folder] if _PACKED in folder else self._storage.glob(f"{folder}/*"))]
            self._events(old).dropDuplicates(["id", _SEQUENCE]).coalesce(1).write.parquet(f"{self._root}/{day}{_PACKED}{uuid.uuid4().hex[:8]}")
            self._storage.delete_all(old)
            if not self._storage.any(f"{day}/*"):
                self._storage.delete(day)
        return len(open_days)

    def _folders(self, first: date | None, last: date | None) -> list[str]:
        """Folders of the days, one per open day and one per packed file."""
        low, high = first.isoformat() if first else "", last.isoformat() if last else "9999-12-31"
        return [name for name in self._storage.glob("*") if low <= name[:10] <= high]

    def _events(self, folders: list[str]) -> DataFrame:
        paths = [f"{self._root}/{folder}" for folder in folders]
        return self._spark.read.schema(_EVENTS).option("recursiveFileLookup", "true").parquet(*paths)


class Execution:
    """A run in progress."""

    def __init__(self, table: ExecutionTable, fields: dict[str, Any]) -> None:
        self._table = table
        self._fields = fields
        self._event = -1

    @property
    def id(self) -> int:
        return self._fields["id"]

    def record(self, **changes: Any) -> None:
        self._fields.update(changes)
        self._event += 1
        try:
            self._table.append({**self._fields, _SEQUENCE: self._event})
        except Exception as problem:  # the audit trail must not stop a load
            logger.warning("execution %s could not be recorded: %s", self.id, problem)

    def update_rows(self, rows_processed: int) -> None:
        self.record(rows_processed=rows_processed)

    def succeed(self, rows_processed: int) -> None:
        self._finish("success", rows_processed)

    def fail(self, rows_processed: int = 0) -> None:
        self._finish("error", rows_processed)

    def _finish(self, status: str, rows_processed: int) -> None:
        finished = datetime.now(timezone.utc)
        seconds = round((finished - self._fields["started_at"]).total_seconds(), 2)
        self.record(status=status, rows_processed=rows_processed, finished_at=finished, duration_seconds=seconds)

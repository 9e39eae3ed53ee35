"""Run one task: record the start, read, load by mode, record the end."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..errors import ContractError
from ..sources import jdbc, tables
from ..state.executions import ExecutionTable
from ..state.watermarks import WatermarkTable
from ..task import Task
from .jobs import LoadResult, append_new, full_load, replace_window

Connections = Mapping[str, Mapping[str, Any]]


def replicate(
    spark: SparkSession,
    task: Task,
    *,
    connections: Connections,
    state_root: str,
    source: DataFrame | None = None,
    queries: Mapping[str, str] | str | None = None,
    as_of: date | None = None,
    now: datetime | None = None,
    clustered: bool = False,
) -> LoadResult:
    """Load one table as the task says.

    ``connections`` maps the ``runtime`` names of the task to settings: JDBC options (and ``split``,
    ``numeric``), or ``{"path": folder}`` for Parquet sources and for targets on any Hadoop file system.
    ``source`` overrides the source with a frame of the caller. ``now`` stamps the rows, ``as_of``
    ends the replace window. The run is recorded as ``error`` with 0 rows when anything fails.
    """
    execution = ExecutionTable(spark, state_root).start(**_task_fields(task))
    try:
        result = _run(spark, task, connections, state_root, source, queries, as_of, now or datetime.now(), clustered)
    except BaseException:
        execution.fail()
        raise
    execution.succeed(result.rows)
    return result


def _run(
    spark: SparkSession,
    task: Task,
    connections: Connections,
    state_root: str,
    source: DataFrame | None,
    queries: Mapping[str, str] | str | None,
    as_of: date | None,
    now: datetime,
    clustered: bool,
) -> LoadResult:
    target = _settings(connections, task.target.runtime)
    if "path" not in target:
        raise ContractError(f"target runtime '{task.target.runtime}' needs a path")
    dataset = f"{str(target['path']).rstrip('/')}/{task.table.target_dataset_path}"
    opened = Opened(source) if source is not None else open_source(spark, task, connections, queries)

    strategy, partition = task.replication.strategy, task.replication.partition
    options: dict[str, Any] = {
        "partitioning": partition.layout() if partition else None,
        "lineage": task.metadata.lineage(task.table.qualified_name, now),
        "max_rows_per_file": task.target.chunk_size,
        "clustered": clustered,
        # On an object store a rename is a copy: such targets are committed by versions. A runtime may ask for them, too.
        "versioned": True if task.target.type == "s3" else target.get("versioned"),
    }
    if strategy is None:
        return full_load(opened.shaped(), dataset, **options)
    if strategy.type == "replace":
        return replace_window(opened.shaped(), dataset, lookback_periods=strategy.lookback_periods, as_of=as_of, **options)
    return append_new(
        opened.rows,
        dataset,
        task_identifier=task.table.task_identifier,
        reference_column=strategy.reference_column,
        watermarks=WatermarkTable(spark, state_root),
        upper_bound=opened.upper_bound,
        prepare=opened.prepare,
        lease_seconds=target.get("lease_seconds"),
        **options,
    )


@dataclass(frozen=True)
class Opened:
    """A source: its rows, the shaping to landing types, and the fixed upper edge of an append over JDBC."""

    rows: DataFrame
    prepare: Callable[[DataFrame], DataFrame] | None = None
    upper_bound: Any = None

    def shaped(self) -> DataFrame:
        return self.prepare(self.rows) if self.prepare else self.rows


def open_source(
    spark: SparkSession,
    task: Task,
    connections: Connections,
    queries: Mapping[str, str] | str | None = None,
) -> Opened:
    settings = dict(_settings(connections, task.source.runtime))
    query = None
    if task.source.query_path is not None:
        query = tables.resolve_query(spark, queries or {}, task.source.query_path)
    if task.source.type in ("postgresql", "sqlserver"):
        return _open_jdbc(spark, task, settings, query)
    if task.source.type not in ("parquet", "table"):
        raise ContractError(f"source type '{task.source.type}' cannot be read yet")
    if query is not None:
        return Opened(tables.read_query(spark, query))
    if task.source.type == "table":
        return Opened(spark.table(task.table.qualified_name))
    return Opened(tables.read_parquet(spark, f"{str(settings['path']).rstrip('/')}/{task.table.name}.parquet"))


def _open_jdbc(spark: SparkSession, task: Task, settings: dict[str, Any], query: str | None) -> Opened:
    split: jdbc.RangeSplit | jdbc.EvenSplit | Sequence[str] | None = settings.pop("split", None)
    if isinstance(split, Mapping):
        split = jdbc.EvenSplit(**split) if "parts" in split else jdbc.RangeSplit(**split)
    numeric = settings.pop("numeric", "double")
    table, kind = task.table, task.source.type
    rows, prepare = jdbc.scan_jdbc(
        spark,
        settings,
        kind,
        table.schema_name,
        table.name,
        query=query,
        chunk_size=task.source.chunk_size,
        split=split,
        numeric=numeric,
    )
    strategy = task.replication.strategy
    if strategy is None or strategy.type != "append":
        return Opened(rows, prepare)
    # Also a read by one task may be repeated, when an executor is lost, and then find newer rows: the edge is fixed first.
    text = query or jdbc.default_query(kind, table.schema_name, table.name, rows.columns)
    return Opened(rows, prepare, jdbc.current_maximum(spark, settings, kind, text, strategy.reference_column))


def _settings(connections: Connections, runtime: str) -> Mapping[str, Any]:
    try:
        return connections[runtime]
    except KeyError:
        raise ContractError(f"no connection settings for runtime '{runtime}'") from None


def _task_fields(task: Task) -> dict[str, Any]:
    """The descriptive columns of an execution record."""
    strategy, partition = task.replication.strategy, task.replication.partition
    return {
        "schema_name": task.table.schema_name,
        "name": task.table.name,
        "target_schema_name": task.table.target_schema_name,
        "target_name": task.table.target_name,
        "mode": task.replication.mode,
        "source_type": task.source.type,
        "source_runtime": task.source.runtime,
        "target_type": task.target.type,
        "target_runtime": task.target.runtime,
        "strategy_type": strategy.type if strategy else None,
        "strategy_reference_column": strategy.reference_column if strategy else None,
        "strategy_lookback_periods": strategy.lookback_periods if strategy else None,
        "partition_type": partition.type if partition else None,
        "partition_reference_column": partition.reference_column if partition else None,
        "rows_processed": 0,
    }

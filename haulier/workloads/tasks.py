"""Whole tasks: contract, load, state and execution history."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from ..errors import LoadError
from ..plans.replicate import replicate
from ..state.executions import ExecutionTable
from ..task import task_from_mapping
from .registry import landed, table, work_folder, workload

NOW = datetime(2024, 2, 1, 8, 30, 15, 999999)


def _task(name: str, target: str, replication: dict, **extra) -> dict:
    return {
        "table": {"schema_name": "tpch", "name": name, "target_schema_name": "raw", "target_name": target},
        "source": {"type": "parquet", "runtime": "given_tables"},
        "target": {"type": "local", "runtime": "landing", "chunk_size": 200000},
        "replication": replication,
        **extra,
    }


def _by(granularity: str, column: str) -> dict:
    return {"type": granularity, "reference_column": column}


@workload(
    """SELECT *, '2024-02-01T08:30:15' AS "$data_ingestao", 'tpch.orders' AS "$banco_origem",
        CAST(year(o_orderdate) AS INTEGER) AS year
    FROM orders"""
)
def replicate_full_load(spark: SparkSession, folder: str) -> DataFrame:
    root = work_folder(spark, "replicate")
    task = task_from_mapping(
        _task("orders", "orders", {"mode": "full_load", "partition": _by("Year ", "o_orderdate")})
    )
    connections = {"given_tables": {"path": folder}, "landing": {"path": root}}
    return landed(spark, replicate(spark, task, connections=connections, state_root=f"{root}/state", now=NOW))


@workload(
    """SELECT 'orders' AS name, 'full_load' AS mode, NULL AS strategy_type, 'year' AS partition_type,
        'success' AS status, (SELECT count(*) FROM orders) AS rows_processed
    UNION ALL SELECT 'orders', 'incremental', 'replace', 'year', 'success',
        (SELECT count(*) FROM orders WHERE year(o_orderdate) IN (1999, 2000))
    UNION ALL SELECT 'events', 'incremental', 'append', 'day', 'success', (SELECT count(*) FROM events)
    UNION ALL SELECT 'events', 'incremental', 'append', 'day', 'success', 0
    UNION ALL SELECT 'customer', 'full_load', NULL, NULL, 'success', (SELECT count(*) FROM customer)
    UNION ALL SELECT 'customer', 'incremental', 'append', NULL, 'error', 0"""
)
def execution_history(spark: SparkSession, folder: str) -> DataFrame:
    """One record per run, over all modes, with one run that fails."""
    root = work_folder(spark, "history")
    append_events = {
        "mode": "incremental",
        "strategy": {"type": "append", "reference_column": "ts", "aggregation": "max"},
        "partition": _by("day", "ts"),
    }
    runs = [
        _task("orders", "orders", {"mode": "full_load", "partition": _by("year", "o_orderdate")}),
        _task(
            "orders",
            "orders",
            {
                "mode": "incremental",
                "strategy": {"type": "replace", "reference_column": "o_orderdate", "lookback_periods": 2},
                "partition": _by("year", "o_orderdate"),
            },
        ),
        _task("events", "events", append_events),
        _task("events", "events", append_events),
        _task("customer", "customer", {"mode": "full_load"}),
        _task(
            "customer",
            "customer_new",
            {"mode": "incremental", "strategy": {"type": "append", "reference_column": "no_such_column"}},
        ),
    ]
    connections = {"given_tables": {"path": folder}, "landing": {"path": root}}
    for raw in runs:
        try:
            replicate(
                spark,
                task_from_mapping(raw),
                connections=connections,
                state_root=f"{root}/state",
                as_of=date(2000, 6, 15),
                now=NOW,
            )
        except LoadError:
            pass
    return (
        ExecutionTable(spark, f"{root}/state")
        .history()
        .select("name", "mode", "strategy_type", "partition_type", "status", "rows_processed")
    )


@workload(
    """SELECT 'orders' AS name, 'running' AS status, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS rows_processed
    UNION ALL SELECT 'lineitem', 'success', (SELECT count(*) FROM lineitem)"""
)
def execution_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Progress rows: of a run that goes on, and of one that ended."""
    executions = ExecutionTable(spark, f"{work_folder(spark, 'progress')}/state")
    orders = executions.start(name="orders")
    orders.update_rows(table(spark, folder, "orders").where("o_orderstatus = 'F'").count())
    lineitem = executions.start(name="lineitem")
    rows = table(spark, folder, "lineitem").count()
    lineitem.update_rows(rows // 2)
    lineitem.succeed(rows)
    return executions.history().select("name", "status", "rows_processed")

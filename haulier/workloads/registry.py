"""Named example loads over the given tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import session
from ..operators.landing import read_landed
from ..plans.jobs import LoadResult

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def workload(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query (by default under its function name) with the equivalent SQL on the same tables."""

    def register(function: Query) -> Query:
        QUERIES[name or function.__name__] = function
        ORACLES[name or function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder on shared storage that lives as long as the application."""
    return session.scratch_folder(spark, name)


def landed(spark: SparkSession, result: LoadResult) -> DataFrame:
    return read_landed(spark, result.dataset, result.schema)

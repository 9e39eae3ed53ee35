"""Row shaping before a write, and the checks that are made once, before any job starts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import SchemaError
from ..functions.bounds import within
from ..functions.names import clashes, column, require_column
from ..functions.periods import as_utc_date, levels, path_columns, period_start_column

# Working column: start of the row's period. It exists only between the filter and the write.
PERIOD = "__haulier_period"


@dataclass(frozen=True)
class Partitioning:
    """Hive layout by year, month or day of one date column."""

    column: str
    granularity: str

    def __post_init__(self) -> None:
        levels(self.granularity)
        object.__setattr__(self, "column", (self.column or "").strip())

    @property
    def levels(self) -> tuple[str, ...]:
        return levels(self.granularity)


def check_lineage(df: DataFrame, lineage: Mapping[str, str]) -> None:
    """Lineage names must be new, and all names distinct, also when only the case differs."""
    names = [c.lower() for c in df.columns]
    twice = sorted({c for c in df.columns if names.count(c.lower()) > 1})
    if twice:
        raise SchemaError(f"Spark cannot tell the source columns {twice} apart; rename them in a query")
    taken = clashes(df.columns, lineage)
    if taken:
        raise SchemaError(f"lineage columns {taken} already exist in the source; columns: {df.columns}")
    if len({name.lower() for name in lineage}) < len(lineage):
        raise SchemaError(f"lineage columns need different names: {list(lineage)}")


def check_partitioning(df: DataFrame, partitioning: Partitioning, lineage: Mapping[str, str]) -> Column:
    """The partition column exists and is dated, and no column hides a path level.

    Returns the row's calendar date.
    """
    name = require_column(df.columns, partitioning.column, "partition.reference_column")
    hidden = clashes([*df.columns, *lineage], [*partitioning.levels, PERIOD])
    if hidden:
        raise SchemaError(f"columns named {hidden} would be hidden by the partition path; rename them in a query")
    return as_utc_date(column(name), df.schema[name].dataType)


def add_lineage(df: DataFrame, lineage: Mapping[str, str]) -> DataFrame:
    """Append constant text columns, in the given order, after all others."""
    check_lineage(df, lineage)
    return df.select(*[column(c) for c in df.columns], *[F.lit(v).alias(n) for n, v in lineage.items()])


def drop_null_periods(df: DataFrame, partitioning: Partitioning) -> DataFrame:
    """Rows without a partition date have no partition to go to."""
    return df.filter(column(partitioning.column).isNotNull())


def keep_window(df: DataFrame, partitioning: Partitioning, first: date, end: date) -> DataFrame:
    """Rows whose partition lies in the window ``[first, end)``."""
    name = require_column(df.columns, partitioning.column, "partition.reference_column")
    return df.filter(within(column(name), first, end, df.schema[name].dataType))


def with_period(df: DataFrame, day: Column, partitioning: Partitioning) -> DataFrame:
    return df.withColumn(PERIOD, period_start_column(day, partitioning.granularity))


def with_path_columns(df: DataFrame, partitioning: Partitioning) -> DataFrame:
    """Replace the working period by the text columns of the path."""
    kept = [column(c) for c in df.columns if c != PERIOD]
    return df.select(*kept, *path_columns(F.col(PERIOD), partitioning.granularity))

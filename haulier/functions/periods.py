"""Calendar periods: on driver-side dates (for plans) and as columns (for rows).

A period is a year, a month or a day. Plans only ever handle a handful of period edges on
the driver; everything that touches rows is a built-in Spark expression.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ContractError, SchemaError

# The path levels of each granularity, outermost first.
LEVELS = {
    "year": ("year",),
    "month": ("year", "month"),
    "day": ("year", "month", "day"),
}
# Digits of each path level.
DIGITS = {"year": 4, "month": 2, "day": 2}

_MONTHS_PER_PERIOD = {"year": 12, "month": 1}
_TRUNC_UNIT = {"year": "YEAR", "month": "MM"}
_STEP = {"year": "INTERVAL 1 YEAR", "month": "INTERVAL 1 MONTH", "day": "INTERVAL 1 DAY"}


def levels(granularity: str) -> tuple[str, ...]:
    try:
        return LEVELS[granularity]
    except KeyError:
        raise ContractError(f"unknown granularity '{granularity}'; use one of {sorted(LEVELS)}") from None


# ---------------------------------------------------------------- driver-side dates


def period_start(day: date, granularity: str) -> date:
    """First day of the period that contains ``day``."""
    depth = len(levels(granularity))
    return date(day.year, day.month if depth > 1 else 1, day.day if depth > 2 else 1)


def shift_periods(day: date, granularity: str, count: int) -> date:
    """Start of the period ``count`` periods later (earlier when negative)."""
    start = period_start(day, granularity)
    if granularity == "day":
        return start + timedelta(days=count)
    year, month0 = divmod(start.year * 12 + start.month - 1 + count * _MONTHS_PER_PERIOD[granularity], 12)
    return date(year, month0 + 1, 1)


def window_bounds(as_of: date, granularity: str, lookback: int) -> tuple[date, date]:
    """Half-open ``[first day, day after the last]`` of the lookback window ending at ``as_of``."""
    if lookback < 1:
        raise ContractError("lookback_periods must be greater than 0")
    return shift_periods(as_of, granularity, 1 - lookback), shift_periods(as_of, granularity, 1)


def window_partitions(as_of: date, granularity: str, lookback: int) -> list[str]:
    """Partition paths of the window, oldest first."""
    first, _ = window_bounds(as_of, granularity, lookback)
    return [partition_path(shift_periods(first, granularity, n), granularity) for n in range(lookback)]


def partition_path(day: date, granularity: str) -> str:
    """``year=2024/month=02/day=29`` down to the wanted level."""
    return "/".join(f"{lv}={getattr(day, lv):0{DIGITS[lv]}d}" for lv in levels(granularity))


# ---------------------------------------------------------------- columns


def as_utc_date(col: Column, dtype: T.DataType) -> Column:
    """Calendar date of a date or timestamp column.

    Zoned timestamps are dated in UTC whatever the session zone is; zoneless ones as written.
    """
    if isinstance(dtype, T.DateType):
        return col
    if isinstance(dtype, T.TimestampNTZType):
        return col.cast("date")
    if isinstance(dtype, T.TimestampType):
        return F.convert_timezone(None, F.lit("UTC"), col).cast("date")
    raise SchemaError(f"a partition column must be a date or a timestamp, not {dtype.simpleString()}")


def period_start_column(day: Column, granularity: str) -> Column:
    """Column form of :func:`period_start` on a date column."""
    levels(granularity)
    return day if granularity == "day" else F.trunc(day, _TRUNC_UNIT[granularity])


def shift_periods_column(day: Column, granularity: str, count: int) -> Column:
    """Column form of :func:`shift_periods` on a date column."""
    start = period_start_column(day, granularity)
    if granularity == "day":
        return F.date_add(start, count)
    return F.add_months(start, count * _MONTHS_PER_PERIOD[granularity])


def path_columns(day: Column, granularity: str) -> list[Column]:
    """Zero-padded text columns named after the path levels, for ``partitionBy``."""
    part = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    return [F.lpad(part[lv](day).cast("string"), DIGITS[lv], "0").alias(lv) for lv in levels(granularity)]


def path_text(day: Column, granularity: str) -> Column:
    """Column form of :func:`partition_path`."""
    pieces = [F.concat(F.lit(f"{lv}="), col) for lv, col in zip(levels(granularity), path_columns(day, granularity))]
    return F.concat_ws("/", *pieces)


def window_frame(spark: SparkSession, as_of: date, granularity: str, lookback: int) -> DataFrame:
    """The window as rows ``(period DATE, path STRING)``, one per period."""
    first, end = window_bounds(as_of, granularity, lookback)
    last = shift_periods(end, granularity, -1)
    days = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr(_STEP[granularity])))
    return spark.range(1).select(days.alias("period")).select("period", path_text(F.col("period"), granularity).alias("path"))

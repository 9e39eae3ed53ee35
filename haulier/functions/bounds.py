"""Typed lower bounds and the text form in which a watermark is kept."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaError

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def bound_literal(value: Any, dtype: T.DataType) -> Column:
    """A constant of the column's own type, so that the comparison reaches the scan.

    Text is cast by Spark to the column type: no locale or date-order setting is involved.
    A zoned timestamp column reads text and dates without an offset as UTC.
    """
    text = value.isoformat(" ") if isinstance(value, datetime) else str(value).strip()
    if isinstance(dtype, T.StringType):
        return F.lit(str(value))
    if isinstance(dtype, T.TimestampType):
        text = _with_offset(text)
    return F.lit(text).cast(dtype)


def _with_offset(text: str) -> str:
    try:
        parsed = datetime.fromisoformat(text)
    except ValueError:
        return text
    return parsed.isoformat(" ") if parsed.tzinfo else parsed.isoformat(" ") + "+00:00"


def check_bound(spark: SparkSession, value: Any, dtype: T.DataType) -> None:
    """Refuse a bound that is not a value of the column type.

    With ANSI mode off such text would become NULL, and the load would quietly find nothing.
    Constant folding answers this on the driver, without a job.
    """
    if value is None or spark.sql("SELECT 1").select(bound_literal(value, dtype).isNull()).first()[0]:
        raise SchemaError(f"bound '{value}' is not a {dtype.simpleString()}")


def after(col: Column, value: Any, dtype: T.DataType) -> Column:
    """Exclusive lower bound."""
    return col > bound_literal(value, dtype)


def from_start(col: Column, value: Any, dtype: T.DataType) -> Column:
    """Inclusive lower bound."""
    return col >= bound_literal(value, dtype)


def within(col: Column, first: date, end: date, dtype: T.DataType) -> Column:
    """Half-open range; a plain range rather than a set test, so that it is pushed down."""
    return (col >= bound_literal(first, dtype)) & (col < bound_literal(end, dtype))


# ---------------------------------------------------------------- watermark values


def watermark_type(dtype: T.DataType) -> str:
    """Label kept beside the value: dates and timestamps, integers (booleans too), anything else."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return "int"
    return "string"


def max_expression(col: Column, dtype: T.DataType) -> Column:
    """Maximum in a form that reaches the driver without loss; NULL and NaN are skipped."""
    if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        return F.max(F.when(~F.isnan(col), col)).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.max(col))
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return F.max(col)
    return F.max(col).cast("string")


def watermark_text(value: Any, dtype: T.DataType) -> str | None:
    """Text of an observed maximum: ISO dates and times with 0 or 6 fraction digits."""
    if value is None:
        return None
    if isinstance(dtype, T.TimestampType):
        return str(_EPOCH + timedelta(microseconds=value))
    if isinstance(dtype, T.TimestampNTZType) and "." in value:
        whole, fraction = value.split(".")
        return f"{whole}.{fraction:0<6}"
    return str(value)

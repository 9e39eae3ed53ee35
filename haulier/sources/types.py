"""Landing types: one projection of casts per source system."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ContractError
from ..functions.names import column

NUMERIC_MODES = ("double", "decimal")


def normalize_types(
    df: DataFrame,
    source_type: str = "postgresql",
    numeric: str = "double",
    time_columns: Collection[str] = (),
) -> DataFrame:
    """Cast every column to its landing type.

    ``numeric="double"`` lands decimals as double; ``"decimal"`` keeps precision and scale.
    Time-of-day columns, which JDBC delivers as timestamps, land as text: those that Spark's reader marks, and those
    named in ``time_columns``.
    SQL Server integers widen to long and reals to double. Types without a landing type
    become text: nested values as JSON, PostgreSQL binaries in their ``\\x...`` text form.
    Columns that keep their type pass through untouched, so a scan stays column-pruned.
    """
    if source_type not in ("postgresql", "sqlserver"):
        raise ContractError(f"no type map for source type '{source_type}'")
    if numeric not in NUMERIC_MODES:
        raise ContractError(f"numeric must be one of {NUMERIC_MODES}")
    wide = source_type == "sqlserver"
    return df.select(*[_landed(f, wide, numeric, f.name in time_columns or _is_time(f)) for f in df.schema.fields])


# Fixed value: the mark of Spark's JDBC reader on fields that hold a time of day.
_TIME_MARK = "logical_time_type"


def _is_time(field: T.StructField) -> bool:
    return bool(field.metadata.get(_TIME_MARK))


def _landed(field: T.StructField, wide: bool, numeric: str, is_time: bool) -> Column:
    col, dtype = column(field.name), field.dataType
    landed = col
    if is_time and isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        landed = _time_text(col)
    elif isinstance(dtype, T.DecimalType):
        landed = col.cast("double") if numeric == "double" else col
    elif wide and isinstance(dtype, T.IntegralType):
        landed = col.cast("long")
    elif wide and isinstance(dtype, T.FloatType):
        landed = col.cast("double")
    elif isinstance(dtype, T.BinaryType):
        landed = col if wide else F.concat(F.lit("\\x"), F.lower(F.hex(col)))
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        landed = F.to_json(col)
    elif not isinstance(dtype, _KEPT):
        landed = col.cast("string")
    return landed.alias(field.name)


_KEPT = (
    T.BooleanType,
    T.IntegralType,
    T.FloatType,
    T.DoubleType,
    T.StringType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def _time_text(col: Column) -> Column:
    """``HH:mm:ss[.fraction]`` as a TIME value is cast; no session zone is involved for zoneless values."""
    return F.substring_index(col.cast("string"), " ", -1)

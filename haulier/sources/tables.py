"""Sources that Spark reads by itself: Parquet folders, catalog tables, SQL over views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ContractError, SchemaError
from ..functions.bounds import after, check_bound, from_start
from ..functions.names import column, require_column


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """A user query over views and catalog tables, planned by Catalyst as a whole.

    ``frames`` are named in the text as ``{name}``.
    """
    return spark.sql(single_statement(sql), **frames)


def single_statement(sql: str) -> str:
    """Query text that can stand in a subquery: not blank, no closing semicolon."""
    text = sql.strip().rstrip(";").rstrip()
    if not text:
        raise ContractError("the source query is empty")
    return text


def resolve_query(spark: SparkSession, queries: Mapping[str, str] | str, query_path: str) -> str:
    """Text of a named user query, from a mapping or from a file below a base folder."""
    name = (query_path or "").strip()
    if not name:
        raise ContractError("query_path must not be blank")
    if isinstance(queries, str):
        found = spark.read.text(f"{queries.rstrip('/')}/{name}", wholetext=True).first()
        text = found[0] if found else None
    else:
        text = queries.get(name)
    if text is None:
        raise ContractError(f"query '{name}' not found")
    return single_statement(text)


def lower_bound(df: DataFrame, reference_column: str, value: object, inclusive: bool = True) -> DataFrame:
    """Rows at or above (``inclusive``) or strictly above a bound. NULLs never qualify."""
    name = require_column(df.columns, reference_column, "reference_column")
    dtype = df.schema[name].dataType
    check_bound(df.sparkSession, value, dtype)
    return df.filter((from_start if inclusive else after)(column(name), value, dtype))


def column_catalog(df: DataFrame) -> DataFrame:
    """Columns of a frame as rows: ``name, data_type, nullable, ordinal_position``."""
    if not df.columns:
        raise SchemaError("the source has no columns")
    entries = [
        F.struct(
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"),
            F.lit(i).alias("ordinal_position"),
        )
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*entries)))

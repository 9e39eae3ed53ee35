"""PostgreSQL and SQL Server through Spark's JDBC reader.

The projection and every bound run in the database: the projection because it is the query
text, the bounds because Spark pushes filters on the returned frame into it. Reads are parallel
when the caller gives a split, or asks for one cut by the table's own counts; each split is a query of its own, so an append over a split read
fixes its upper edge first (:func:`current_maximum`).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ContractError, SchemaError
from ..functions.names import quote_ident
from ..functions.periods import levels, shift_periods
from .tables import single_statement
from .types import normalize_types

# information_schema columns read per source system, with their result names.
CATALOG_COLUMNS = {
    "postgresql": {
        "column_name": "name",
        "data_type": "data_type",
        "udt_name": "udt_name",
        "is_nullable": "nullable",
        "character_maximum_length": "max_length",
        "numeric_precision": "numeric_precision",
        "numeric_scale": "numeric_scale",
        "ordinal_position": "ordinal_position",
    },
    "sqlserver": {
        "column_name": "name",
        "data_type": "data_type",
        "is_nullable": "nullable",
        "character_maximum_length": "max_length",
        "numeric_precision": "numeric_precision",
        "numeric_scale": "numeric_scale",
        "ordinal_position": "ordinal_position",
    },
}
# Catalog type names that hold a time of day without a date.
TIME_TYPES = ("time", "time without time zone", "time with time zone")


@dataclass(frozen=True)
class RangeSplit:
    """Even ranges of a numeric, date or timestamp column. The bounds only shape the ranges: rows
    below, above or NULL are read too."""

    column: str
    lower: object
    upper: object
    partitions: int

    def options(self) -> dict[str, str]:
        if self.partitions < 1:
            raise ContractError("a split needs at least one partition")
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def period_predicates(reference_column: str, granularity: str, first: date, last: date, dialect: str) -> list[str]:
    """One predicate per calendar period plus everything outside them, so that no row is missed."""
    name = quote_ident(reference_column, dialect)
    edges = [shift_periods(first, granularity, 0)]
    while edges[-1] <= last:
        edges.append(shift_periods(edges[-1], granularity, 1))
    texts = [_date_literal(edge, dialect) for edge in edges]
    inside = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(texts, texts[1:])]
    return inside + [f"{name} < {texts[0]} OR {name} IS NULL", f"{name} >= {texts[-1]}"]


@dataclass(frozen=True)
class EvenSplit:
    """About ``parts`` reads of a date or timestamp column with like numbers of rows, cut by what the table holds.

    One query counts rows per period. Neighbouring periods are put together up to an even share; a period with more than a share is cut into
    equal stretches of time, down to seconds where the column has them (``timestamps``). What is uneven within a period is not seen, so
    coarser periods than days only suit tables without hot days. NULLs and rows outside what was counted are read too.
    """

    column: str
    parts: int
    granularity: str = "day"
    timestamps: bool = True

    def __post_init__(self) -> None:
        if self.parts < 1:
            raise ContractError("a split needs at least one part")


def period_counts_query(source_type: str, sql: str, split: EvenSplit) -> str:
    """Query text: ``period`` (its first day, NULL for NULLs) and the ``n`` rows of each."""
    name = quote_ident(split.column, source_type)
    levels(split.granularity)  # refuses unknown words
    if source_type == "sqlserver":
        month, day = ("1" if split.granularity == "year" else f"MONTH({name})"), "1"
        period = f"CAST({name} AS date)" if split.granularity == "day" else f"DATEFROMPARTS(YEAR({name}), {month}, {day})"
    else:
        period = f"CAST(DATE_TRUNC('{split.granularity}', {name}) AS date)"
    return f"SELECT {period} AS period, COUNT(*) AS n FROM {subquery(sql)} GROUP BY {period}"


def even_predicates(counts: Sequence[tuple[date | None, int]], split: EvenSplit, dialect: str) -> list[str]:
    """Predicates that each row, whatever its value, meets exactly one of; their number is near ``split.parts``.

    ``counts`` holds the first day of each period (None for NULLs) and its rows. One edge lies between neighbouring predicates; the
    first is open below, the last above. NULLs have a predicate of their own.
    """
    name = quote_ident(split.column, dialect)
    periods = sorted((day, n) for day, n in counts if day is not None and n)
    share = max(1.0, sum(n for _, n in periods) / split.parts)
    edges: list[datetime] = []
    held = 0.0
    for day, n in periods:
        start = datetime.combine(day, time())
        if held and held + n > share:
            edges.append(start)
            held = 0.0
        slices = math.ceil(n / share - 1e-9)
        if slices > 1 and split.timestamps:
            length = datetime.combine(shift_periods(day, split.granularity, 1), time()) - start
            step = timedelta(seconds=max(1, int(length.total_seconds() // slices)))
            edges.extend(start + i * step for i in range(1, slices) if i * step < length)
            held = n / slices
        elif slices > 1 and split.granularity != "day":
            days = (shift_periods(day, split.granularity, 1) - day).days
            step = max(1, days // slices)
            edges.extend(start + timedelta(days=i * step) for i in range(1, slices) if i * step < days)
            held = n / slices
        else:
            held += n
    texts = [_moment_literal(edge, dialect, split.timestamps) for edge in edges]
    if not texts:
        return [f"{name} IS NOT NULL", f"{name} IS NULL"]
    inside = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(texts, texts[1:])]
    return [f"{name} < {texts[0]}", *inside, f"{name} >= {texts[-1]}", f"{name} IS NULL"]


def _moment_literal(moment: datetime, dialect: str, timestamps: bool) -> str:
    if not timestamps or moment.time() == time():
        return _date_literal(moment.date(), dialect)
    # The form with a T is read alike by SQL Server under every DATEFORMAT.
    return f"'{moment:%Y-%m-%dT%H:%M:%S}'" if dialect == "sqlserver" else f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S}'"


def planned_predicates(spark: SparkSession, connection: Mapping[str, str], source_type: str, sql: str, split: EvenSplit) -> list[str]:
    """Predicates cut by one query to the database; it returns a row per period."""
    found = (
        spark.read.format("jdbc")
        .options(**reader_options(connection, source_type))
        .option("dbtable", subquery(period_counts_query(source_type, sql, split)))
        .load()
        .collect()
    )
    return even_predicates([(row["period"], row["n"]) for row in found], split, source_type)


def _date_literal(day: date, dialect: str) -> str:
    # SQL Server reads only the undashed form alike under every DATEFORMAT.
    return f"'{day:%Y%m%d}'" if dialect == "sqlserver" else f"DATE '{day.isoformat()}'"


def catalog_query(source_type: str, schema_name: str, table_name: str) -> str:
    """Query text that lists the columns of one table in ordinal order."""
    wanted = ", ".join(f"{c} AS {alias}" for c, alias in CATALOG_COLUMNS[source_type].items())
    return (
        f"SELECT {wanted} FROM information_schema.columns "
        f"WHERE table_schema = {_text_literal(schema_name)} AND table_name = {_text_literal(table_name)}"
    )


def default_query(source_type: str, schema_name: str | None, table_name: str, columns: Sequence[str]) -> str:
    """Every column, quoted, in the given order."""
    if not schema_name:
        raise SchemaError("a default query needs the schema name of the source table")
    if not columns:
        raise SchemaError(f"no columns found for {schema_name}.{table_name}")
    listed = ", ".join(quote_ident(c, source_type) for c in columns)
    return f"SELECT {listed} FROM {quote_ident(schema_name, source_type)}.{quote_ident(table_name, source_type)}"


def _text_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def subquery(sql: str) -> str:
    return f"({single_statement(sql)}) AS src"


def reader_options(connection: Mapping[str, str], source_type: str, chunk_size: int | None = None) -> dict[str, str]:
    """Connection options (``url``, ``user``, ``password``, ...) plus those every read uses."""
    if "url" not in connection:
        raise ContractError("a JDBC connection needs a url")
    options = {"preferTimestampNTZ": "true", "pushDownPredicate": "true"}
    if source_type == "sqlserver":
        # Pushed bounds are ISO text; a login with another date order would misread them.
        options["sessionInitStatement"] = "SET DATEFORMAT ymd"
    options.update(connection)
    if chunk_size is not None:
        options["fetchsize"] = str(chunk_size)
    return options


def read_catalog(
    spark: SparkSession, connection: Mapping[str, str], source_type: str, schema_name: str, table_name: str
) -> DataFrame:
    """Column catalog of one table, ``nullable`` as a boolean, in ordinal order."""
    found = (
        spark.read.format("jdbc")
        .options(**reader_options(connection, source_type))
        .option("dbtable", subquery(catalog_query(source_type, schema_name, table_name)))
        .load()
    )
    return found.withColumn("nullable", F.col("nullable") == "YES").orderBy("ordinal_position")


def read_jdbc(
    spark: SparkSession,
    connection: Mapping[str, str],
    source_type: str,
    schema_name: str | None,
    table_name: str,
    query: str | None = None,
    chunk_size: int | None = None,
    split: RangeSplit | EvenSplit | Sequence[str] | None = None,
    numeric: str = "double",
) -> DataFrame:
    """A table (all columns) or a user query, with landing types.

    ``split`` is a :class:`RangeSplit`, an :class:`EvenSplit` or a list of predicates; without it one task reads all.
    """
    rows, landing_types = scan_jdbc(
        spark, connection, source_type, schema_name, table_name, query, chunk_size, split, numeric
    )
    return landing_types(rows)


def scan_jdbc(
    spark: SparkSession,
    connection: Mapping[str, str],
    source_type: str,
    schema_name: str | None,
    table_name: str,
    query: str | None = None,
    chunk_size: int | None = None,
    split: RangeSplit | EvenSplit | Sequence[str] | None = None,
    numeric: str = "double",
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The rows as JDBC delivers them, and the projection to landing types.

    A filter between the two compares the source's own column, so the database can run it.
    """
    time_columns: list[str] = []
    if query is None:
        if not schema_name:
            raise SchemaError("a default query needs the schema name of the source table")
        # One row per table column: bounded by the database's column limit.
        catalog = read_catalog(spark, connection, source_type, schema_name, table_name).collect()
        query = default_query(source_type, schema_name, table_name, [c["name"] for c in catalog])
        time_columns = [c["name"] for c in catalog if c["data_type"] in TIME_TYPES]
    options = reader_options(connection, source_type, chunk_size)
    if isinstance(split, EvenSplit):
        split = planned_predicates(spark, connection, source_type, query, split)
    if isinstance(split, RangeSplit):
        options.update(split.options())
    if split is None or isinstance(split, RangeSplit):
        rows = spark.read.format("jdbc").options(**options).option("dbtable", subquery(query)).load()
    else:
        url = options.pop("url")
        rows = spark.read.jdbc(url, subquery(query), predicates=list(split), properties=options)
    return rows, lambda df: normalize_types(df, source_type, numeric, time_columns)


def maximum_query(source_type: str, sql: str, reference_column: str) -> str:
    name = quote_ident(reference_column, source_type)
    return f"SELECT MAX({name}) AS highest_value FROM {subquery(sql)}"


def current_maximum(
    spark: SparkSession, connection: Mapping[str, str], source_type: str, sql: str, reference_column: str
) -> object | None:
    """Maximum of the reference column, computed by the database: the upper edge of a split append."""
    found = (
        spark.read.format("jdbc")
        .options(**reader_options(connection, source_type))
        .option("dbtable", subquery(maximum_query(source_type, sql, reference_column)))
        .load()
    )
    return found.first()["highest_value"]

"""Source-side operators: bounds, type maps, column catalog, calendar functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import path_text, period_start_column, shift_periods_column
from ..sources.jdbc import period_predicates
from ..sources.tables import column_catalog, lower_bound
from ..sources.types import normalize_types
from .registry import table, workload


@workload("SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-30 00:00:00'")
def lower_bound_inclusive(spark: SparkSession, folder: str) -> DataFrame:
    return lower_bound(table(spark, folder, "orders"), "o_orderdate", "2000-06-30")


@workload("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 12:30:00.5'")
def lower_bound_exclusive(spark: SparkSession, folder: str) -> DataFrame:
    return lower_bound(table(spark, folder, "events"), "ts", "2024-01-15T12:30:00.500000", inclusive=False)


@workload(
    """SELECT CASE WHEN l_shipdate < TIMESTAMP '1996-01-01' OR l_shipdate IS NULL THEN 'before'
            WHEN l_shipdate >= TIMESTAMP '2000-01-01' THEN 'after'
            ELSE strftime(l_shipdate, '%Y') END AS split, count(*) AS rows
    FROM lineitem GROUP BY 1"""
)
def split_scan_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The predicates of a parallel read by year: each row falls into exactly one of them."""
    predicates = period_predicates("l_shipdate", "year", date(1996, 3, 1), date(1999, 3, 1), "spark")
    names = ["1996", "1997", "1998", "1999", "before", "after"]
    hits = F.array(*[F.when(F.expr(p), F.lit(n)) for n, p in zip(names, predicates)])
    lineitem = table(spark, folder, "lineitem").select(F.explode(F.array_compact(hits)).alias("split"))
    return lineitem.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@workload(
    """SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS line_small, l_linenumber AS line_int,
        CAST(l_quantity AS DOUBLE) AS quantity, CAST(l_discount AS FLOAT) AS discount_real,
        l_returnflag = 'R' AS returned, CAST(l_shipdate AS DATE) AS shipped_on, l_shipdate AS shipped_at,
        strftime(l_shipdate, '%H:%M:%S') AS shipped_time
    FROM lineitem""",
    name="normalize_types",
)
def normalize_types_postgresql(spark: SparkSession, folder: str) -> DataFrame:
    """Integer and float widths stay, numeric lands as double, time of day as text."""
    return normalize_types(
        _typed(table(spark, folder, "lineitem")), "postgresql", time_columns=["shipped_time"]
    )


@workload(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line_small, CAST(l_linenumber AS BIGINT) AS line_int,
        CAST(l_quantity AS DOUBLE) AS quantity, CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS discount_real,
        l_returnflag = 'R' AS returned, CAST(l_shipdate AS DATE) AS shipped_on, l_shipdate AS shipped_at,
        strftime(l_shipdate, '%H:%M:%S') AS shipped_time
    FROM lineitem"""
)
def normalize_types_sqlserver(spark: SparkSession, folder: str) -> DataFrame:
    """Every integer lands as long and every float as double."""
    return normalize_types(_typed(table(spark, folder, "lineitem")), "sqlserver", time_columns=["shipped_time"])


def _typed(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        "l_orderkey",
        F.col("l_linenumber").cast("short").alias("line_small"),
        F.col("l_linenumber").alias("line_int"),
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
        F.col("l_discount").cast("float").alias("discount_real"),
        (F.col("l_returnflag") == "R").alias("returned"),
        F.col("l_shipdate").cast("date").alias("shipped_on"),
        F.col("l_shipdate").alias("shipped_at"),
        F.col("l_shipdate").alias("shipped_time"),
    )


_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@workload(
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, {position} AS ordinal_position, count({name}) AS filled_rows FROM orders"
        for position, name in enumerate(_ORDER_COLUMNS, start=1)
    ),
    name="column_catalog",
)
def column_catalog_fill(spark: SparkSession, folder: str) -> DataFrame:
    """The column catalog of a table with the rows each column is filled in."""
    orders = table(spark, folder, "orders")
    filled = orders.agg(*[F.count(c).alias(c) for c in orders.columns]).unpivot(
        [], list(orders.columns), "name", "filled_rows"
    )
    return column_catalog(orders).join(filled, "name").select("name", "ordinal_position", "filled_rows")


@workload(
    """SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS rows,
        CAST(date_trunc('year', l_shipdate) AS DATE) AS year_start,
        CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
        CAST(date_trunc('year', l_shipdate) - INTERVAL 2 YEAR AS DATE) AS two_years_back,
        CAST(date_trunc('month', l_shipdate) - INTERVAL 13 MONTH AS DATE) AS thirteen_months_back,
        CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS DATE) AS next_month,
        CAST(CAST(l_shipdate AS DATE) - INTERVAL 1 DAY AS DATE) AS day_before,
        strftime(l_shipdate, 'year=%Y/month=%m/day=%d') AS day_path
    FROM lineitem GROUP BY ALL"""
)
def calendar_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Period starts, shifts and paths for every ship date."""
    days = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    day = F.col("day")
    return days.select(
        "day",
        "rows",
        period_start_column(day, "year").alias("year_start"),
        period_start_column(day, "month").alias("month_start"),
        shift_periods_column(day, "year", -2).alias("two_years_back"),
        shift_periods_column(day, "month", -13).alias("thirteen_months_back"),
        shift_periods_column(day, "month", 1).alias("next_month"),
        shift_periods_column(day, "day", -1).alias("day_before"),
        path_text(day, "day").alias("day_path"),
    )

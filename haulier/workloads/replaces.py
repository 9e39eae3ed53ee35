"""Rebuilding the last N partitions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import window_frame
from ..operators.shape import Partitioning
from ..plans.jobs import full_load, replace_window
from .registry import landed, table, work_folder, workload

BY_YEAR = Partitioning("o_orderdate", "year")


def _raised(orders: DataFrame) -> DataFrame:
    """The source after a change: every price one higher."""
    return orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)


@workload(
    """SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN year(o_orderdate) BETWEEN 1999 AND 2000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
        o_orderdate, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year
    FROM orders""",
    name="replace_window",
)
def replace_years(spark: SparkSession, folder: str) -> DataFrame:
    """Two years up to mid-2000 are rebuilt; older and future years keep the first load."""
    orders = table(spark, folder, "orders")
    dataset = f"{work_folder(spark, 'replace_year')}/raw/orders"
    full_load(orders, dataset, partitioning=BY_YEAR)
    result = replace_window(
        _raised(orders), dataset, partitioning=BY_YEAR, lookback_periods=2, as_of=date(2000, 6, 15)
    )
    return landed(spark, result)


@workload("SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) <> 2000")
def replace_empty_partition(spark: SparkSession, folder: str) -> DataFrame:
    """A year of the window that has no rows any more is removed."""
    orders = table(spark, folder, "orders")
    dataset = f"{work_folder(spark, 'replace_empty')}/raw/orders"
    full_load(orders, dataset, partitioning=BY_YEAR)
    result = replace_window(
        orders.filter(F.year("o_orderdate") != 2000),
        dataset,
        partitioning=BY_YEAR,
        lookback_periods=2,
        as_of=date(2000, 6, 15),
    )
    return landed(spark, result)


@workload(
    """SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderdate >= TIMESTAMP '1999-11-01' AND o_orderdate < TIMESTAMP '2000-03-01'
            THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
        o_orderdate, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year,
        CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders""",
    name="replace_month",
)
def replace_months(spark: SparkSession, folder: str) -> DataFrame:
    """Four months across the turn of a year."""
    orders = table(spark, folder, "orders")
    dataset = f"{work_folder(spark, 'replace_month')}/raw/orders"
    layout = Partitioning("o_orderdate", "month")
    full_load(orders, dataset, partitioning=layout)
    result = replace_window(
        _raised(orders), dataset, partitioning=layout, lookback_periods=4, as_of=date(2000, 2, 29)
    )
    return landed(spark, result)


@workload(
    """SELECT event_id, ts, user_id, event_type,
        CASE WHEN ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' THEN value + 1 ELSE value END AS value,
        props, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
    FROM events""",
    name="replace_day",
)
def replace_days(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    dataset = f"{work_folder(spark, 'replace_day')}/raw/events"
    layout = Partitioning("ts", "day")
    full_load(events, dataset, partitioning=layout)
    result = replace_window(
        events.withColumn("value", F.col("value") + 1),
        dataset,
        partitioning=layout,
        lookback_periods=7,
        as_of=date(2024, 1, 14),
    )
    return landed(spark, result)


@workload(
    """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '2001-01-01'"""
)
def replace_on_new_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """Without a dataset the window alone is landed; rows of a future year are not."""
    dataset = f"{work_folder(spark, 'replace_new')}/raw/orders"
    result = replace_window(
        table(spark, folder, "orders"), dataset, partitioning=BY_YEAR, lookback_periods=3, as_of=date(2000, 12, 31)
    )
    return landed(spark, result)


@workload(
    """SELECT strftime(d, 'year=%Y/month=%m') AS partition_path, count(o_orderkey) AS rows
    FROM (SELECT CAST(range AS DATE) AS d FROM range(TIMESTAMP '2000-09-01', TIMESTAMP '2002-03-01', INTERVAL 1 MONTH)) w
    LEFT JOIN orders ON date_trunc('month', o_orderdate) = d
    GROUP BY 1""",
    name="window_partitions",
)
def window_partition_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The months of a window with the rows each would get, also those that stay empty."""
    window = window_frame(spark, date(2002, 2, 14), "month", 18)
    months = (
        table(spark, folder, "orders")
        .groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("period"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return window.join(months, "period", "left").select(
        F.col("path").alias("partition_path"), F.coalesce("n", F.lit(0)).alias("rows")
    )

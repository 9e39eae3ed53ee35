"""Appending rows above a stored watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shape import Partitioning
from ..plans.jobs import LoadResult, append_new
from ..sources.types import normalize_types
from ..state.watermarks import FIELDS, WatermarkTable
from .registry import landed, table, work_folder, workload

FIRST_PART = "o_orderdate <= TIMESTAMP_NTZ '2000-06-30'"


class Appender:
    """One append task: dataset, state and options stay the same over its runs."""

    def __init__(self, spark: SparkSession, name: str, target: str, reference_column: str, **options) -> None:
        folder = work_folder(spark, name)
        self.spark = spark
        self.watermarks = WatermarkTable(spark, f"{folder}/state")
        self._dataset = f"{folder}/raw/{target}"
        self._options = {
            "task_identifier": f"raw.{target}",
            "reference_column": reference_column,
            "watermarks": self.watermarks,
            **options,
        }

    def run(self, source: DataFrame) -> LoadResult:
        return append_new(source, self._dataset, **self._options)


@workload("SELECT * FROM orders")
def append_first(spark: SparkSession, folder: str) -> DataFrame:
    """A first run loads everything."""
    task = Appender(spark, "append_first", "orders", "o_orderdate")
    return landed(spark, task.run(table(spark, folder, "orders")))


@workload(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
        CAST(CAST(9007199254740992 + o_orderkey AS DECIMAL(20, 0)) AS DOUBLE) AS big_key FROM orders"""
)
def append_decimal_watermark(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs over keys that a double cannot tell apart: every row once, though the column lands as double."""
    orders = table(spark, folder, "orders")
    orders = orders.withColumn("big_key", (F.lit(9007199254740992) + F.col("o_orderkey")).cast("decimal(20,0)"))
    task = Appender(spark, "append_decimal", "orders", "big_key", prepare=normalize_types)
    highest = orders.agg(F.max("o_orderkey")).first()[0]
    for part in (3, 2):
        task.run(orders.filter(F.col("o_orderkey") <= highest // part))
    return landed(spark, task.run(orders))


@workload("SELECT * FROM orders")
def append_second(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over a growing source: every row once."""
    orders = table(spark, folder, "orders")
    task = Appender(spark, "append_second", "orders", "o_orderdate")
    task.run(orders.filter(FIRST_PART))
    return landed(spark, task.run(orders))


@workload("SELECT * FROM orders")
def append_nothing_new(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    task = Appender(spark, "append_nothing", "orders", "o_orderdate")
    task.run(orders)
    return landed(spark, task.run(orders))


@workload(
    """SELECT * FROM orders
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, TIMESTAMP '2001-09-01 12:00:00.25', o_orderpriority
    FROM orders WHERE o_orderpriority = '5-LOW'"""
)
def append_updates(spark: SparkSession, folder: str) -> DataFrame:
    """Updated rows (a newer date) arrive as further rows; their old versions stay."""
    orders = table(spark, folder, "orders")
    task = Appender(spark, "append_updates", "orders", "o_orderdate")
    task.run(orders.filter(FIRST_PART))
    task.run(orders)
    redated = F.when(
        F.col("o_orderpriority") == "5-LOW", F.lit("2001-09-01 12:00:00.25").cast("timestamp_ntz")
    ).otherwise(F.col("o_orderdate"))
    return landed(spark, task.run(orders.withColumn("o_orderdate", redated)))


@workload(
    """SELECT * FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate <= TIMESTAMP '2000-06-30'
    UNION ALL
    SELECT * FROM orders WHERE o_orderdate > (
        SELECT max(o_orderdate) FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate <= TIMESTAMP '2000-06-30')"""
)
def append_late_and_ties(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that turn up later at or below the watermark are never read."""
    orders = table(spark, folder, "orders")
    task = Appender(spark, "append_late", "orders", "o_orderdate")
    task.run(orders.filter(FIRST_PART).filter("o_orderstatus <> 'F'"))
    return landed(spark, task.run(orders))


@workload(
    """SELECT *, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END AS changed_at
    FROM orders
    WHERE o_orderdate <= TIMESTAMP '2000-06-30' OR o_orderpriority <> '1-URGENT'"""
)
def append_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """NULL reference values are loaded by the first run of a flat append only."""
    changed = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate"))
    orders = table(spark, folder, "orders")
    task = Appender(spark, "append_nulls", "orders", "changed_at")
    task.run(orders.filter(FIRST_PART).withColumn("changed_at", changed))
    return landed(spark, task.run(orders.withColumn("changed_at", changed)))


@workload(
    """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders"""
)
def append_month(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs into nested month partitions; both runs write to some of the same months."""
    orders = table(spark, folder, "orders")
    mid_month = F.col("o_orderdate") <= F.lit("2000-06-14").cast("timestamp_ntz")
    task = Appender(
        spark, "append_month", "orders", "o_orderdate", partitioning=Partitioning("o_orderdate", "month")
    )
    task.run(orders.filter(mid_month))
    return landed(spark, task.run(orders))


@workload(
    """SELECT *, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
    FROM events
    WHERE ts < TIMESTAMP '2024-01-15'
        OR event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-15')"""
)
def append_integer_watermark(spark: SparkSession, folder: str) -> DataFrame:
    """An integer watermark column beside another partition column."""
    events = table(spark, folder, "events")
    task = Appender(spark, "append_int", "events", "event_id", partitioning=Partitioning("ts", "day"))
    task.run(events.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")))
    return landed(spark, task.run(events))


@workload(
    """SELECT 'raw.orders' AS task_identifier, 'o_orderdate' AS reference_column,
        strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS watermark_value, 'timestamp' AS watermark_type,
        count(*) FILTER (WHERE o_orderdate > TIMESTAMP '2000-06-30') AS last_record_count
    FROM orders
    UNION ALL
    SELECT 'raw.events', 'ts', strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f'), 'timestamp', count(*) FROM events
    UNION ALL
    SELECT 'raw.lineitem', 'l_orderkey', CAST(max(l_orderkey) AS VARCHAR), 'int', count(*) FROM lineitem
    UNION ALL
    SELECT 'raw.customer', 'c_name', max(c_name), 'string', count(*) FROM customer"""
)
def watermark_state(spark: SparkSession, folder: str) -> DataFrame:
    """The state table after runs with timestamp, integer and text watermarks."""
    orders = table(spark, folder, "orders")
    tasks = {
        name: Appender(spark, f"state_{name}", name, column)
        for name, column in (
            ("orders", "o_orderdate"),
            ("events", "ts"),
            ("lineitem", "l_orderkey"),
            ("customer", "c_name"),
        )
    }
    tasks["orders"].run(orders.filter(FIRST_PART))
    for name, task in tasks.items():
        task.run(table(spark, folder, name))
    states = [task.watermarks.current().select(*FIELDS) for task in tasks.values()]
    result = states[0]
    for state in states[1:]:
        result = result.unionByName(state)
    return result

"""Full loads: flat, by year, month and day, from tables and from user queries."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.landing import delete_partition, delete_table_partition, read_landed
from ..operators.shape import Partitioning
from ..operators.summary import file_counts, partition_counts
from ..plans.jobs import full_load
from ..sources.tables import read_query
from ..task import LineageColumn, Metadata
from .registry import landed, table, work_folder, workload

NOW = datetime(2024, 2, 1)
ROWS_PER_FILE = 1000

CUSTOMER_ORDERS = """
SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice, c.c_name, c.c_mktsegment
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
WHERE o.o_orderstatus <> 'P'
"""


@workload(
    """SELECT *, '2024-02-01T00:00:00' AS "$data_ingestao", 'tpch.orders' AS "$banco_origem" FROM orders"""
)
def full_load_flat(spark: SparkSession, folder: str) -> DataFrame:
    dataset = f"{work_folder(spark, 'flat')}/raw/orders"
    result = full_load(table(spark, folder, "orders"), dataset, lineage=Metadata().lineage("tpch.orders", NOW))
    return landed(spark, result)


@workload("SELECT * FROM documents")
def full_load_flat_text(spark: SparkSession, folder: str) -> DataFrame:
    """Long text columns, landed whole."""
    dataset = f"{work_folder(spark, 'text')}/raw/documents"
    return landed(spark, full_load(table(spark, folder, "documents"), dataset))


@workload("SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def full_load_year(spark: SparkSession, folder: str) -> DataFrame:
    dataset = f"{work_folder(spark, 'year')}/raw/orders"
    layout = Partitioning("o_orderdate", "year")
    return landed(spark, full_load(table(spark, folder, "orders"), dataset, partitioning=layout))


@workload(
    """SELECT *, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
    FROM lineitem"""
)
def full_load_month(spark: SparkSession, folder: str) -> DataFrame:
    dataset = f"{work_folder(spark, 'month')}/raw/lineitem"
    layout = Partitioning("l_shipdate", "month")
    return landed(spark, full_load(table(spark, folder, "lineitem"), dataset, partitioning=layout))


@workload(
    """SELECT *, '2024-02-01T00:00:00' AS "$data_ingestao", 'app.events' AS "$banco_origem",
        CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
    FROM events"""
)
def full_load_day(spark: SparkSession, folder: str) -> DataFrame:
    dataset = f"{work_folder(spark, 'day')}/raw/events"
    result = full_load(
        table(spark, folder, "events"),
        dataset,
        partitioning=Partitioning("ts", "day"),
        lineage=Metadata().lineage("app.events", NOW),
    )
    return landed(spark, result)


@workload("SELECT *, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month FROM events")
def full_load_clustered(spark: SparkSession, folder: str) -> DataFrame:
    """A source that already follows its date: partitioned without a shuffle."""
    dataset = f"{work_folder(spark, 'clustered')}/raw/events"
    layout = Partitioning("ts", "month")
    return landed(spark, full_load(table(spark, folder, "events"), dataset, partitioning=layout, clustered=True))


@workload(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate AS placed,
        CAST(year(o_orderdate) AS INTEGER) AS year
    FROM orders WHERE o_orderpriority <> '1-URGENT'"""
)
def full_load_null_partition(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose partition date is NULL are dropped."""
    placed = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate"))
    source = table(spark, folder, "orders").withColumn("placed", placed).drop("o_orderdate")
    dataset = f"{work_folder(spark, 'nulls')}/raw/orders"
    return landed(spark, full_load(source, dataset, partitioning=Partitioning("placed", "year")))


@workload("SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_orderstatus <> 'P'")
def full_load_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """A second full load with fewer rows replaces the first one completely."""
    orders = table(spark, folder, "orders")
    dataset = f"{work_folder(spark, 'rerun')}/raw/orders"
    layout = Partitioning("o_orderdate", "year")
    full_load(orders, dataset, partitioning=layout)
    return landed(spark, full_load(orders.filter("o_orderstatus <> 'P'"), dataset, partitioning=layout))


@workload(
    """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders"""
)
def full_load_relayout(spark: SparkSession, folder: str) -> DataFrame:
    """Flat, then by year, then by month on the same dataset: only the last layout remains."""
    orders = table(spark, folder, "orders")
    dataset = f"{work_folder(spark, 'relayout')}/raw/orders"
    full_load(orders, dataset)
    full_load(orders, dataset, partitioning=Partitioning("o_orderdate", "year"))
    return landed(spark, full_load(orders, dataset, partitioning=Partitioning("o_orderdate", "month")))


@workload("SELECT * FROM orders")
def full_load_failure_keeps_data(spark: SparkSession, folder: str) -> DataFrame:
    """A load that fails while writing leaves the previous data in place."""
    orders = table(spark, folder, "orders")
    dataset = f"{work_folder(spark, 'failure')}/raw/orders"
    first = full_load(orders, dataset)
    broken = F.when(F.col("o_orderpriority") == "5-LOW", F.raise_error(F.lit("source lost"))).otherwise("")
    try:
        full_load(orders.withColumn("o_orderpriority", broken), dataset)
    except PySparkException:
        pass
    return landed(spark, first)


@workload(
    f"""SELECT q.*, '2024-02-01T00:00:00' AS "$data_ingestao", 'tpch.customer_orders' AS "$banco_origem"
    FROM ({CUSTOMER_ORDERS.format(orders="orders", customer="customer")}) q"""
)
def full_load_query(spark: SparkSession, folder: str) -> DataFrame:
    """A user query with a join; Catalyst plans it together with the load."""
    frames = {name: table(spark, folder, name) for name in ("orders", "customer")}
    source = read_query(spark, CUSTOMER_ORDERS, **frames)
    dataset = f"{work_folder(spark, 'query')}/raw/customer_orders"
    return landed(spark, full_load(source, dataset, lineage=Metadata().lineage("tpch.customer_orders", NOW)))


@workload("SELECT *, '2024-02-01T00:00:00' AS ingested_at FROM customer")
def metadata_custom_names(spark: SparkSession, folder: str) -> DataFrame:
    """One lineage column renamed, the other off."""
    metadata = Metadata(ingestion=LineageColumn(column_name=" ingested_at "), origin=LineageColumn(enabled=False))
    dataset = f"{work_folder(spark, 'lineage')}/raw/customer"
    source = table(spark, folder, "customer")
    return landed(spark, full_load(source, dataset, lineage=metadata.lineage("tpch.customer", NOW)))


@workload(
    """SELECT strftime(o_orderdate, 'year=%Y/month=%m') AS partition_path, count(*) AS rows
    FROM orders GROUP BY 1""",
    name="partition_counts",
)
def partition_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    dataset = f"{work_folder(spark, 'counts')}/raw/orders"
    result = full_load(table(spark, folder, "orders"), dataset, partitioning=Partitioning("o_orderdate", "month"))
    return partition_counts(landed(spark, result), "month").select("partition_path", "rows")


@workload(
    f"""SELECT count(*) AS rows, CAST(0 AS BIGINT) AS rows_over_cap,
        CASE WHEN count(*) > {ROWS_PER_FILE} THEN 1 ELSE 0 END AS was_cut FROM lineitem"""
)
def file_row_cap(spark: SparkSession, folder: str) -> DataFrame:
    """No flat file holds more rows than asked; all rows arrive."""
    dataset = f"{work_folder(spark, 'cap')}/raw/lineitem"
    return _cap_report(spark, full_load(table(spark, folder, "lineitem"), dataset, max_rows_per_file=ROWS_PER_FILE))


@workload(
    f"""SELECT count(*) AS rows, CAST(0 AS BIGINT) AS rows_over_cap,
        CASE WHEN count(*) > {ROWS_PER_FILE} THEN 1 ELSE 0 END AS was_cut FROM lineitem"""
)
def file_row_cap_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """The same per partition."""
    dataset = f"{work_folder(spark, 'cap_year')}/raw/lineitem"
    result = full_load(
        table(spark, folder, "lineitem"),
        dataset,
        partitioning=Partitioning("l_shipdate", "year"),
        max_rows_per_file=ROWS_PER_FILE,
    )
    return _cap_report(spark, result)


def _cap_report(spark: SparkSession, result) -> DataFrame:
    over = F.when(F.col("rows") > ROWS_PER_FILE, F.col("rows") - ROWS_PER_FILE).otherwise(0)
    return file_counts(landed(spark, result)).agg(
        F.sum("rows").alias("rows"),
        F.sum(over).alias("rows_over_cap"),
        F.when(F.count(F.lit(1)) > 1, 1).otherwise(0).alias("was_cut"),
    )


@workload(
    """SELECT count(*) FILTER (WHERE o_orderpriority <> '1-URGENT') AS rows_written,
        count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS rows_dropped_null,
        count(DISTINCT CASE WHEN o_orderpriority <> '1-URGENT' THEN year(o_orderdate) END) AS partitions
    FROM orders"""
)
def load_report(spark: SparkSession, folder: str) -> DataFrame:
    """The counters of a load, taken while it writes."""
    placed = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate"))
    source = table(spark, folder, "orders").withColumn("placed", placed)
    dataset = f"{work_folder(spark, 'report')}/raw/orders"
    result = full_load(source, dataset, partitioning=Partitioning("placed", "year"))
    return spark.range(1).select(
        F.lit(result.rows).cast("long").alias("rows_written"),
        F.lit(result.rows_dropped_null).cast("long").alias("rows_dropped_null"),
        F.lit(result.partitions).cast("long").alias("partitions"),
    )


@workload("SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) <> 1999")
def delete_one_partition(spark: SparkSession, folder: str) -> DataFrame:
    dataset = f"{work_folder(spark, 'delete')}/raw/orders"
    result = full_load(table(spark, folder, "orders"), dataset, partitioning=Partitioning("o_orderdate", "year"))
    delete_partition(spark, dataset, "year=1999")
    return read_landed(spark, dataset, result.schema)


@workload("SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) <> 1998")
def delete_table_partition_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    """A partition of a catalog table over a landed dataset: gone from the table and from the folder."""
    dataset = f"{work_folder(spark, 'catalog')}/raw/orders"
    result = full_load(table(spark, folder, "orders"), dataset, partitioning=Partitioning("o_orderdate", "year"), versioned=False)
    name = f"orders_{uuid.uuid4().hex[:12]}"
    spark.catalog.createTable(name, path=dataset, source="parquet")
    spark.catalog.recoverPartitions(name)
    delete_table_partition(spark, name, "year=1998")
    left = {path for path, in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    spark.sql(f"DROP TABLE {name}")
    return read_landed(spark, dataset, result.schema).where(F.concat(F.lit("year="), "year").isin(*left))


@workload(
    """SELECT 1 AS step, count(*) AS rows FROM orders
    UNION ALL SELECT 2, 0
    UNION ALL SELECT 3, count(*) FROM orders"""
)
def full_load_empty(spark: SparkSession, folder: str) -> DataFrame:
    """An empty source empties the dataset, which keeps its columns; the next load fills it again."""
    orders = table(spark, folder, "orders")
    steps, counts = (orders, orders.where("o_orderkey IS NULL"), orders), None
    for step, source in enumerate(steps, 1):
        # A dataset for each step's last state: the loads up to it run in turn.
        dataset = f"{work_folder(spark, f'empty-{step}')}/raw/orders"
        for earlier in steps[: step - 1]:
            full_load(earlier, dataset)
        rows = landed(spark, full_load(source, dataset)).groupBy().agg(F.count("*").alias("rows"))
        rows = rows.select(F.lit(step).alias("step"), "rows")
        counts = rows if counts is None else counts.unionByName(rows)
    return counts

"""What Spark does for a load: pushdown, shuffles, and how a hot partition is spread."""

from pathlib import Path
from collections import Counter
from datetime import date

import pytest
from helpers import files
from pyspark.sql import Observation
from pyspark.sql import functions as F

from haulier import Partitioning, WatermarkTable, append_new, full_load
from haulier.functions.periods import window_bounds
from haulier.operators import landing
from haulier.operators.shape import PERIOD, keep_window
from haulier.plans.jobs import new_rows
from haulier.state.watermarks import Watermark

LINEITEM = "/root/testdata/sf0.001/lineitem.parquet"
YEAR = Partitioning("l_shipdate", "year")
LINEAGE = {"$data_ingestao": "2024-02-01T00:00:00", "$banco_origem": "tpch.lineitem"}


def plan(frame):
    mode = frame._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return frame._jdf.queryExecution().explainString(mode)


def written(source, partitioning=None, track=None, clustered=False):
    measures = landing.tracked_measures(source, track)
    rows = source.observe(Observation(), *measures) if measures else source
    shuffle = partitioning is not None and not clustered
    return plan(landing.staging_plan(rows, partitioning, LINEAGE, shuffle, track)[0])


@pytest.fixture
def lineitem(spark):
    return spark.read.parquet(LINEITEM)


def test_flat_and_clustered_loads_do_not_shuffle(lineitem):
    assert "Exchange" not in written(lineitem, track="l_shipdate")
    assert "Exchange" not in written(lineitem, YEAR, clustered=True)


def test_partitioned_load_shuffles_once_without_constants(lineitem):
    text = written(lineitem, YEAR, track="l_shipdate")
    assert text.count("REBALANCE_PARTITIONS_BY_COL") == 1
    exchange = text[text.index(") Exchange\n") :]
    shipped = exchange[: exchange.index("Arguments")]
    assert PERIOD in shipped and "$banco_origem" not in shipped and "year" not in shipped


def test_gathered_appends_shuffle_by_the_reference_column_without_a_sort(lineitem):
    text = plan(landing.staging_plan(lineitem, None, LINEAGE, True, "l_shipdate")[0])
    assert "REBALANCE_PARTITIONS_BY_COL" in text and "hashpartitioning(l_shipdate" in text
    assert "RoundRobin" not in text and "Sort" not in text


def test_replace_window_reaches_the_scan(lineitem):
    first, end = window_bounds(date(2000, 6, 15), "year", 2)
    text = written(keep_window(lineitem, YEAR, first, end), YEAR)
    assert "GreaterThanOrEqual(l_shipdate,1999-01-01T00:00)" in text
    assert "LessThan(l_shipdate,2001-01-01T00:00)" in text


def test_append_bounds_reach_the_scan(lineitem):
    known = Watermark("raw.t", "l_shipdate", "2000-06-30 00:00:00", "timestamp", 1, 1)
    text = written(new_rows(lineitem, "l_shipdate", known, "2001-01-01"), YEAR, track="l_shipdate")
    assert "GreaterThan(l_shipdate,2000-06-30T00:00)" in text
    assert "LessThanOrEqual(l_shipdate,2001-01-01T00:00)" in text
    known = Watermark("raw.t", "l_orderkey", "100", "int", 1, 1)
    assert "GreaterThan(l_orderkey,100)" in written(new_rows(lineitem, "l_orderkey", known), track="l_orderkey")


def test_only_asked_columns_are_read(lineitem):
    text = written(lineitem.select("l_orderkey", "l_shipdate"), YEAR)
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in text


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_year_is_written_by_many_tasks(spark, dataset, adaptive):
    """All but a few rows in one year: no single task may write them all."""
    day = F.when(F.col("id") % 1000 == 0, F.lit(date(2023, 1, 1))).otherwise(F.lit(date(2024, 1, 1)))
    rows = spark.range(0, 400_000, 1, 16).select(
        "id", day.alias("d"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    )
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        result = full_load(rows, dataset, partitioning=Partitioning("d", "year"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = [f for f in files(dataset) if f.startswith("year=2024")]
    assert result.rows == 400_000 and len(hot) >= 4
    back = spark.read.parquet(dataset)
    assert back.count() == back.select("id").distinct().count() == 400_000
    largest = back.groupBy(F.input_file_name().alias("f")).count().agg(F.max("count").alias("n")).first().n
    assert largest < 200_000


def test_few_new_rows_from_many_tasks_make_few_files(spark, tmp_path):
    """A flat append reads with 64 tasks; each finds new rows, yet no 64 files are added."""
    state = WatermarkTable(spark, str(tmp_path / "state"))
    rows = spark.range(0, 6400, 1, 64).select("id", (F.col("id") % 100).alias("tick"))
    options = {"task_identifier": "raw.t", "reference_column": "tick", "watermarks": state}
    append_new(rows.filter("tick < 90"), str(tmp_path / "t"), **options)
    result = append_new(rows, str(tmp_path / "t"), **options)
    assert result.rows == 640 and result.files < 8
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6400
    assert append_new(rows, str(tmp_path / "t"), **options).rows == 0


def test_without_aqe_a_period_gets_the_tasks_it_is_worth(spark, dataset):
    """One day holds most rows: it is split; each of the thin days is one file, not one per task."""
    rows = spark.sql(
        """SELECT id, CASE WHEN id < 9000 THEN DATE'2024-01-01' ELSE DATE_ADD(DATE'2024-01-02', CAST(id % 50 AS INT)) END AS d
        FROM range(0, 10000, 1, 8)"""
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        result = full_load(rows, dataset, partitioning=Partitioning("d", "day"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    per_day = Counter(Path(f).parent.name + Path(f).parent.parent.name for f in files(dataset))
    hot = per_day.pop("day=01month=01")
    assert 4 <= hot <= 8 and set(per_day.values()) == {1} and len(per_day) == 50
    assert result.rows == 10000

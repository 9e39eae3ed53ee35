"""Full loads: layout, lineage, guards, and what survives a failure."""

from datetime import date, datetime
from pathlib import Path

import pytest
from helpers import content, failing, files, folders, leftovers, values
from pyspark.sql import functions as F

from haulier import LayoutError, Partitioning, SchemaError, full_load
from haulier.operators import landing
from haulier.operators.storage import Storage
from haulier.operators.summary import file_counts, partition_counts

COLUMNS = "id INT, d DATE"
ROWS = ("1, DATE'2024-01-31'", "2, DATE'2024-02-01'", "3, NULL", "4, DATE'2023-12-31'")
DAY = Partitioning("d", "day")


def test_flat(spark, dataset):
    result = full_load(values(spark, COLUMNS, *ROWS), dataset)
    assert (result.rows, result.partitions, result.rows_dropped_null) == (4, 0, 0)
    assert result.files == len(files(dataset)) and result.bytes > 0
    assert [r[0] for r in content(spark, result)] == [1, 2, 3, 4]
    assert leftovers(dataset) == []


@pytest.mark.parametrize("clustered", [False, True])
@pytest.mark.parametrize(
    ("granularity", "paths"),
    [
        ("year", ["year=2023", "year=2024"]),
        ("month", ["year=2023/month=12", "year=2024/month=01", "year=2024/month=02"]),
        ("day", ["year=2023/month=12/day=31", "year=2024/month=01/day=31", "year=2024/month=02/day=01"]),
    ],
)
def test_partitioned_layout_drops_null_dates(spark, dataset, granularity, paths, clustered):
    result = full_load(
        values(spark, COLUMNS, *ROWS), dataset, partitioning=Partitioning("d", granularity), clustered=clustered
    )
    assert folders(dataset) == paths
    assert (result.rows, result.rows_dropped_null, result.partitions) == (3, 1, len(paths))
    # partition values live in the path only
    assert spark.read.parquet(str(Path(dataset) / files(dataset)[0])).columns == ["id", "d"]
    first = content(spark, result)[0]
    assert first[:3] == (1, date(2024, 1, 31), 2024)


def test_lineage_comes_last_as_text(spark, dataset):
    lineage = {"$data_ingestao": "2024-02-01T00:00:00", "$banco_origem": "public.t"}
    result = full_load(values(spark, COLUMNS, *ROWS), dataset, partitioning=DAY, lineage=lineage)
    assert result.schema.names == ["id", "d", "$data_ingestao", "$banco_origem", "year", "month", "day"]
    assert {r[2:4] for r in content(spark, result)} == {("2024-02-01T00:00:00", "public.t")}


def test_partition_by_zoned_and_zoneless_timestamps(spark, dataset):
    frame = values(spark, "id INT, z TIMESTAMP", "1, TIMESTAMP'2023-12-31 23:30:00-03:00'")
    full_load(frame, dataset, partitioning=Partitioning("z", "day"))
    assert folders(dataset) == ["year=2024/month=01/day=01"]
    frame = values(spark, "id INT, z TIMESTAMP_NTZ", "1, TIMESTAMP_NTZ'2023-12-31 23:30:00'")
    full_load(frame, dataset, partitioning=Partitioning("z", "day"))
    assert folders(dataset) == ["year=2023/month=12/day=31"]


@pytest.mark.parametrize("partitioning", [None, DAY])
def test_empty_source_empties_the_dataset(spark, dataset, partitioning):
    full_load(values(spark, COLUMNS, *ROWS), dataset, partitioning=partitioning)
    result = full_load(values(spark, COLUMNS), dataset, partitioning=partitioning)
    assert (result.rows, content(spark, result)) == (0, [])
    assert result.schema.names[:2] == ["id", "d"]
    assert len(files(dataset)) == (1 if partitioning is None else 0)


def test_only_null_dates_land_nothing(spark, dataset):
    result = full_load(values(spark, COLUMNS, "1, NULL", "2, NULL"), dataset, partitioning=DAY)
    assert (result.rows, result.rows_dropped_null, result.files) == (0, None, 0)


@pytest.mark.parametrize("partitioning", [None, Partitioning("d", "year")])
def test_rows_per_file(spark, dataset, partitioning):
    frame = spark.range(0, 2500, 1, 2).select("id", F.lit(date(2024, 5, 5)).alias("d"))
    result = full_load(frame, dataset, partitioning=partitioning, max_rows_per_file=400)
    counts = [r.rows for r in file_counts(spark.read.parquet(dataset)).collect()]
    assert sum(counts) == result.rows == 2500
    assert max(counts) <= 400 and len(counts) == result.files


def test_partition_summary(spark, dataset):
    result = full_load(values(spark, COLUMNS, *ROWS), dataset, partitioning=Partitioning("d", "month"))
    summary = partition_counts(spark.read.parquet(dataset), "month").orderBy("partition_path").collect()
    assert [tuple(r) for r in summary] == [
        ("year=2023/month=12", 1, 1),
        ("year=2024/month=01", 1, 1),
        ("year=2024/month=02", 1, 1),
    ]
    assert result.partitions == 3


def test_failure_keeps_old_data(spark, dataset):
    rows = values(spark, COLUMNS, *ROWS)
    first = full_load(rows, dataset, partitioning=DAY)
    before = files(dataset)
    with pytest.raises(Exception, match="lost the source"):
        full_load(failing(rows), dataset, partitioning=DAY)
    assert files(dataset) == before and leftovers(dataset) == []
    assert len(content(spark, first)) == 3


def test_stale_staging_is_cleared(spark, dataset):
    stale = Path(dataset) / "_tmp"
    stale.mkdir(parents=True)
    (stale / "part-junk.parquet").write_text("junk")
    assert full_load(values(spark, COLUMNS, *ROWS), dataset).rows == 4
    assert len(content(spark, dataset)) == 4


@pytest.mark.parametrize("step", [1, 2, 3, 4])
def test_crash_during_swap(spark, dataset, monkeypatch, step):
    """Whichever file operation is the last one before the crash, the next start has whole data."""
    old, new = values(spark, COLUMNS, *ROWS), values(spark, COLUMNS, "9, DATE'2025-01-01'")
    result = full_load(old, dataset)
    calls = {"left": step}

    def crash(operation):
        def run(self, *args):
            if calls["left"] == 0:
                raise KeyboardInterrupt
            calls["left"] -= 1
            return operation(self, *args)

        return run

    staging = landing.open_staging(spark, dataset)
    landing.stage(new, staging)
    with monkeypatch.context() as patch:
        patch.setattr(Storage, "rename", crash(Storage.rename))
        patch.setattr(Storage, "delete", crash(Storage.delete))
        try:
            landing.commit_swap(spark, dataset)
        except KeyboardInterrupt:
            pass
    landing.open_staging(spark, dataset)
    landing.discard_staging(spark, dataset)
    ids = [r[0] for r in content(spark, result)]
    assert ids == ([1, 2, 3, 4] if step < 3 else [9])
    assert leftovers(dataset) == []


@pytest.mark.parametrize(
    ("columns", "row", "partitioning", "lineage"),
    [
        ("id INT, d STRING", "1, '2024-01-01'", DAY, {}),
        ("id INT, d INT", "1, 20240101", DAY, {}),
        ("id INT, D DATE", "1, DATE'2024-01-01'", DAY, {}),
        ("year INT, d DATE", "1, DATE'2024-01-01'", DAY, {}),
        ("Month INT, d DATE", "1, DATE'2024-01-01'", DAY, {}),
        ("id INT, d DATE", "1, DATE'2024-01-01'", DAY, {"day": "x"}),
        ("id INT, d DATE", "1, DATE'2024-01-01'", None, {"ID": "x"}),
        ("id INT, d DATE", "1, DATE'2024-01-01'", None, {"a": "x", "A": "y"}),
    ],
)
def test_refused_before_any_job(spark, dataset, columns, row, partitioning, lineage):
    full_load(values(spark, COLUMNS, *ROWS), dataset)
    with pytest.raises(SchemaError):
        full_load(failing(values(spark, columns, row)), dataset, partitioning=partitioning, lineage=lineage)
    assert len(content(spark, dataset)) == 4


def test_own_month_column_is_fine_below_the_path(spark, dataset):
    frame = values(spark, "month INT, d DATE", "7, DATE'2024-01-01'")
    result = full_load(frame, dataset, partitioning=Partitioning("d", "year"))
    assert content(spark, result) == [(7, date(2024, 1, 1), 2024)]


def test_delete_partition(spark, dataset):
    result = full_load(values(spark, COLUMNS, *ROWS), dataset, partitioning=Partitioning("d", "year"))
    landing.delete_partition(spark, dataset, "year=2024")
    landing.delete_partition(spark, dataset, "year=1999")
    assert [r[0] for r in content(spark, result)] == [4]
    with pytest.raises(LayoutError):
        landing.delete_partition(spark, dataset, "/")


def test_source_columns_that_differ_by_case_only(spark, dataset):
    rows = values(spark, COLUMNS, *ROWS)
    with pytest.raises(SchemaError, match="apart"):
        full_load(rows.select("*", F.col("id").alias("ID")), dataset)
    assert not files(dataset) if Path(dataset).exists() else True


@pytest.mark.parametrize("path", ["/", "/tmp/raw/t*", "/tmp/{raw}/t"])
def test_unusable_dataset_paths(spark, path):
    with pytest.raises(LayoutError):
        full_load(values(spark, COLUMNS, *ROWS), path)


def test_names_with_dots_and_quotes(spark, dataset):
    frame = spark.sql("SELECT 1 AS `a.b`, 2 AS `q``x`, TIMESTAMP_NTZ'2024-01-01 01:02:03' AS `when at`")
    result = full_load(frame, dataset, partitioning=Partitioning("when at", "year"))
    assert content(spark, result) == [(1, 2, datetime(2024, 1, 1, 1, 2, 3), 2024)]

"""Rebuilding a window of partitions."""

from datetime import date
from pathlib import Path

import pytest
from helpers import content, failing, files, folders, leftovers, values
from pyspark.sql import functions as F

from haulier import LayoutError, Partitioning, SchemaError, full_load, replace_window
from haulier.operators import landing
from haulier.operators.storage import Storage

COLUMNS = "id INT, d DATE"
YEAR, MONTH = Partitioning("d", "year"), Partitioning("d", "month")
OLD = ("1, DATE'2021-05-05'", "2, DATE'2022-05-05'", "3, DATE'2023-05-05'", "4, DATE'2024-05-05'", "5, DATE'2025-05-05'")


def replace(rows, dataset, **options):
    merged = {"partitioning": YEAR, "lookback_periods": 2, "as_of": date(2024, 6, 15), **options}
    return replace_window(rows, dataset, **merged)


def test_window_is_rebuilt_and_the_rest_stays(spark, dataset):
    first = full_load(values(spark, COLUMNS, *OLD), dataset, partitioning=YEAR)
    source = values(spark, COLUMNS, "10, DATE'2022-12-31'", "11, DATE'2023-01-01'", "12, DATE'2024-12-31'", "13, DATE'2025-01-01'", "14, NULL")
    result = replace(source, dataset)
    # 2022 and 2025 lie outside: neither the old rows nor the new ones are touched
    assert [r[0] for r in content(spark, first)] == [1, 11, 12, 2, 5]
    assert (result.rows, result.partitions, result.partitions_removed) == (2, 2, ())
    assert leftovers(dataset) == []


def test_partition_without_rows_is_removed(spark, dataset):
    first = full_load(values(spark, COLUMNS, *OLD), dataset, partitioning=YEAR)
    result = replace(values(spark, COLUMNS, "11, DATE'2023-01-01'"), dataset)
    assert result.partitions_removed == ("year=2024",)
    assert [r[0] for r in content(spark, first)] == [1, 11, 2, 5]
    result = replace(values(spark, COLUMNS), dataset)
    assert (result.rows, result.partitions_removed) == (0, ("year=2023",))
    assert folders(dataset) == ["year=2021", "year=2022", "year=2025"]


def test_month_window_across_a_year(spark, dataset):
    days = spark.sql("SELECT id, date_add(DATE'2023-10-01', CAST(id AS INT)) AS d FROM range(0, 180)")
    full_load(days, dataset, partitioning=MONTH)
    result = replace(days.withColumn("id", F.col("id") + 1000), dataset, partitioning=MONTH, lookback_periods=3, as_of=date(2024, 1, 31))
    got = spark.read.parquet(dataset)
    assert result.rows == 30 + 31 + 31 == got.filter("id >= 1000").count()
    assert got.count() == 180
    assert {(r.year, r.month) for r in got.filter("id >= 1000").select("year", "month").distinct().collect()} == {(2023, 11), (2023, 12), (2024, 1)}


def test_new_dataset(spark, dataset):
    result = replace(values(spark, COLUMNS, *OLD), dataset)
    assert [r[0] for r in content(spark, result)] == [3, 4]


def test_failure_keeps_the_window(spark, dataset):
    rows = values(spark, COLUMNS, *OLD)
    full_load(rows, dataset, partitioning=YEAR)
    before = files(dataset)
    with pytest.raises(Exception, match="lost the source"):
        replace(failing(rows), dataset)
    assert files(dataset) == before and leftovers(dataset) == []


def test_layouts_do_not_mix(spark, dataset):
    rows = values(spark, COLUMNS, *OLD)
    full_load(rows, dataset)
    with pytest.raises(LayoutError):
        replace(rows, dataset)
    full_load(rows, dataset, partitioning=MONTH)
    with pytest.raises(LayoutError):
        replace(rows, dataset)
    assert len(content(spark, dataset)) == 5
    (Path(dataset) / "stray.parquet").write_bytes((Path(dataset) / files(dataset)[0]).read_bytes())
    with pytest.raises(LayoutError, match="mixes"):
        landing.dataset_layout(spark, dataset)


def test_types_may_only_change_when_everything_is_rebuilt(spark, dataset):
    full_load(values(spark, COLUMNS, *OLD), dataset, partitioning=YEAR)
    wider = values(spark, "id LONG, d DATE", *OLD)
    with pytest.raises(SchemaError, match="id: int -> bigint"):
        replace(wider, dataset)
    assert replace(wider, dataset, lookback_periods=5, as_of=date(2025, 1, 1)).rows == 5


@pytest.mark.parametrize("step", range(1, 7))
def test_crash_during_the_exchange(spark, dataset, monkeypatch, step):
    """Every partition is wholly old or wholly new, and a rerun finishes the job."""
    first = full_load(values(spark, COLUMNS, *OLD), dataset, partitioning=YEAR)
    new = values(spark, COLUMNS, "31, DATE'2023-01-01'", "41, DATE'2024-01-01'")
    staging = landing.open_staging(spark, dataset)
    landing.stage(new, staging, partitioning=YEAR)
    calls = {"left": step}

    def crash(operation):
        def run(self, *args):
            if calls["left"] == 0:
                raise KeyboardInterrupt
            calls["left"] -= 1
            return operation(self, *args)

        return run

    with monkeypatch.context() as patch:
        patch.setattr(Storage, "rename", crash(Storage.rename))
        patch.setattr(Storage, "delete", crash(Storage.delete))
        try:
            landing.commit_partitions(spark, dataset, "year", ["year=2023", "year=2024"])
        except KeyboardInterrupt:
            pass
    landing.discard_staging(spark, dataset)
    ids = [r[0] for r in content(spark, first)]
    assert len(ids) == 5
    assert set(ids) in [{1, 2, 5, *pair} for pair in ((3, 4), (31, 4), (3, 41), (31, 41))]
    replace(new, dataset)
    assert sorted(r[0] for r in content(spark, first)) == [1, 2, 5, 31, 41]
    assert leftovers(dataset) == []


@pytest.mark.parametrize("layout", [YEAR, Partitioning("d", "month")])
def test_crash_inside_the_deletion_of_replaced_partitions(spark, dataset, monkeypatch, layout):
    """A deletion that stops half-way never brings back a part of a partition, also after the window has moved on."""
    old = [f"{i}, DATE'2023-0{1 + i % 2}-1{i % 10}'" for i in range(10)]
    first = full_load(values(spark, COLUMNS, *old), dataset, partitioning=layout, max_rows_per_file=1)
    delete = Storage.delete

    def half(self, relative=""):
        if relative in ("_old", "_gone") and self.exists(relative):
            for file in sorted(p for p in (Path(dataset) / relative).rglob("*.parquet"))[::2]:
                file.unlink()
            raise KeyboardInterrupt
        return delete(self, relative)

    gone = {"year": ["year=2023"], "month": ["year=2023/month=01", "year=2023/month=02"]}[layout.granularity]
    landing.open_staging(spark, dataset)
    landing.stage(values(spark, COLUMNS, "70, DATE'2024-05-05'"), f"{dataset}/_tmp", partitioning=layout)
    with monkeypatch.context() as patch:
        patch.setattr(Storage, "delete", half)
        with pytest.raises(KeyboardInterrupt):
            landing.commit_partitions(spark, dataset, layout.granularity, gone)
    new = values(spark, COLUMNS, "71, DATE'2024-06-05'")
    replace_window(new, dataset, partitioning=layout, lookback_periods=1, as_of=date(2024, 6, 1))
    ids = sorted(r[0] for r in content(spark, first))
    assert ids in ([70, 71], [71]) and leftovers(dataset) == []

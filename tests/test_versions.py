"""Commits by versions: crashes, readers, conflicts, and the same results as commits by renames."""

import threading
from datetime import date
from pathlib import Path

import pytest
from helpers import content, failing, values
from test_workloads import FOLDER, ORACLES, QUERIES, duck, rows  # noqa: F401

from haulier import CommitError, LayoutError, Partitioning, WatermarkTable, append_new, full_load, read_landed, replace_window
from haulier.operators import landing, versions
from haulier.operators.storage import Storage

COLUMNS = "id INT, d DATE"
OLD = ["1, DATE'2023-05-01'", "2, DATE'2024-01-01'", "3, DATE'2024-02-01'"]
YEAR = Partitioning("d", "year")
MONTH = Partitioning("d", "month")


@pytest.fixture
def by_versions(spark):
    spark.conf.set(versions.SETTING, "versions")
    yield
    spark.conf.unset(versions.SETTING)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("full_load", "replace", "append", "file_row", "partition_counts", "delete_one", "load_report"))))
def test_loads_give_the_same_by_versions(spark, duck, by_versions, name):  # noqa: F811
    frame = QUERIES[name](spark, FOLDER)
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = duck.execute(ORACLES[name])
    assert got == rows([d[0] for d in cursor.description], cursor.fetchall())


def ids(spark, result):
    return [r[0] for r in content(spark, result)]


OPERATIONS = ["create_text", "delete", "delete_all", "glob", "read_text_or_none", "read_text", "make_folder", "rename"]


class Crash(BaseException):
    pass


def crashing(monkeypatch, step):
    """The file operation after ``step`` others dies, before it does anything; once it has, all do."""
    calls = {"left": step}

    def wrap(operation):
        def run(self, *args):
            if calls["left"] <= 0:
                raise Crash
            calls["left"] -= 1
            return operation(self, *args)

        return run

    for name in OPERATIONS:
        monkeypatch.setattr(Storage, name, wrap(getattr(Storage, name)))
    return calls


@pytest.mark.parametrize("kind", ["full", "replace", "append"])
def test_a_crash_at_any_step_leaves_one_whole_version(spark, tmp_path, monkeypatch, kind):
    old, new = values(spark, COLUMNS, *OLD), values(spark, COLUMNS, "8, DATE'2024-01-05'", "9, DATE'2025-01-01'")

    def load(dataset, source):
        if kind == "full":
            return full_load(source, dataset, partitioning=YEAR, versioned=True)
        if kind == "replace":
            return replace_window(source, dataset, partitioning=YEAR, lookback_periods=2, as_of=date(2025, 6, 1), versioned=True)
        state = WatermarkTable(spark, f"{dataset}-state")
        return append_new(source, dataset, task_identifier="t", reference_column="d", watermarks=state, partitioning=YEAR, versioned=True)

    whole = {"full": [8, 9], "replace": [1, 8, 9], "append": [1, 2, 3, 9]}[kind]
    seen = set()
    for step in range(200):
        dataset = str(tmp_path / f"{kind}{step}")
        if kind == "append":
            load(dataset, old)
        else:
            full_load(old, dataset, partitioning=YEAR, versioned=True)
        with monkeypatch.context() as patch:
            calls = crashing(patch, step)
            try:
                result = load(dataset, new)
                finished = calls["left"] > 0
            except Crash:
                finished = False
        schema = landing.landed_schema(new.schema, {}, YEAR)
        now = sorted(r[0] for r in read_landed(spark, dataset, schema).collect())
        assert now in ([1, 2, 3], whole)
        seen.add(tuple(now))
        result = load(dataset, new)
        assert sorted(ids(spark, result)) == whole
        assert versions.current(spark, dataset).pending is None
        if finished:
            break
    assert finished and len(seen) == 2


def test_a_half_written_manifest_is_passed_over(spark, dataset, monkeypatch):
    monkeypatch.setattr(versions, "WRITE_SECONDS", 0.1)
    result = full_load(values(spark, COLUMNS, *OLD), dataset, versioned=True)
    broken = Path(dataset) / "_versions" / "00000002.json"
    broken.write_text('{"number": 2, "lo')
    assert ids(spark, result) == [1, 2, 3]
    result = full_load(values(spark, COLUMNS, "9, DATE'2025-01-01'"), dataset, versioned=True)
    assert ids(spark, result) == [9] and versions.current(spark, dataset).number == 3


def test_readers_go_on_while_loads_commit(spark, dataset):
    source = [values(spark, COLUMNS, *[f"{i}, DATE'2024-0{1 + i % 3}-01'" for i in range(10 * k, 10 * k + 10)]) for k in range(3)]
    full_load(source[0], dataset, partitioning=MONTH, versioned=True)
    reader = read_landed(spark, dataset)
    full_load(source[1], dataset, partitioning=MONTH)
    replace_window(source[2], dataset, partitioning=MONTH, lookback_periods=1, as_of=date(2024, 2, 9))
    assert sorted(r["id"] for r in reader.collect()) == list(range(10))


def test_readers_never_see_half_an_exchange(spark, dataset):
    """Each version holds one generation only; a reader in between must not mix them or fail."""
    def generation(k):
        return values(spark, "id INT, d DATE, g INT", *[f"{i}, DATE'2024-{m:02d}-01', {k}" for m in range(1, 13) for i in range(3)])

    full_load(generation(0), dataset, partitioning=MONTH, versioned=True)
    problems, done = [], threading.Event()

    def read():
        while not done.is_set():
            try:
                found = {(r["g"], r["count"]) for r in read_landed(spark, dataset).groupBy("g").count().collect()}
            except Exception as error:  # noqa: BLE001
                problems.append(error)
                return
            if len(found) != 1 or next(iter(found))[1] != 36:
                problems.append(found)

    readers = [threading.Thread(target=read) for _ in range(2)]
    for thread in readers:
        thread.start()
    for k in range(1, 7):
        replace_window(generation(k), dataset, partitioning=MONTH, lookback_periods=12, as_of=date(2024, 12, 31))
    done.set()
    for thread in readers:
        thread.join()
    assert problems == []


def test_of_two_loads_at_once_one_is_refused(spark, dataset):
    full_load(values(spark, COLUMNS, *OLD), dataset, versioned=True)
    base = versions.current(spark, dataset)
    versions.commit(spark, dataset, versions.Version(base.number + 1, None, base.loads))
    with pytest.raises(CommitError):
        versions.commit(spark, dataset, versions.Version(base.number + 1, None, {}))
    assert len(content(spark, dataset)) == 3


def test_a_failing_load_changes_nothing(spark, dataset):
    full_load(values(spark, COLUMNS, *OLD), dataset, versioned=True)
    with pytest.raises(Exception):  # noqa: B017
        full_load(failing(values(spark, COLUMNS, "9, DATE'2025-01-01'")), dataset)
    assert len(content(spark, dataset)) == 3
    assert len(list((Path(dataset) / "data").iterdir())) == 1


def test_old_versions_are_removed(spark, dataset):
    for k in range(6):
        result = full_load(values(spark, COLUMNS, f"{k}, DATE'2024-01-01'"), dataset, versioned=True)
    assert ids(spark, result) == [5]
    assert len(list((Path(dataset) / "data").iterdir())) == versions.KEPT
    assert len(list((Path(dataset) / "_versions").glob("*.json"))) == versions.KEPT
    for k in range(10, 14):
        replace_window(values(spark, COLUMNS, f"{k}, DATE'2024-01-01'"), dataset, partitioning=YEAR, lookback_periods=1, as_of=date(2024, 3, 1)) if k > 10 else full_load(
            values(spark, COLUMNS, "1, DATE'2023-01-01'", "2, DATE'2024-01-01'"), dataset, partitioning=YEAR
        )
    # The load of 2023 is live; its partition of 2024 was replaced long ago.
    folders = sorted(str(p.relative_to(dataset)) for p in (Path(dataset) / "data").glob("_load=*/year=*"))
    assert sum(f.endswith("year=2023") for f in folders) == 1 and sum(f.endswith("year=2024") for f in folders) == versions.KEPT


def appended(spark, dataset, source, **options):
    state = WatermarkTable(spark, f"{dataset}-state")
    return append_new(source, dataset, task_identifier="t", reference_column="id", watermarks=state, versioned=True, **options)


def test_an_append_makes_as_few_calls_for_many_files_as_for_one(spark, tmp_path, monkeypatch):
    counts = []
    for name, some in (("one", 1), ("many", 40)):
        dataset = str(tmp_path / name)
        appended(spark, dataset, spark.range(100).repartition(1), max_rows_per_file=None)
        calls = crashing(monkeypatch, 10_000)
        appended(spark, dataset, spark.range(100 + 10 * some).repartition(1), max_rows_per_file=10)
        monkeypatch.undo()
        counts.append(10_000 - calls["left"])
        assert read_landed(spark, dataset).count() == 100 + 10 * some
    assert counts[0] == counts[1]


def test_an_append_without_its_watermark_is_taken_back(spark, dataset, monkeypatch):
    appended(spark, dataset, spark.range(10))
    with monkeypatch.context() as patch:
        patch.setattr(WatermarkTable, "put", lambda *_: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            appended(spark, dataset, spark.range(15))
    assert read_landed(spark, dataset).count() == 15  # visible, but waiting
    result = appended(spark, dataset, spark.range(12))
    assert result.rows == 2 and result.files_undone > 0
    assert sorted(r[0] for r in content(spark, result)) == list(range(12))


def test_a_plain_dataset_becomes_versioned_by_a_full_load_only(spark, dataset):
    result = full_load(values(spark, COLUMNS, *OLD), dataset, partitioning=YEAR)
    with pytest.raises(LayoutError):
        replace_window(values(spark, COLUMNS, *OLD), dataset, partitioning=YEAR, lookback_periods=1, as_of=date(2024, 1, 1), versioned=True)
    result = full_load(values(spark, COLUMNS, "9, DATE'2025-01-01'"), dataset, versioned=True)
    assert ids(spark, result) == [9] and not list(Path(dataset).glob("year=*"))
    with pytest.raises(LayoutError):
        replace_window(values(spark, COLUMNS, *OLD), dataset, partitioning=YEAR, lookback_periods=1, as_of=date(2024, 1, 1))
    result = full_load(values(spark, COLUMNS, *OLD), dataset, versioned=False)
    assert len(content(spark, result)) == 3 and not versions.is_versioned(spark, dataset)


def test_partitions_are_pruned_in_the_paths(spark, dataset):
    full_load(values(spark, COLUMNS, *OLD), dataset, partitioning=MONTH, versioned=True)
    replace_window(values(spark, COLUMNS, "5, DATE'2024-02-03'"), dataset, partitioning=MONTH, lookback_periods=1, as_of=date(2024, 2, 20))
    landed = read_landed(spark, dataset)
    assert landed.columns == ["id", "d", "year", "month"]
    plan = landed.where("year = 2024 AND month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and [r["id"] for r in landed.where("year = 2024 AND month = 2").collect()] == [5]


def test_empty_versions(spark, dataset):
    empty = values(spark, COLUMNS)
    result = full_load(empty, dataset, partitioning=YEAR, versioned=True)
    assert content(spark, result) == []
    with pytest.raises(LayoutError):
        read_landed(spark, dataset)
    assert content(spark, full_load(empty, dataset)) == []

"""Watermark and execution tables, and whole tasks."""

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone

import pytest
from helpers import content, values

from haulier import ContractError, ExecutionTable, WatermarkTable, replicate, task_from_mapping
from haulier.__main__ import main
from haulier.session import LOAD_CONF
from haulier.sources.tables import resolve_query
from haulier.state.executions import HISTORY

NOW = datetime(2026, 8, 22, 0, 41, 33)


def test_watermark_versions(spark, tmp_path):
    table = WatermarkTable(spark, str(tmp_path))
    assert table.get("raw.t", "d") is None and table.current().count() == 0
    for n in range(1, 6):
        assert table.next_version("raw.t", "d") == n
        assert table.put("raw.t", "d", f"v{n}", "string", n) == n
    table.put("raw.t", "other", "x", "string", 0)
    got = table.get("raw.t", "d")
    assert (got.watermark_value, got.last_record_count, got.version) == ("v5", 5, 5)
    assert table.current().count() == 2
    # superseded versions go away
    assert len(list(tmp_path.glob("watermarks/*/version=*"))) == 3


def test_unfinished_watermark_write_is_skipped(spark, tmp_path):
    table = WatermarkTable(spark, str(tmp_path))
    table.put("raw.t", "d", "v1", "string", 1)
    folder = next(tmp_path.glob("watermarks/*"))
    (folder / "version=0000000002" / "_temporary").mkdir(parents=True)
    assert table.get("raw.t", "d").watermark_value == "v1"
    assert table.put("raw.t", "d", "v3", "string", 1) == 3
    assert table.get("raw.t", "d").watermark_value == "v3"


def test_execution_events(spark, tmp_path):
    table = ExecutionTable(spark, str(tmp_path))
    assert table.history().count() == 0 and table.history().schema == HISTORY
    good, bad, open_run = (table.start(name=n, mode="full_load") for n in ("good", "bad", "open"))
    good.update_rows(5)
    good.succeed(12)
    bad.fail()
    rows = {r.name: r for r in table.history().collect()}
    assert table.history().columns == HISTORY.names and len({good.id, bad.id, open_run.id}) == 3
    assert (rows["good"].status, rows["good"].rows_processed) == ("success", 12)
    assert (rows["bad"].status, rows["bad"].rows_processed) == ("error", 0)
    assert (rows["open"].status, rows["open"].finished_at) == ("running", None)
    seconds = (rows["good"].finished_at - rows["good"].started_at) / timedelta(seconds=1)
    assert rows["good"].duration_seconds == pytest.approx(seconds, abs=0.01)


def test_audit_failure_only_warns(spark, tmp_path, caplog):
    (tmp_path / "executions").write_text("not a folder")
    execution = ExecutionTable(spark, str(tmp_path)).start(name="x")
    execution.succeed(1)
    assert "could not be recorded" in caplog.text


def task(**sections):
    base = {
        "table": {"schema_name": "public", "name": "t", "target_schema_name": "raw", "target_name": "t"},
        "source": {"type": "parquet", "runtime": "src"},
        "target": {"type": "local", "runtime": "out"},
        "replication": {"mode": "full_load"},
    }
    return task_from_mapping({**base, **sections})


@pytest.fixture
def setup(spark, tmp_path):
    rows = values(spark, "id INT, d DATE", "1, DATE'2023-05-05'", "2, DATE'2024-05-05'")
    rows.write.parquet(str(tmp_path / "src" / "t.parquet"))
    return {
        "connections": {"src": {"path": str(tmp_path / "src")}, "out": {"path": str(tmp_path / "out")}},
        "state_root": str(tmp_path / "state"),
        "now": NOW,
    }


def history(spark, setup):
    return {r.status: r for r in ExecutionTable(spark, setup["state_root"]).history().collect()}


def test_full_load_task(spark, setup):
    result = replicate(spark, task(), **setup)
    assert result.dataset.endswith("/out/raw/t")
    assert content(spark, result)[0] == (1, date(2023, 5, 5), "2026-08-22T00:41:33", "public.t")
    record = history(spark, setup)["success"]
    assert (record.rows_processed, record.mode, record.target_runtime, record.strategy_type) == (2, "full_load", "out", None)


def test_replace_and_append_tasks(spark, setup):
    part = {"type": "year", "reference_column": "d"}
    replace = {"type": "replace", "reference_column": "d", "lookback_periods": 1}
    replacing = task(replication={"mode": "incremental", "strategy": replace, "partition": part}, metadata={"enabled": False})
    result = replicate(spark, replacing, as_of=date(2024, 12, 31), **setup)
    assert content(spark, result) == [(2, date(2024, 5, 5), 2024)]
    append = {"type": "append", "reference_column": "id", "aggregation": "MAX"}
    table = {"schema_name": None, "name": "t", "target_schema_name": "raw", "target_name": "t2"}
    appending = task(replication={"mode": "incremental", "strategy": append, "partition": part}, table=table)
    assert replicate(spark, appending, **setup).rows == 2
    again = replicate(spark, appending, **setup)
    assert (again.rows, again.watermark) == (0, "2")
    assert {r[3] for r in content(spark, again)} == {"t"}
    assert WatermarkTable(spark, setup["state_root"]).get("raw.t2", "id").watermark_type == "int"


def test_failed_task_is_recorded_with_no_rows(spark, setup):
    broken = task(replication={"mode": "full_load", "partition": {"type": "year", "reference_column": "nope"}})
    with pytest.raises(ValueError):
        replicate(spark, broken, **setup)
    record = history(spark, setup)["error"]
    assert (record.rows_processed, record.partition_reference_column) == (0, "nope")


@pytest.mark.parametrize("kind", ["oracle", "mongodb"])
def test_declared_but_unreadable_sources(spark, setup, kind):
    with pytest.raises(ContractError):
        replicate(spark, task(source={"type": kind, "runtime": "src"}), **setup)


def test_missing_settings(spark, setup):
    with pytest.raises(ContractError):
        replicate(spark, task(source={"type": "parquet", "runtime": "unknown"}), **setup)


def test_user_query_task(spark, setup, tmp_path):
    values(spark, "id INT, d DATE", "7, DATE'2024-01-01'", "8, DATE'2024-01-01'").createOrReplaceTempView("landing_input")
    (tmp_path / "queries").mkdir()
    (tmp_path / "queries" / "seven.sql").write_text("SELECT id\nFROM landing_input WHERE id % 2 = 1;\n")
    asked = task(source={"type": "table", "runtime": "src", "query_path": "seven.sql"}, metadata={"enabled": False})
    for queries in (str(tmp_path / "queries"), {"seven.sql": "SELECT id FROM landing_input WHERE id = 7"}):
        assert content(spark, replicate(spark, asked, queries=queries, **setup)) == [(7,)]
    for bad in ("", "  ", "other.sql"):
        with pytest.raises(ContractError):
            resolve_query(spark, {}, bad)


def test_catalog_table_and_given_frame(spark, setup):
    values(spark, "id INT, d DATE", "3, DATE'2024-01-01'").createOrReplaceTempView("plain_view")
    named = task(
        source={"type": "table", "runtime": "src"},
        table={"schema_name": None, "name": "plain_view", "target_schema_name": "raw", "target_name": "v"},
    )
    assert replicate(spark, named, **setup).rows == 1
    frame = values(spark, "id INT, d DATE", "4, DATE'2024-01-01'", "5, NULL")
    assert replicate(spark, named, source=frame, **setup).rows == 2


def test_tables_load_side_by_side(spark, setup):
    """Loads of different tables may run at once: they share the state folders, nothing else."""
    append = {"mode": "incremental", "strategy": {"type": "append", "reference_column": "id"}}

    def run(n):
        table = {"schema_name": "public", "name": "t", "target_schema_name": "raw", "target_name": f"t{n}"}
        return [replicate(spark, task(table=table, replication=append), **setup).rows for _ in range(2)]

    with ThreadPoolExecutor(6) as pool:
        assert list(pool.map(run, range(6))) == [[2, 0]] * 6
    records = ExecutionTable(spark, setup["state_root"]).history().groupBy("target_name", "status").count().collect()
    assert {tuple(r) for r in records} == {(f"t{n}", "success", 2) for n in range(6)}
    assert WatermarkTable(spark, setup["state_root"]).current().count() == 6


TASK_FILE = """
table: {schema_name: public, name: t, target_schema_name: raw, target_name: t}
source: {type: parquet, runtime: src}
target: {type: local, runtime: out, chunk_size: 200000}
replication:
  mode: incremental
  strategy: {type: replace, reference_column: d, lookback_periods: 2}
  partition: {type: year, reference_column: d}
"""


def test_command(spark, setup, tmp_path):
    before = {key: spark.conf.get(key) for key in LOAD_CONF}
    (tmp_path / "task.yaml").write_text(TASK_FILE)
    (tmp_path / "broken.yaml").write_text("table: [")
    (tmp_path / "connections.json").write_text(json.dumps(setup["connections"]))
    common = ["--connections", str(tmp_path / "connections.json"), "--state-root", setup["state_root"]]
    try:
        assert main(["run", str(tmp_path / "task.yaml"), *common, "--as-of", "2024-03-01"]) == 0
        assert main(["run", str(tmp_path / "broken.yaml"), *common]) == 1
        assert main(["run", str(tmp_path / "missing.yaml"), *common]) == 1
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    rows = content(spark, str(tmp_path / "out" / "raw" / "t"))
    assert [r[0] for r in rows] == [1, 2] and history(spark, setup)["success"].rows_processed == 2
    with pytest.raises(SystemExit):
        main(["fly"])


def test_compacted_days_tell_the_same_history(spark, tmp_path):
    table = ExecutionTable(spark, str(tmp_path))
    done, failed, open_run = (table.start(name=name) for name in ("done", "failed", "open"))
    done.update_rows(5)
    done.succeed(7)
    failed.fail()
    before = sorted(map(tuple, table.history().collect()))
    tomorrow = datetime.now(timezone.utc).date() + timedelta(days=1)
    assert table.compact(tomorrow - timedelta(days=1)) == 0
    assert table.compact(tomorrow) == 1
    folders = [p.name for p in (tmp_path / "executions").iterdir() if p.is_dir()]
    assert len(folders) == 1 and len(list((tmp_path / "executions").rglob("*.parquet"))) == 1
    assert sorted(map(tuple, table.history().collect())) == before
    assert table.compact(tomorrow) == 0
    open_run.succeed(9)  # recorded behind the compaction
    assert table.history().where("name = 'open'").first().rows_processed == 9
    assert table.compact(tomorrow) == 1
    assert table.history(first=tomorrow - timedelta(days=1), last=tomorrow).count() == 3
    assert table.history(last=tomorrow - timedelta(days=5)).count() == 0

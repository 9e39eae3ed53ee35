"""Leases of datasets: one load at a time, crashed ones expire, late ones are fenced off."""

import threading

import pytest
from helpers import content

from haulier import StateError, WatermarkTable, append_new
from haulier.operators import landing
from haulier.state import leases


def append(spark, dataset, n, **options):
    state = WatermarkTable(spark, f"{dataset}-state")
    return append_new(spark.range(n), dataset, task_identifier="t", reference_column="id", watermarks=state, lease_seconds=600, **options)


@pytest.mark.parametrize("versioned", [False, True])
def test_of_two_appends_at_once_one_is_refused_before_it_writes(spark, dataset, monkeypatch, versioned):
    append(spark, dataset, 10, versioned=versioned)
    inside, go_on, problems = threading.Event(), threading.Event(), []
    stage = landing.stage

    def slow(*args, **options):
        inside.set()
        assert go_on.wait(60)
        return stage(*args, **options)

    def first():
        try:
            append(spark, dataset, 15, versioned=versioned)
        except BaseException as error:  # noqa: BLE001
            problems.append(error)

    monkeypatch.setattr(landing, "stage", slow)
    thread = threading.Thread(target=first)
    thread.start()
    assert inside.wait(60)
    with pytest.raises(StateError, match="another load holds"):
        append(spark, dataset, 20, versioned=versioned)
    go_on.set()
    thread.join()
    assert problems == []
    result = append(spark, dataset, 20, versioned=versioned)
    assert sorted(r[0] for r in content(spark, result)) == list(range(20))


def test_a_crashed_lease_expires(spark, tmp_path):
    root, dataset = str(tmp_path / "state"), str(tmp_path / "d")
    old = leases.acquire(spark, root, dataset, 600)
    with pytest.raises(StateError):
        leases.acquire(spark, root, dataset, 600)
    leases.acquire(spark, root, str(tmp_path / "other"), 600)
    old.release()
    short = leases.acquire(spark, root, dataset, 0)
    new = leases.acquire(spark, root, dataset, 600)
    assert new.number == short.number + 1
    new.confirm()
    for late in (old, short):
        with pytest.raises(StateError, match="is over"):
            late.confirm()


def test_a_load_that_lost_its_lease_does_not_commit(spark, dataset, monkeypatch):
    append(spark, dataset, 10)
    stage = landing.stage

    def overtaken(*args, **options):
        staged = stage(*args, **options)
        monkeypatch.setattr(leases.time, "time", lambda: 1e12)
        return staged

    monkeypatch.setattr(landing, "stage", overtaken)
    with pytest.raises(StateError, match="is over"):
        append(spark, dataset, 15)
    monkeypatch.undo()
    assert len(content(spark, dataset)) == 10


def test_old_leases_are_removed(spark, tmp_path):
    for _ in range(6):
        leases.acquire(spark, str(tmp_path), "d", 600).release()
    assert len(list((tmp_path / "leases").glob("*/*.json"))) == 2

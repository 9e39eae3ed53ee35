"""Versioned commits: a dataset whose live folders are named by one small manifest.

Layout below the dataset::

    _versions/00000007.json      manifest of a version: which folders are live, and an append that waits for its watermark
    data/_load=00000007-ab12/    what one load wrote, flat or by path levels

A load writes its own new folder; a commit is one new manifest, made only if that number is not taken. Nothing is renamed, so object stores
will do, and the number of file system calls does not depend on the number of files. Readers take the newest whole manifest: they see all of a
commit or nothing of it, and one that is already reading goes on with the folders of its version, which stay for ``KEPT`` versions.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..errors import CommitError, LayoutError
from ..functions.periods import levels
from .storage import Storage

VERSIONS, DATA = "_versions", "data"
#: Path level that names the load; readers do not see it as a column.
LOAD = "_load"
#: Versions whose manifests and folders outlive newer ones.
KEPT = 3
#: How long a manifest may take to be written.
WRITE_SECONDS = 2.0
#: Session setting that names the commit of new datasets: ``swap`` (by renames) or ``versions``.
SETTING = "spark.haulier.commit"


@dataclass(frozen=True)
class Version:
    """One state of a dataset: per load its live partitions (``""`` stands for a flat load's whole folder)."""

    number: int
    granularity: str | None = None
    loads: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    #: An append whose watermark may not have been stored, and the version to go back to without it.
    pending: Mapping[str, Any] | None = None

    def paths(self) -> list[str]:
        return [f"{DATA}/{LOAD}={load}/{partition}".rstrip("/") for load, parts in self.loads.items() for partition in parts]

    def partitions(self) -> set[str]:
        return {partition for parts in self.loads.values() for partition in parts if partition}

    def text(self) -> str:
        body = {"number": self.number, "granularity": self.granularity, "loads": {k: list(v) for k, v in self.loads.items()}, "pending": self.pending}
        return json.dumps(body, sort_keys=True) + "\n"


def _parsed(text: str | None) -> Version | None:
    """None for a manifest that is not there, or that a crash left half written."""
    if not text or not text.endswith("}\n"):
        return None
    body = json.loads(text)
    return Version(body["number"], body["granularity"], {k: tuple(v) for k, v in body["loads"].items()}, body["pending"])


def _numbers(live: Storage) -> list[int]:
    return sorted((int(path[len(VERSIONS) + 1 :].removesuffix(".json")) for path in live.glob(f"{VERSIONS}/*.json")), reverse=True)


def _manifest(number: int) -> str:
    return f"{VERSIONS}/{number:08d}.json"


def is_versioned(spark: SparkSession, dataset: str) -> bool:
    return current(spark, dataset) is not None


def wanted(spark: SparkSession, dataset: str, versioned: bool | None) -> bool:
    """Whether a load commits by versions: as told, else as the dataset does, else as the session says."""
    if versioned is not None:
        return versioned
    return is_versioned(spark, dataset) or spark.conf.get(SETTING, "swap") == "versions"


def current(spark: SparkSession, dataset: str) -> Version | None:
    """The newest whole version of a dataset; None for one without versions."""
    live = Storage(spark, dataset)
    for number in _numbers(live):
        # A manifest that vanished since the listing was old.
        found = _parsed(live.read_text_or_none(_manifest(number)))
        if found is not None:
            return found
    return None


def new_load(spark: SparkSession, dataset: str) -> str:
    """Name of a load that follows the current version."""
    found = _numbers(Storage(spark, dataset))
    return f"{(found[0] if found else 0) + 1:08d}-{uuid.uuid4().hex[:12]}"


def load_folder(spark: SparkSession, dataset: str, load: str) -> str:
    return Storage(spark, dataset).url(f"{DATA}/{LOAD}={load}")


def discard_load(spark: SparkSession, dataset: str, load: str) -> None:
    """Delete what an uncommitted load wrote."""
    now = current(spark, dataset)
    if now is None or load not in now.loads:
        Storage(spark, dataset).delete(f"{DATA}/{LOAD}={load}")


def landed_partitions(spark: SparkSession, dataset: str, load: str, granularity: str | None) -> tuple[str, ...]:
    """Partitions that a load wrote; folders are listed, files are not."""
    if granularity is None:
        return ("",)
    base = f"{DATA}/{LOAD}={load}/"
    pattern = "/".join(f"{level}=*" for level in levels(granularity))
    return tuple(path.removeprefix(base) for path in Storage(spark, dataset).glob(base + pattern))


def commit(spark: SparkSession, dataset: str, version: Version) -> Version:
    """Make a version the current one. It is refused if its number is taken: another load has committed since this one began.

    A number whose manifest was left half written by a crash is passed over.
    """
    live = Storage(spark, dataset)
    deadline = time.monotonic() + WRITE_SECONDS
    while True:
        now, taken = current(spark, dataset), _numbers(live)
        if (now.number if now else 0) >= version.number:
            raise CommitError(f"another load committed version {version.number} of {dataset}; run this load again")
        # A manifest that is being written just now becomes whole; one that a crash left does not.
        if not taken or taken[0] < version.number or time.monotonic() > deadline:
            break
        time.sleep(0.05)
    number = max([version.number, *(n + 1 for n in taken)])
    version = replace(version, number=number)
    if not live.create_text(_manifest(number), version.text()):
        raise CommitError(f"another load committed version {number} of {dataset}; run this load again")
    return version


def commit_whole(spark: SparkSession, dataset: str, load: str, granularity: str | None) -> Version:
    """The load is the dataset from now on, whatever its layout was."""
    base = current(spark, dataset)
    parts = landed_partitions(spark, dataset, load, granularity)
    done = commit(spark, dataset, Version(base.number + 1 if base else 1, granularity, {load: parts} if parts else {}))
    remove_old(spark, dataset)
    return done


def commit_window(spark: SparkSession, dataset: str, load: str, granularity: str, window: Collection[str]) -> list[str]:
    """Partitions that the load wrote, and those of the window, are the load's from now on. Returns the window's partitions that are gone."""
    base = current(spark, dataset) or Version(0, granularity)
    parts = landed_partitions(spark, dataset, load, granularity)
    out = set(parts) | set(window)
    kept = {old: tuple(p for p in held if p not in out) for old, held in base.loads.items()}
    loads = {old: held for old, held in kept.items() if held} | ({load: parts} if parts else {})
    commit(spark, dataset, Version(base.number + 1, granularity, loads))
    remove_old(spark, dataset)
    return sorted((base.partitions() & set(window)) - set(parts))


def commit_more(spark: SparkSession, dataset: str, load: str, granularity: str | None, note: Mapping[str, Any]) -> Version:
    """The load is added. ``note`` names the watermark that the load will store; until then the append can be taken back."""
    base = current(spark, dataset) or Version(0, granularity)
    parts = landed_partitions(spark, dataset, load, granularity)
    loads = {**base.loads, load: parts} if parts else dict(base.loads)
    return commit(spark, dataset, Version(base.number + 1, granularity, loads, {**note, "load": load}))


def close_append(spark: SparkSession, dataset: str) -> None:
    """The watermark is stored: the append is final."""
    now = current(spark, dataset)
    if now is not None and now.pending:
        commit(spark, dataset, replace(now, number=now.number + 1, pending=None))
        remove_old(spark, dataset)


def undo_append(spark: SparkSession, dataset: str) -> int:
    """Take the waiting append back. Returns the number of its files."""
    now = current(spark, dataset)
    if now is None or not now.pending:
        return 0
    load = now.pending["load"]
    loads = {name: parts for name, parts in now.loads.items() if name != load}
    commit(spark, dataset, replace(now, number=now.number + 1, loads=loads, pending=None))
    live = Storage(spark, dataset)
    folder = f"{DATA}/{LOAD}={load}"
    files = live.summary(folder)[0] if live.exists(folder) else 0
    files -= live.exists(f"{folder}/_SUCCESS")
    live.delete(folder)
    return files


def drop_partition(spark: SparkSession, dataset: str, path: str) -> None:
    """One partition is no longer live; absent is fine."""
    now = current(spark, dataset)
    if now is None or path not in now.partitions():
        return
    kept = {load: tuple(p for p in parts if p != path) for load, parts in now.loads.items()}
    commit(spark, dataset, replace(now, number=now.number + 1, loads={k: v for k, v in kept.items() if v}))
    remove_old(spark, dataset)


def remove_old(spark: SparkSession, dataset: str, kept: int = KEPT) -> None:
    """Delete manifests before the last ``kept`` versions, and folders and partitions that no kept version names.

    Folders of loads that began after the oldest kept version are left alone: one of them may be running.
    """
    live = Storage(spark, dataset)
    numbers = _numbers(live)
    staying, going = numbers[:kept], numbers[kept:]
    if not going:
        return
    versions = [v for v in (_parsed(live.read_text_or_none(_manifest(n))) for n in staying) if v is not None]
    named = {path for version in versions for path in version.paths()}
    kinds = {load: version.granularity for version in versions for load in version.loads}
    old = []
    for folder in live.glob(f"{DATA}/{LOAD}=*"):
        load = folder.removeprefix(f"{DATA}/{LOAD}=")
        if load not in kinds:
            if int(load[:8]) <= staying[-1]:
                old.append(folder)
        elif kinds[load]:
            # Partitions that newer loads have replaced.
            old.extend(f"{folder}/{p}" for p in landed_partitions(spark, dataset, load, kinds[load]) if f"{folder}/{p}" not in named)
    live.delete_all(old)
    live.delete_all([_manifest(number) for number in going])


def adopt(spark: SparkSession, dataset: str) -> None:
    """Remove the plain files and level folders that a dataset held before its first version."""
    live = Storage(spark, dataset)
    live.delete_all([*live.glob("*.parquet"), *live.glob("year=*"), *live.glob("_SUCCESS")])


def read(spark: SparkSession, dataset: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version as a frame."""
    now = current(spark, dataset)
    if now is None:
        raise LayoutError(f"{dataset} has no versions")
    live = Storage(spark, dataset)
    paths = [live.url(path) for path in now.paths()]
    if not paths:
        if schema is None:
            raise LayoutError(f"version {now.number} of {dataset} is empty; its schema must be given")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", live.url(DATA))
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())]))
    return reader.parquet(*paths).drop(LOAD)

"""Leases: who may write a dataset just now.

``<state root>/leases/<dataset>/00000003.json`` is the third lease of a dataset, made only if that number is free, so of two loads that ask at
once one gets it. Numbers only grow and fence each other: a load whose lease ran out, or was taken over, finds a newer number
before its commit and stops. A lease ends when its load does, or, after a crash, when its time is over.
"""

from __future__ import annotations

import hashlib
import json
import time
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..errors import StateError
from ..operators.storage import Storage

FOLDER = "leases"
_KEPT = 2


@dataclass(frozen=True)
class Lease:
    spark: SparkSession
    root: str
    dataset: str
    number: int
    expires: float

    def confirm(self) -> None:
        """Refuse to go on if the lease is over or another load holds a newer one."""
        newest = _numbers(Storage(self.spark, self.root), _key(self.dataset))[0]
        if newest != self.number or time.time() >= self.expires:
            raise StateError(f"the lease of this load on {self.dataset} is over; run it again")

    def release(self) -> None:
        """The next load need not wait. The number stays taken."""
        storage, key = Storage(self.spark, self.root), _key(self.dataset)
        storage.create_text(f"{key}/{self.number:08d}.done", "")
        for number in _numbers(storage, key)[_KEPT:]:
            storage.delete_all([f"{key}/{number:08d}.json", f"{key}/{number:08d}.done"])


def acquire(spark: SparkSession, state_root: str, dataset: str, seconds: float) -> Lease:
    """The lease of a dataset for so many seconds; refused while another load holds it."""
    root = state_root.rstrip("/")
    storage, key = Storage(spark, root), _key(dataset)
    numbers = _numbers(storage, key)
    if numbers and not storage.exists(f"{key}/{numbers[0]:08d}.done"):
        held = _read(storage, key, numbers[0])
        if time.time() < held:
            raise StateError(f"another load holds {dataset} for {held - time.time():.0f} more seconds at most")
    number, expires = (numbers[0] if numbers else 0) + 1, time.time() + seconds
    body = json.dumps({"dataset": dataset, "expires": expires}) + "\n"
    if not storage.create_text(f"{key}/{number:08d}.json", body):
        raise StateError(f"another load has just taken {dataset}")
    return Lease(spark, root, dataset, number, expires)


def _read(storage: Storage, key: str, number: int) -> float:
    """When a lease runs out; one that is being written just now is as good as held."""
    text = storage.read_text_or_none(f"{key}/{number:08d}.json") or ""
    if not text.endswith("}\n"):
        time.sleep(1)
        text = storage.read_text_or_none(f"{key}/{number:08d}.json") or ""
    return json.loads(text)["expires"] if text.endswith("}\n") else 0.0


def _numbers(storage: Storage, key: str) -> list[int]:
    return sorted((int(path.rpartition("/")[2].removesuffix(".json")) for path in storage.glob(f"{key}/*.json")), reverse=True)


def _key(dataset: str) -> str:
    return f"{FOLDER}/{hashlib.sha1(dataset.rstrip('/').encode()).hexdigest()[:16]}"

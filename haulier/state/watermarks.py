"""Watermarks: the largest reference value landed so far, per dataset and column.

A Parquet table with one folder per key and one subfolder per version. A lookup touches only
the folder of its key, and superseded versions are removed, so the table stays as small as the
number of keys.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import Storage

SCHEMA = (
    "task_identifier STRING, reference_column STRING, watermark_value STRING, watermark_type STRING, "
    "last_record_count BIGINT, version BIGINT, updated_at TIMESTAMP"
)
FIELDS = ["task_identifier", "reference_column", "watermark_value", "watermark_type", "last_record_count"]
_KEPT_VERSIONS = 2


@dataclass(frozen=True)
class Watermark:
    task_identifier: str
    reference_column: str
    watermark_value: str
    watermark_type: str
    last_record_count: int
    version: int


class WatermarkTable:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        self._root = f"{root.rstrip('/')}/watermarks"
        self._storage = Storage(spark, self._root)

    @property
    def root(self) -> str:
        return self._storage.url()

    def get(self, task_identifier: str, reference_column: str) -> Watermark | None:
        """Current watermark of one key, or None before its first load."""
        key = _key(task_identifier, reference_column)
        if not self._storage.exists(key):
            return None
        # At most a few one-row files: the versions kept of this key.
        row = self._rows(f"{self._root}/{key}").orderBy(F.desc("version")).first()
        return Watermark(*[row[f] for f in [*FIELDS, "version"]]) if row else None

    def put(
        self,
        task_identifier: str,
        reference_column: str,
        watermark_value: str,
        watermark_type: str,
        last_record_count: int,
    ) -> int:
        """Store a new current value, whether or not the key existed. Returns its version."""
        key = _key(task_identifier, reference_column)
        version = self.next_version(task_identifier, reference_column)
        values = (task_identifier, reference_column, watermark_value, watermark_type, last_record_count, version)
        row = self._spark.range(0, 1, 1, 1).select(
            *[F.lit(v).alias(n) for n, v in zip([*FIELDS, "version"], values)],
            F.lit(datetime.now(timezone.utc)).alias("updated_at"),
        )
        # errorifexists: a second writer of the same version fails instead of overwriting.
        row.write.mode("errorifexists").parquet(f"{self._root}/{key}/{_version(version)}")
        superseded = self._storage.glob(f"{key}/version=*")[:-_KEPT_VERSIONS]
        self._storage.delete_all(superseded)
        return version

    def next_version(self, task_identifier: str, reference_column: str) -> int:
        """Version the next :meth:`put` will use; folders of failed writes are skipped."""
        taken = self._storage.glob(f"{_key(task_identifier, reference_column)}/version=*")
        return int(taken[-1].rpartition("=")[2]) + 1 if taken else 1

    def current(self) -> DataFrame:
        """All current watermarks."""
        if not self._storage.any("state_key=*/version=*"):
            return self._spark.createDataFrame([], SCHEMA)
        return self._latest(self._rows(f"{self._root}/state_key=*/version=*"))

    def _rows(self, path: str) -> DataFrame:
        # Version folders are addressed by path only: the version is also a column of the row.
        return self._spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(path)

    @staticmethod
    def _latest(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in ("task_identifier", "reference_column")]
        newest = F.max_by(F.struct(*rest), "version").alias("newest")
        return rows.groupBy("task_identifier", "reference_column").agg(newest).select(
            "task_identifier", "reference_column", "newest.*"
        )


def _key(task_identifier: str, reference_column: str) -> str:
    digest = hashlib.sha1(f"{task_identifier}\n{reference_column}".encode()).hexdigest()[:20]
    return f"state_key={digest}"


def _version(number: int) -> str:
    return f"version={number:010d}"

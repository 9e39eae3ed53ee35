"""Session settings that suit large loads, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from .operators.storage import Storage

# Zoneless JDBC timestamps stay zoneless, reads and writes are dated in UTC, and the rebalance
# in front of a partitioned write aims at output files of a few hundred megabytes.
LOAD_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512m",
}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; a local folder only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="haulier-")
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below :func:`scratch_root`, removed when the application ends."""
    path = f"{scratch_root(spark)}/haulier/{name}-{uuid.uuid4().hex[:12]}"
    storage = Storage(spark, path)
    storage.make_folder()
    storage.delete_on_exit()
    return path

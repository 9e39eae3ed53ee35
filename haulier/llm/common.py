"""Pieces shared by the operators: stored intermediate tables and connected components."""

from __future__ import annotations

import gc
import os
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import Storage
from ..session import scratch_folder

#: Words are runs of anything but space and the ASCII controls from tab to carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: the lineage ends at files every executor can read."""
    path = f"{scratch_folder(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a frame made by :func:`stored` that no later step reads."""
    for path in {os.path.dirname(file) for file in df.inputFiles()}:
        Storage(df.sparkSession, path).delete()


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now: its cleaner follows the driver's garbage collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new shared folder for files that tasks write themselves."""
    return f"{scratch_folder(spark, name)}/{uuid.uuid4().hex[:8]}"


#: What operators keep in a worker process from task to task, and the module whose tasks ran there last.
_KEPT: list[dict] = []
_LAST: list[str] = []


def worker_memory() -> dict:
    """A dictionary for what a module keeps in its worker processes. It is emptied when a worker goes on with another module's tasks, so that the
    memories of a pipeline's stages do not add up."""
    _KEPT.append({})
    return _KEPT[-1]


def _begin(module: str) -> None:
    if _LAST != [module]:
        _LAST[:] = [module]
        for kept in _KEPT:
            kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


_SHIPPED: set[str] = set()


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` whose workers can import this package, wherever the driver found it."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(SparkFiles.getRootDirectory()) / "code" / f"{package.name}-code.zip"
        archive.parent.mkdir(exist_ok=True)
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)

    def mapped(batches):
        _begin(function.__module__)
        yield from function(batches)

    return df.mapInArrow(mapped, schema)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold(column: str | Column, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo ``modulus`` (a NULL id counts as the empty text)."""
    text = F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def join_hot(left: DataFrame, right: DataFrame, key: str, name: str, share: int = 2000, counts: DataFrame | None = None) -> DataFrame:
    """Left join with a frame that has one row per key, for keys that may hold much of ``left``.

    A key with more than one of ``share`` rows is hot; there are fewer than ``share`` such keys, so their rows of ``right`` are broadcast. The
    rest is shuffled; NULL keys match nothing and are not shuffled. ``counts`` are the rows of each key as ``_n``, if known.
    """
    added = [c for c in right.columns if c != key]
    counts = counts if counts is not None else stored(left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")), f"{name}-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("_n") * share > total).select(key))
    of_hot = left.join(hot, key, "left_semi").join(F.broadcast(right.join(hot, key, "left_semi")), key, "left")
    others = left.where(F.col(key).isNotNull()).join(hot, key, "left_anti").join(right, key, "left")
    unkeyed = left.where(F.col(key).isNull()).select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in added])
    return of_hot.unionByName(others).unionByName(unkeyed)


def connected_components(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """Components of an undirected graph: (``node``, ``root``) with the smallest node of each component as its root.

    ``edges`` has two long columns ``a`` and ``b``; nodes without edges do not appear. Large-star and small-star
    steps alternate: each links all neighbours of a node to the smallest of them, so paths shrink like balanced trees.
    Minima are pre-aggregated in the reading tasks and neighbour lists are never gathered, so a hub is
    no single task's work. Every round is written out; the loop ends when a round changes nothing.
    """
    current = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{name}-edges"
    )
    before = None
    for _ in range(rounds):
        # Large star: every larger neighbour of u is linked to the smallest of u and its neighbours.
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: u and its smaller neighbours are linked to the smallest of them.
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        after = stored(small.where("u <> v").distinct(), f"{name}-round")
        sums = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        forget(current)
        current, done, before = after, before == tuple(sums), tuple(sums)
        if done:
            break
    else:
        raise RuntimeError(f"components of {name} did not settle in {rounds} rounds")
    roots = current.select("v").distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )

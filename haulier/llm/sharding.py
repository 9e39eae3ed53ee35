"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix, in DataFrame functions only."""

from __future__ import annotations

import json
import math
import random

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 8
SEED = 20240601
#: Rows of one local permutation; the number of partitions follows from it.
PARTITION_ROWS = 500_000
LEAST_PARTITIONS, MOST_PARTITIONS = 64, 32_768


def hypergeometric_weights(good: int, bad: int, draws: int) -> tuple[int, np.ndarray]:
    """(smallest count, probabilities from it on) of good balls among ``draws`` taken without putting back.

    Probabilities follow from their ratios, outwards from the mode, and are made to sum to 1, so no large logarithms are subtracted. Beyond
    twelve deviations (and forty counts) what is left out is below the rounding of the sum.
    """
    low, high = max(0, draws - bad), min(draws, good)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    whole = good + bad
    deviation = math.sqrt(draws / whole * good / whole * bad * max(0, whole - draws) / max(1, whole - 1)) if whole else 0.0
    width = int(12 * deviation) + 40
    up = np.arange(mode, min(high, mode + width), dtype=np.float64)
    down = np.arange(mode, max(low, mode - width), -1, dtype=np.float64)
    rising = np.cumprod((good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1)))
    falling = np.cumprod(down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1)))
    weights = np.concatenate([falling[::-1], [1.0], rising])
    return mode - len(falling), weights / weights.sum()


def hypergeometric(source: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` balls taken without putting back are good; by inversion, at any size."""
    first, weights = hypergeometric_weights(good, bad, draws)
    return first + min(len(weights) - 1, int(np.searchsorted(np.cumsum(weights), source.random(), side="right")))


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows of each partition that go to each shard, drawn as if all rows had been shuffled together.

    Row sums are ``counts`` and column sums are ``sizes``, exactly.
    """
    source, free = random.Random(seed), list(sizes)
    matrix = []
    for count in counts:
        row, left, others = [], count, sum(free)
        for room in free:
            others -= room
            row.append(hypergeometric(source, room, others, left))
            left -= row[-1]
        free = [room - taken for room, taken in zip(free, row, strict=True)]
        matrix.append(row)
    return matrix


def shuffled_shards(df: DataFrame, *, keys: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Deal rows to ``shards`` at random: adds ``shard`` and ``slot`` (0, 1, ... within the shard).

    Shard sizes differ by one row at most. 1. Rows fall into partitions by a hash of ``keys``; only the count of each
    partition (32,768 at most) reaches the driver, where the matrix is drawn. 2. Each partition permutes its rows
    by random keys and cuts the sequence by its row of the matrix. 3. After the exchange each shard
    is permuted again: in sub-ranges of fresh random keys, whose offsets are a running sum of counts, so no shard is one task.
    Random keys are seeded hashes, so a rerun gives the same rows and a lost task is repeatable. Rows that agree in all
    ``keys`` are interchangeable. Rows with NULL keys are ordinary rows; an empty table stays empty.
    """
    if {"shard", "slot"} & set(df.columns):
        raise ValueError("rename the columns shard and slot first")
    total = df.count()
    partitions = min(MOST_PARTITIONS, max(LEAST_PARTITIONS, -(-total // PARTITION_ROWS)))
    draw = lambda k: F.xxhash64(F.lit(seed + k), *[F.col(c) for c in keys])
    rows = df.withColumn("_part", F.pmod(draw(1), F.lit(partitions)))
    counts = {r["_part"]: r["count"] for r in rows.groupBy("_part").count().collect()}
    order = sorted(counts)
    sizes = [total // shards + (i < total % shards) for i in range(shards)]
    matrix = communication_matrix([counts[p] for p in order], sizes, seed)
    ends = [[sum(row[: i + 1]) for i in range(shards)] for row in matrix]
    literal = json.dumps([{"_part": p, "_ends": e} for p, e in zip(order, ends, strict=True)])
    cuts = df.sparkSession.range(1).select(F.inline(F.from_json(F.lit(literal), "array<struct<_part:bigint,_ends:array<bigint>>>")))

    local = Window.partitionBy("_part").orderBy(draw(2), *keys)
    rows = rows.withColumn("_rank", F.row_number().over(local) - 1).join(cuts, "_part")
    rows = rows.withColumn("shard", F.size(F.filter("_ends", lambda end: end <= F.col("_rank"))))

    ranges = max(8, partitions // shards)
    rows = rows.withColumn("_range", F.pmod(draw(3), F.lit(ranges))).drop("_part", "_rank", "_ends")
    running = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "_range").count()
    offsets = offsets.select("shard", "_range", F.coalesce(F.sum("count").over(running), F.lit(0)).alias("_offset"))
    again = Window.partitionBy("shard", "_range").orderBy(draw(4), *keys)
    rows = rows.withColumn("_rank", F.row_number().over(again) - 1).join(offsets, ["shard", "_range"])
    return rows.withColumn("slot", F.col("_offset") + F.col("_rank")).select(*df.columns, "shard", "slot")


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def document_shards(df: DataFrame, *, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Documents in shards: ``doc_id``, ``size`` (UTF-8 bytes plus 1; a NULL text has none), ``text_crc32`` (of a NULL text: of
    nothing), ``law`` = ``rows``, ``shard``, ``slot``, ``grown_shard`` (NULL: this law does not grow by keys)."""
    rows = df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        text_crc32(F.col("text")).alias("text_crc32"),
    )
    dealt = shuffled_shards(rows, keys=["doc_id", "size", "text_crc32"], shards=shards, seed=seed)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )

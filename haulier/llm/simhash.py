"""SimHash near-duplicates by bit-sliced comparison of fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, map_arrow, stored, text_or_empty

BITS, SHINGLE, SEED, RADIUS = 64, 3, 42, 2
#: Rows of a bucket from which on it is cut further, by the bits that its key leaves open.
LARGE_BUCKET = 20_000
#: (query, word) pairs compared at once; 64 lanes each.
PAIRS_AT_ONCE = 1 << 18


def shingle_hashes(text: str, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle of words, repeats included; of the whole sequence if it is shorter; none without words."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxh64_intdigest(joined, seed)], dtype=np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = ends - lengths
    spans = zip(begins[: 1 - size].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.array([xxh64_intdigest(joined[a:b], seed) for a, b in spans], dtype=np.uint64)


def fingerprints(hashes: list[np.ndarray], at_once: int = 1 << 17) -> np.ndarray:
    """One fingerprint per array: a bit is set where over half of the hashes have it; zero for an empty array."""
    counts = np.zeros((len(hashes), BITS), dtype=np.int64)
    sizes = np.array([len(h) for h in hashes], dtype=np.int64)
    begin = 0
    while begin < len(hashes):
        end = begin + 1
        total = sizes[begin]
        while end < len(hashes) and total + sizes[end] <= at_once:
            total += sizes[end]
            end += 1
        if end == begin + 1:  # a long text, part by part
            for at in range(0, len(hashes[begin]), at_once):
                counts[begin] += _bits(hashes[begin][at : at + at_once]).sum(axis=0, dtype=np.int64)
        else:
            filled = [i for i in range(begin, end) if sizes[i]]
            if filled:
                starts = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
                counts[filled] = np.add.reduceat(_bits(np.concatenate([hashes[i] for i in filled])), starts, axis=0, dtype=np.int32)
        begin = end
    majority = (2 * counts > sizes[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").reshape(-1)


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_planes(values: np.ndarray) -> np.ndarray:
    """The values stood upright: plane p holds bit p of 64 neighbouring values in each of its words."""
    padded = np.zeros(-(-len(values) // 64) * 64, dtype="<u8")
    padded[: len(values)] = values
    return np.packbits(np.ascontiguousarray(_bits(padded).T), axis=1, bitorder="little").view("<u8")


def near_pairs(values: np.ndarray, ends: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j < ends[i], whose values differ in at most ``radius`` bits.

    Each query meets 64 candidates per step: the differing bits of a plane are added to counters that are
    themselves bit-sliced (carry-save, one word per binary digit), and a block of 64 is given up
    as soon as all of its counters are over the radius.
    """
    planes = bit_planes(values)
    rows = np.arange(len(values))
    first, last = (rows + 1) // 64, (ends - 1) // 64
    blocks = np.where(ends > rows + 1, last - first + 1, 0)
    upto = np.cumsum(blocks)
    begin = 0
    while begin < len(values):
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + PAIRS_AT_ONCE, side="right")))
        some = rows[begin:end]
        if count := int(upto[end - 1] - done):
            query = np.repeat(some, blocks[begin:end])
            word = np.arange(count) - np.repeat(upto[begin:end] - blocks[begin:end] - done, blocks[begin:end]) + first[query]
            for at in range(0, count, PAIRS_AT_ONCE):
                yield from _compared(values, planes, ends, query[at : at + PAIRS_AT_ONCE], word[at : at + PAIRS_AT_ONCE], radius)
        begin = end


def _ones_below(n: np.ndarray) -> np.ndarray:
    """Words whose lowest n bits are set (n from 0 to 64)."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    return np.where(n >= 64, full, (np.uint64(1) << np.minimum(n, 63).astype(np.uint64)) - np.uint64(1))


def _compared(values, planes, ends, query, word, radius: int):
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    low, high = np.clip(query + 1 - 64 * word, 0, 64), np.clip(ends[query] - 64 * word, 0, 64)
    over = ~(_ones_below(high) & ~_ones_below(low))  # lanes outside the bucket count as too far from the start
    own = values[query]
    digits = [np.zeros(len(query), dtype=np.uint64) for _ in range(radius.bit_length())]
    # Planes far apart first, so that values that share a run of bits part early.
    for step, plane in enumerate(sorted(range(BITS), key=lambda p: (p % 8, p))):
        carry = planes[plane][word] ^ (np.uint64(0) - (own >> np.uint64(plane) & np.uint64(1)))
        for digit in digits:
            carry, _ = digit & carry, np.bitwise_xor(digit, carry, out=digit)
        over |= carry
        if step % 8 == 7:
            beyond = over | _greater(digits, radius)
            alive = beyond != full
            if not alive.all():
                query, word, over, own, beyond = query[alive], word[alive], over[alive], own[alive], beyond[alive]
                digits = [digit[alive] for digit in digits]
            if not len(query):
                return
    lanes = _bits(~beyond)
    pair, lane = np.nonzero(lanes)
    yield query[pair], word[pair] * 64 + lane


def _greater(digits: list[np.ndarray], bound: int) -> np.ndarray:
    """Lanes whose bit-sliced counter is greater than ``bound``."""
    greater, equal = np.zeros_like(digits[0]), ~np.zeros_like(digits[0])
    for place in reversed(range(len(digits))):
        if bound >> place & 1:
            equal &= digits[place]
        else:
            greater |= equal & digits[place]
            equal &= ~digits[place]
    return greater


def forest(values: np.ndarray, ends: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each value the smallest index that links lead to, within its bucket."""
    labels = np.arange(len(values))
    for left, right in near_pairs(values, ends, radius):
        while True:
            small = np.minimum(labels[left], labels[right])
            new = labels.copy()
            for side in (left, right):
                np.minimum.at(new, labels[side], small)
                np.minimum.at(new, side, small)
            new = new[new]
            if np.array_equal(new, labels):
                break
            labels = new
    while not np.array_equal(labels, labels[labels]):
        labels = labels[labels]
    return labels


def with_fingerprints(df: DataFrame) -> DataFrame:
    """(``doc_id``, ``text_key``, ``fp``) of every row; ``text_key`` tells rows with the same id and other texts apart."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text")

    def fingerprint(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                values = fingerprints([shingle_hashes(text) for text in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(values.view(np.int64))], names=["doc_id", "text_key", "fp"]
                )

    return rows.transform(map_arrow, fingerprint, "doc_id long, text_key long, fp long")


def _segments(column: Column, bits: list[int], parts: int) -> list[Column]:
    """The bits at these places in ``parts`` runs, each as a number of its own."""
    out = []
    for part in range(parts):
        places = bits[part * len(bits) // parts : (part + 1) * len(bits) // parts]
        mask = sum(1 << p for p in places)
        out.append(column.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)))
    return out


def links(distinct: DataFrame, *, radius: int = RADIUS, large: int = LARGE_BUCKET) -> DataFrame:
    """Links that connect distinct fingerprints (column ``fp``) at most ``radius`` bits apart: (``a``, ``b``).

    Two such values agree in one of ``radius`` + 1 runs of bits at least, so only values with an equal run are compared; no
    pair is missed. Large buckets are cut again by runs of the remaining bits, by the same argument. Within a bucket the links
    found are reduced to a forest that connects the same values, so a dense bucket does not give all of its pairs.
    """
    parts = radius + 1
    every = list(range(BITS))
    tables = [F.struct(F.lit(i).alias("run"), key.alias("key")) for i, key in enumerate(_segments(F.col("fp"), every, parts))]
    rows = distinct.select("fp", F.inline(F.array(*tables)))
    counts = stored(rows.groupBy("run", "key").count().where(F.col("count") > large).select("run", "key"), "simhash-large")
    rows = rows.withColumn("sub", F.lit(-1)).withColumn("sub_key", F.lit(0).cast("long"))
    if not counts.isEmpty():
        rows = rows.drop("sub", "sub_key")
        ordinary = rows.join(counts, ["run", "key"], "left_anti").withColumn("sub", F.lit(-1)).withColumn("sub_key", F.lit(0).cast("long"))
        heavy = rows.join(counts, ["run", "key"], "left_semi")
        for run in range(parts):
            inside = set(range(run * BITS // parts, (run + 1) * BITS // parts))
            open_bits = [b for b in every if b not in inside]
            finer = [F.struct(F.lit(i).alias("sub"), key.alias("sub_key")) for i, key in enumerate(_segments(F.col("fp"), open_bits, parts))]
            ordinary = ordinary.unionByName(heavy.where(F.col("run") == run).select("fp", "run", "key", F.inline(F.array(*finer))))
        rows = ordinary
    bucket = ["run", "key", "sub", "sub_key"]
    rows = rows.withColumn("bucket", F.xxhash64(*bucket)).select("bucket", "fp")
    # A hash names the bucket: should two buckets share one, they are compared as one, and nothing is lost.
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "fp")

    def linked(batches):
        held_bucket, held = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        for batch in batches:
            buckets = batch.column("bucket").to_numpy(zero_copy_only=False)
            values = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            held_bucket, held = np.concatenate([held_bucket, buckets]), np.concatenate([held, values])
            # The last bucket may go on in the next batch.
            cut = int(np.searchsorted(held_bucket, held_bucket[-1])) if len(held_bucket) else 0
            yield from _forest_batch(held_bucket[:cut], held[:cut], radius)
            held_bucket, held = held_bucket[cut:], held[cut:]
        yield from _forest_batch(held_bucket, held, radius)

    return rows.transform(map_arrow, linked, "a long, b long").distinct()


def _forest_batch(buckets: np.ndarray, values: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    if len(values) < 2:
        return
    labels = forest(values, np.searchsorted(buckets, buckets, side="right"), radius)
    at = np.nonzero(labels != np.arange(len(labels)))[0]
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(values[at].view(np.int64)), pa.array(values[labels[at]].view(np.int64))], names=["a", "b"])


def near_duplicates(df: DataFrame, *, radius: int = RADIUS) -> DataFrame:
    """Groups of documents linked by near-equal fingerprints, one row per input row.

    Columns: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest ``doc_id`` reachable over links), ``kept`` (true for
    one row of each group: the one with the smallest id and, among repeated ids, the smallest text key) and ``text_key``.
    A NULL text is an empty one; texts without words have fingerprint 0 and link like any other. NULL ids come last
    in a group; a group of NULL ids has a NULL ``component_id``. Repeated rows are all kept if one of them is
    (:func:`without_near_copies` returns one). An empty table gives an empty result. Other columns are not read.
    """
    rows = stored(with_fingerprints(df), "simhash-fingerprints")
    mine = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    distinct = stored(rows.groupBy("fp").agg(F.min(mine).alias("first")), "simhash-distinct")
    roots = stored(connected_components(links(distinct, radius=radius), "simhash"), "simhash-roots")
    smallest = roots.join(distinct, roots["node"] == distinct["fp"]).groupBy("root").agg(F.min("first").alias("least"))
    grouped = roots.join(smallest, "root").select(F.col("node").alias("fp"), "least")
    named = distinct.join(grouped, "fp", "left").select("fp", F.coalesce("least", "first").alias("least"))
    # Stored, so that the join with all rows shuffles both sides and Spark can split a fingerprint that most rows share.
    named = stored(named, "simhash-groups")
    return rows.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least.doc_id").alias("component_id"),
        (mine == F.col("least")).alias("kept"),
        "text_key",
    )


def without_near_copies(df: DataFrame, *, radius: int = RADIUS) -> DataFrame:
    """The rows that stay, with all their columns: one of each group of near-duplicates."""
    kept = near_duplicates(df, radius=radius).where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_key").alias("_kept_key")).distinct()
    rows = df.withColumn("_id", F.col("doc_id").cast("long")).withColumn("_key", F.xxhash64(text_or_empty()))
    stays = rows.join(kept, F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_key") == F.col("_kept_key")), "left_semi")
    return stays.dropDuplicates(["_id", "_key"]).select(*df.columns)

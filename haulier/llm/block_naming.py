"""Exact deduplication by deterministic block naming, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_or_empty

BLOCK_BYTES = 1024


def named(df: DataFrame, *, block_bytes: int = BLOCK_BYTES, first_seed: int = 0, hash_bits: int = 64) -> DataFrame:
    """Add ``identity``: equal for two rows exactly when their ``body`` (binary) is equal byte by byte.

    A body is cut into blocks of ``block_bytes``. Every block gets an integer name (two 64-bit numbers), then every
    adjacent pair of names gets one, level by level, until one name is left; the number of blocks completes the identity.
    A block's name is its place in hash order. One sort over the blocks and pairs of all levels brings equal names
    together and shows whether any name stands for two different blocks; blocks are combined where they
    are read, so a block that occurs everywhere is one row per task. If a name is shared, the next seeds are
    drawn and the sort runs again, so the identities that are returned are proven free of collisions, not assumed so.

    An empty body is one empty block. ``hash_bits`` narrows the names in tests, to force collisions.
    """
    longest = df.agg(F.max(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, -(-longest // block_bytes))
    levels = (blocks - 1).bit_length()
    bits = hash_bits
    for attempt in range(16):
        rows = _levels(df, block_bytes, levels, first_seed + 2 * attempt, bits)
        contents = F.flatten(F.array(*[_entries(level) for level in range(levels + 1)]))
        shared = (
            rows.select(F.inline(contents))
            .groupBy("level", "x", "y")
            .agg(F.min("content").alias("low"), F.max("content").alias("high"))
            .where("low <> high")
        )
        if shared.isEmpty():
            top = F.col(f"names{levels}")[0]
            return rows.select(*df.columns, F.struct("n_blocks", top["x"].alias("x"), top["y"].alias("y")).alias("identity"))
        bits = min(64, bits * 2)
    raise RuntimeError("no collision-free names found")


def _levels(df: DataFrame, block_bytes: int, levels: int, seed: int, bits: int) -> DataFrame:
    starts = F.sequence(F.lit(0), F.col("n_blocks") - 1)
    rows = df.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.octet_length("body") / block_bytes).cast("int")))
    rows = rows.withColumn("blocks0", F.transform(starts, lambda i: F.substring("body", i * block_bytes + 1, F.lit(block_bytes))))
    rows = rows.withColumn("names0", F.transform("blocks0", lambda block: _name(block, seed, bits)))
    for level in range(1, levels + 1):
        rows = rows.withColumn(f"blocks{level}", _pairs(f"names{level - 1}"))
        rows = rows.withColumn(f"names{level}", F.transform(f"blocks{level}", lambda block: _name(block, seed, bits)))
    return rows


def _name(block: Column, seed: int, bits: int) -> Column:
    cut = lambda h: h if bits >= 64 else F.pmod(h, F.lit(1 << bits))
    return F.struct(cut(F.xxhash64(F.lit(seed), block)).alias("x"), cut(F.xxhash64(F.lit(seed + 1), block)).alias("y"))


def _pairs(names: str) -> Column:
    """Adjacent names, two by two, as short blocks; a last name without a right neighbour is paired with a dash."""

    def pair(i: Column) -> Column:
        left, right = F.get(names, 2 * i), F.get(names, 2 * i + 1)
        right_text = F.when(right.isNull(), F.lit("-")).otherwise(F.concat_ws(":", right["x"], right["y"]))
        return F.concat_ws("|", F.concat_ws(":", left["x"], left["y"]), right_text).cast("binary")

    return F.transform(F.sequence(F.lit(0), F.ceil(F.size(names) / 2).cast("int") - 1), pair)


def _entries(level: int) -> Column:
    return F.zip_with(
        f"blocks{level}",
        f"names{level}",
        lambda block, name: F.struct(F.lit(level).alias("level"), name["x"].alias("x"), name["y"].alias("y"), block.alias("content")),
    )


def exact_groups(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Group rows whose texts are identical: one row per input row.

    Columns: ``doc_id``, ``keep_id`` (largest id of the group), ``group_size``, ``kept``, ``text_sha256``.
    A NULL text counts as empty. Rows that repeat an id and text count one by one in ``group_size``; if they carry the
    largest id, all of them are marked kept (:func:`without_copies` returns one). NULL ids never win over others; a group
    of NULL ids only has a NULL ``keep_id`` and its rows are marked kept. An empty table gives an empty result. Other columns are not read.
    """
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).cast("binary").alias("body"))
    rows = named(rows, **options).select("doc_id", "identity", F.sha2("body", 256).alias("text_sha256"))
    # Two jobs read these narrow rows, and the planner need not carry the tower of levels through the join.
    rows = stored(rows, "exact-identities")
    groups = rows.groupBy("identity").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Only groups of several rows are looked up, and from a table of their own: then both sides of the join
    # are shuffled for it, and Spark splits the partition of a group that holds most of the rows.
    groups = stored(groups.where("group_size > 1"), "exact-groups")
    return rows.join(groups, "identity", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.when(F.col("group_size").isNull(), True).otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def without_copies(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows that stay, with all their columns: of identical texts the one with the largest id (any one of repeated rows)."""
    kept = exact_groups(df, id_column=id_column, text_column=text_column, **options).where("kept")
    kept = kept.select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha")).distinct()
    sha = F.sha2(text_or_empty(text_column).cast("binary"), 256)
    rows = df.withColumn("_sha", sha).withColumn("_id", F.col(id_column).cast("long"))
    stays = rows.join(kept, F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_sha") == F.col("_kept_sha")), "left_semi")
    return stays.dropDuplicates(["_id", "_sha"]).select(*df.columns)

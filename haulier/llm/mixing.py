"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets, repeated epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, stored, text_or_empty

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
SEED = "mix-1"
#: Rows of one sorted range of a source, about; ranges are prefixes of the random key.
RANGE_ROWS = 100_000


def words(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Targets from (``source``, ``source_size``), one row per source.

    Sources in code point order, NULL last, weigh ``weights`` in turn. ``share`` times all sizes is dealt by weight; no
    source gets over ``most`` times its size, and what it cannot take is dealt again. That ends at
    min(most x size, level x weight), where the level is found by filling sources in order of size by weight.
    The windows run over one row per source.
    """
    kinds = F.array(*[F.lit(w) for w in weights])
    place = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("w", F.element_at(kinds, ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int")))
    rows = rows.withColumn("cap", F.col("source_size") * most)
    filling = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = rows.withColumn("full_cap", F.coalesce(F.sum("cap").over(before), F.lit(0)))
    rows = rows.withColumn("full_w", F.coalesce(F.sum("w").over(before), F.lit(0)))
    rows = rows.withColumn("all_size", F.sum("source_size").over(everything)).withColumn("all_w", F.sum("w").over(everything))
    level = (F.col("all_size") * F.lit(float(share)) - F.col("full_cap")) / (F.col("all_w") - F.col("full_w"))
    rows = rows.withColumn("level", F.when(level * F.col("w") <= F.col("cap"), level))
    # The first source that can take its share sets the level of all that follow.
    rows = rows.withColumn("level", F.first("level", ignorenulls=True).over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.col("cap").cast("double")))
    return rows.select("source", "source_size", target.alias("target"))


def mixed(
    df: DataFrame,
    *,
    carry: list[str] | None = None,
    seed: str = SEED,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``taken`` (words the mix takes from the row, repeats counted).

    Each source's rows stand in the order of a random key, md5 of the seed, ``doc_id`` and the text, so rows that repeat an id or have none
    are spread like any other and only equal rows tie: every run gives the same result, however the rows are read. Whole epochs are taken as often as the
    target allows, then a last one is cut at the exact word: the row that crosses the budget gives a part. Running
    sums are taken in two steps: per key range (a prefix of the key, so ranges are even even in a source that
    holds most rows), then over the small table of range sums. Needs ``doc_id``, ``source`` and ``text``; NULL texts
    have size 0, NULL sources are a source of their own, NULL ids are ordinary rows. Repeated rows each take
    their own place. Other columns are passed on, or those named in ``carry`` only; those named like an added one are replaced.
    """
    kept = [c for c in df.columns if c not in ("size", "source_size", "target", "taken")] if carry is None else carry
    needed = [c for c in ("doc_id", "source") if c not in kept]
    of_text = F.md5(text_or_empty().cast("binary"))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), of_text).cast("binary"))
    rows = df.select(*kept, *needed, words().alias("size"), key.alias("_key"))
    digits, count = 2, df.count()
    while count / 16**digits > RANGE_ROWS:
        digits += 1
    rows = rows.withColumn("_range", F.substring("_key", 1, digits))

    ranges = stored(rows.groupBy("source", "_range").agg(F.sum("size").alias("_sum")), "mix-ranges")
    sources = ranges.groupBy("source").agg(F.sum("_sum").alias("source_size"))
    targets = stored(source_targets(sources, weights=weights, share=share, most=most), "mix-targets")
    running = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_sum").over(running), F.lit(0)))
    ranges = ranges.join(targets, ranges["source"].eqNullSafe(targets["source"])).select(
        ranges["source"].alias("_source"), F.col("_range").alias("_r"), "_before", "source_size", "target"
    )
    within = Window.partitionBy("source", "_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(ranges, rows["source"].eqNullSafe(ranges["_source"]) & (rows["_range"] == ranges["_r"]))
    budget = F.floor("target")
    rest = F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    part = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("_before") - F.col("_inside")))
    return rows.withColumn("taken", (epochs * F.col("size") + part).cast("long")).select(*kept, "size", "source_size", "target", "taken")


def mixture(df: DataFrame) -> DataFrame:
    """The mixed corpus itself: every row as often as it is taken, a part of it cut behind its last taken word.

    Each row is repeated once for each whole take; a row at the cut adds one copy of its first words, joined by spaces.
    ``n_chars``, where present, is counted again for cut texts.
    """
    rows = mixed(df)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    part = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(F.lit(0)).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    rows = rows.withColumn("_part", F.explode(copies))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD_PATTERN})"), F.lit(1)), 1, F.greatest(F.col("_part"), F.lit(1))), " ")
    rows = rows.withColumn("text", F.when(F.col("_part") > 0, cut).otherwise(F.col("text")))
    if "n_chars" in df.columns:
        kind = df.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col("_part") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return rows.select(*df.columns)

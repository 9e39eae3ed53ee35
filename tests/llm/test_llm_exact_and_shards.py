"""Block naming, sharding and mixing against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from frames import SCHEMA, clashing, documents

from haulier.llm import block_naming, mixing, sharding


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 4}, {"block_bytes": 4, "hash_bits": 4}, {"block_bytes": 7, "hash_bits": 16}])
def test_groups_are_those_of_equal_texts(spark, options):
    df = documents(spark)
    got = rows_of(block_naming.exact_groups(df, **options), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    groups = defaultdict(list)
    for r in df.collect():
        groups[r["text"] or ""].append(r["doc_id"])
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    assert got == sorted(want, key=repr)


def test_narrow_names_collide_and_are_drawn_again(spark):
    df = spark.createDataFrame([(i, f"{i:04d}" * 3) for i in range(300)], "doc_id long, text string")
    got = block_naming.exact_groups(df, block_bytes=4, hash_bits=2)
    assert got.where("group_size <> 1").count() == 0


def test_one_row_of_each_text_stays_with_all_its_columns(spark):
    df = clashing(documents(spark))
    kept = block_naming.without_copies(df)
    assert kept.columns == df.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert Counter(texts) == Counter({t: 1 for t in {r["text"] or "" for r in df.collect()}})


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert block_naming.exact_groups(empty).count() == 0
    assert block_naming.without_copies(empty).count() == 0
    assert sharding.document_shards(empty).count() == 0
    assert mixing.mixed(empty).count() == 0
    assert mixing.mixture(empty).count() == 0


def test_shards_are_exact_and_slots_gapless(spark):
    df = documents(spark)
    got = sharding.document_shards(clashing(df)).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in df.collect()
    )
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.document_shards(df).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_communication_matrix_has_exact_margins():
    matrix = sharding.communication_matrix([5, 0, 17, 100], [40, 41, 41], seed=3)
    assert [sum(row) for row in matrix] == [5, 0, 17, 100]
    assert [sum(column) for column in zip(*matrix, strict=True)] == [40, 41, 41]


def test_hypergeometric_draws_have_the_right_mean_at_any_size():
    source = random.Random(1)
    small = [sharding.hypergeometric(source, 3, 5, 4) for _ in range(4000)]
    assert abs(sum(small) / len(small) - 1.5) < 0.05
    counts = Counter(small)
    assert set(counts) <= {0, 1, 2, 3}
    assert abs(counts[0] / 4000 - 5 / 70) < 0.02
    large = [sharding.hypergeometric(source, 10**9, 7 * 10**9, 10**6) for _ in range(50)]
    assert abs(sum(large) / 50 - 125_000) < 500


@pytest.mark.parametrize(("good", "bad", "draws"), [(0, 0, 0), (3, 5, 4), (5, 0, 3), (0, 9, 4), (7, 2, 9), (2000, 3000, 1000), (40_000, 280_000, 5_000)])
def test_hypergeometric_weights_are_the_exact_ones(good, bad, draws):
    first, weights = sharding.hypergeometric_weights(good, bad, draws)
    whole = math.comb(good + bad, draws)
    exact = [float(Fraction(math.comb(good, k) * math.comb(bad, draws - k), whole)) for k in range(first, first + len(weights))]
    assert sum(exact) == pytest.approx(1, abs=1e-12) and np.allclose(weights, exact, rtol=1e-9, atol=1e-15)


def test_hypergeometric_weights_of_large_numbers_have_the_right_moments():
    for good, bad, draws in ((10**9, 7 * 10**9, 10**6), (10**11, 7 * 10**11, 3 * 10**9)):
        first, weights = sharding.hypergeometric_weights(good, bad, draws)
        n, share = good + bad, good / (good + bad)
        counts = np.arange(len(weights)) + (first - draws * share)
        assert abs(float(weights @ counts)) < 1e-3
        assert float(weights @ counts**2) == pytest.approx(draws * share * (1 - share) * (n - draws) / (n - 1), rel=1e-6)


def water_level(sizes, weights, total, most):
    """The excess above the limit is dealt again until none is above."""
    out, free, rest = {}, set(sizes), total
    while free:
        w = sum(weights[s] for s in free)
        over = {s for s in free if rest * weights[s] / w > most * sizes[s]}
        if not over:
            out |= {s: rest * weights[s] / w for s in free}
            break
        for s in over:
            out[s] = most * sizes[s]
            rest -= out[s]
        free -= over
    return out


def test_mix_meets_every_target(spark):
    df = documents(spark)
    got = mixing.mixed(clashing(df), carry=["doc_id", "source"]).collect()
    sizes = Counter()
    for r in df.collect():
        sizes[r["source"]] += len((r["text"] or "").split())
    order = sorted((s for s in sizes if s), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want = water_level(sizes, weights, 1.5 * sum(sizes.values()), 2)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == int(want[s] + 1e-6) for s in want)
    mixed = mixing.mixture(df)
    assert mixed.columns == df.columns
    words = Counter()
    for r in mixed.collect():
        words[r["source"]] += len((r["text"] or "").split())
    assert words == +taken


def test_mix_has_budgets_below_and_above_one_epoch(spark):
    rows = [(i, "w " * 10, None, "big" if i < 90 else "a") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["source"]: r for r in mixing.mixed(df, carry=["source"]).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()}
    assert got["a"]["sum(taken)"] == 200
    assert got["big"]["sum(taken)"] == 1300


def test_mix_does_not_depend_on_the_order_of_rows(spark):
    """Rows that share an id or have none are told apart by their texts, also where the budget ends."""
    rows = [(7 if i % 2 else None, "w " * i, None, "b") for i in range(1, 80)] + [(i, "w " * 30, None, "a") for i in range(100, 140)]
    rows += [(7, "w " * 20, None, "b")] * 3
    schema = "doc_id long, text string, lang string, source string"
    results = [
        sorted(map(repr, mixing.mixed(spark.createDataFrame(some, schema).repartition(n), carry=["doc_id", "source"]).collect()))
        for some, n in ((rows, 1), (rows[::-1], 3), (rows[1::2] + rows[::2], 7))
    ]
    assert results[0] == results[1] == results[2]
    assert any("taken=0" not in r for r in results[0])

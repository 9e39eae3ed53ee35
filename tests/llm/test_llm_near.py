"""SimHash, NN-descent and components against brute force."""

import random
import re

import numpy as np
import pytest
from frames import SCHEMA, clashing, documents

from haulier.llm import nn_descent, simhash
from haulier.llm.common import connected_components


class Forest:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def fingerprint(text):
    from xxhash import xxh64_intdigest

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_follow_the_definition():
    texts = ["", "   ", "one", "one Two", "a b c", "A b\tc D É é\x0bx", "q " * 700, "the quick brown fox jumps over the lazy dog"]
    got = simhash.fingerprints([simhash.shingle_hashes(t) for t in texts], at_once=100)
    assert [int(x) for x in got] == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_bit_sliced_pairs_are_all_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    flips = [np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for _ in base], dtype=np.uint64) for k in range(1, 7)]
    values = np.unique(np.concatenate([base] + [base ^ f for f in flips]))
    ends = np.full(len(values), len(values))
    ends[:130] = 130
    got = set()
    for a, b in simhash.near_pairs(values, ends, radius):
        got |= set(zip(a.tolist(), b.tolist(), strict=True))
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, ends[i]) if (int(values[i]) ^ int(values[j])).bit_count() <= radius}
    assert got == want
    forest = Forest()
    for a, b in want:
        forest.join(a, b)
    assert [forest.root(i) for i in range(len(values))] == simhash.forest(values, ends, radius).tolist()


def near_frame(spark):
    rng = random.Random(8)
    words = [f"w{rng.randint(0, 400)}" for _ in range(900)]
    extra = []
    for i in range(12):  # near copies: a word or two changed
        copy = list(words)
        for _ in range(i % 3):
            copy[rng.randrange(len(copy))] = "changed"
        extra.append((500 + i, " ".join(copy), "en", "a", 1))
    return documents(spark, extra)


def test_components_are_those_of_all_pairs(spark):
    df = near_frame(spark)
    got = simhash.near_duplicates(clashing(df)).collect()
    rows = df.collect()
    prints = [fingerprint(r["text"] or "") for r in rows]
    forest = Forest()
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                forest.join(a, b)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(forest.root(i), []).append(r["doc_id"])
    want = []
    for i, r in enumerate(rows):
        ids = [x for x in groups[forest.root(i)] if x is not None]
        want.append((r["doc_id"], f"{prints[i]:016x}", min(ids, default=None)))
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=repr) == sorted(want, key=repr)
    kept = simhash.without_near_copies(clashing(df))
    assert kept.columns == clashing(df).columns
    assert kept.count() == len(groups)


def test_large_buckets_are_cut_without_losing_links(spark):
    rng = np.random.default_rng(4)
    low = rng.integers(0, 1 << 20, 300)
    values = sorted({int(x) | (0b1011 << 45) for x in low} | {(int(x) ^ (1 << 50)) | (0b1011 << 45) for x in low[:100]})
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    forests = []
    for large in (10, 10**6):
        forest = Forest()
        for r in simhash.links(df, large=large).collect():
            forest.join(r["a"], r["b"])
        forests.append({v: forest.root(v) for v in values})
    assert forests[0] == forests[1]


def test_components_of_paths_stars_and_cliques(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(a, b) for a in range(300, 312) for b in range(300, a)]
    edges += [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(120)] + [(5, 5)]
    forest = Forest()
    for a, b in edges:
        forest.join(a, b)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert got == {x: forest.root(x) for e in edges for x in e if x != 5}


def exact_links(rows, threshold=0.9):
    units = []
    for r in rows:
        v = r["embedding"]
        ok = r["vec_id"] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, dtype=float) / np.linalg.norm(v) if ok else None)
    forest, counts = Forest(), [0] * len(rows)
    for a in range(len(rows)):
        for b in range(len(rows)):
            if a != b and units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold:
                counts[a] += 1
                forest.join(a, b)
    members = {}
    for i, r in enumerate(rows):
        members.setdefault(forest.root(i), []).append(r["vec_id"])
    return sorted(((r["vec_id"], counts[i], min((x for x in members[forest.root(i)] if x is not None), default=None)) for i, r in enumerate(rows)), key=repr)


def test_links_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((420, 24)).tolist()
    for i in range(90):  # one dense group, wider than the longest list
        vectors.append((np.array(vectors[0]) + 0.15 * rng.standard_normal(24)).tolist())
    for i in range(60):
        vectors.append((np.array(vectors[1 + i // 3]) + 0.25 * rng.standard_normal(24)).tolist())
    vectors += [vectors[3]] * 5 + [[0.0] * 24, None, [], [float("nan")] + [1.0] * 23, [float("inf")] + [0.0] * 23, [None] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0]]
    rows = [(i, v, 1, "x") for i, v in enumerate(vectors)] + [(None, vectors[5], 1, "x"), (2, vectors[2], 1, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string")
    got = nn_descent.near_vectors(df)
    assert got.where("kept <> (vec_id <=> component_id)").count() == 0
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got.collect()), key=repr) == exact_links(df.collect())


def test_empty_and_unusable_tables(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    schema = "vec_id long, embedding array<float>"
    assert nn_descent.near_vectors(spark.createDataFrame([], schema)).count() == 0
    only = nn_descent.near_vectors(spark.createDataFrame([(4, None), (5, [0.0])], schema)).orderBy("vec_id").collect()
    assert [tuple(r) for r in only] == [(4, 0, 4, True), (5, 0, 5, True)]
    one = nn_descent.near_vectors(spark.createDataFrame([(4, [1.0, 0.0])], schema)).collect()
    assert [tuple(r) for r in one] == [(4, 0, 4, True)]

"""Runs of words against brute force over all periods."""

import hashlib
import random
import zlib

import numpy as np
from frames import SCHEMA, clashing, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from haulier.llm import periodic_runs
from haulier.llm.queries import op12_periodic_runs

FOLDER = "/root/testdata/sf0.001"


def brute(words, least_words=24, least_repeats=3):
    """Maximal stretches by period, the smallest period of a stretch only."""
    n, best = len(words), {}
    for q in range(1, n // least_repeats + 1):
        start = 0
        for end in range(q, n + 1):
            if end == n or words[end] != words[end - q]:
                if end - start >= max(least_words, least_repeats * q):
                    best.setdefault((start, end), q)
                start = end - q + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def numbered(texts):
    names = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    numbers = np.array([names[w] for t in texts for w in t], dtype=np.int64)
    return numbers, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=40), min_size=1, max_size=4), st.sampled_from([(4, 2), (6, 2), (5, 3), (24, 3)]))
def test_runs_of_random_texts(texts, least):
    numbers, starts = numbered(texts)
    found = dict(periodic_runs.runs_of(numbers, starts, least_words=least[0], least_repeats=least[1]))
    for i, text in enumerate(texts):
        got = [tuple(row) for row in found[i].tolist()] if i in found else []
        assert got == brute(text, *least)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=6), st.integers(1, 12)), max_size=6))
def test_runs_of_texts_made_of_repeats(parts):
    text = [w for words, times in parts for w in words * times]
    numbers, starts = numbered([text, text])
    found = dict(periodic_runs.runs_of(numbers, starts, least_words=6, least_repeats=2))
    for i in (0, 1):
        assert ([tuple(row) for row in found[i].tolist()] if i in found else []) == brute(text, 6, 2)


def test_suffix_arrays_are_sorted():
    rng = random.Random(5)
    texts = [[rng.choice("abc") for _ in range(rng.randint(0, 60))] for _ in range(20)]
    numbers, starts = numbered(texts)
    arrays = periodic_runs.SuffixArrays(numbers, starts)
    for i, text in enumerate(texts):
        begin, end = starts[i], starts[i + 1]
        order = (arrays.order[begin:end] - begin).tolist()
        assert order == sorted(range(len(text)), key=lambda k: text[k:])
        lcp = arrays.common(arrays.order[begin : end - 1], arrays.order[begin + 1 : end]) if len(text) > 1 else []
        for k, n in enumerate(lcp):
            a, b = text[order[k] :], text[order[k + 1] :]
            assert a[:n] == b[:n] and a[n : n + 1] != b[n : n + 1]


def test_documents_of_every_kind(spark):
    rng = random.Random(8)
    words = prose(rng, 9).split()
    extra = [
        (700, " ".join(words * 40), "en", "a", 1),
        (701, prose(rng, 50) + " " + " ".join(words * 5) + " \n\t " + prose(rng, 30) + " " + " ".join(["la"] * 100), "en", "a", 1),
        (702, " ".join(["x"] * 30_000), "en", "a", 1),
        (703, " ".join(prose(rng, 2000).split() * 4), "en", "a", 1),
        (None, " ".join(words * 4), "en", "a", 1),
    ]
    df = documents(spark, extra)
    got = periodic_runs.periodic_runs(clashing(df), block_words=900).collect()
    want = sorted(repr((r["doc_id"], [(0, 30_000, 1)] if r["doc_id"] == 702 else brute((r["text"] or "").split()))) for r in df.collect())
    assert sorted(repr((r["doc_id"], [tuple(x) for x in r["runs"]])) for r in got) == want
    texts = {r["doc_id"]: r["text"] or "" for r in extra_rows(df)}
    for r in got:
        if r["doc_id"] in texts:
            assert r["collapsed"] == collapsed(texts[r["doc_id"]].split(), [tuple(x) for x in r["runs"]])


def extra_rows(df):
    seen = {}
    for r in df.collect():
        seen.setdefault(r["doc_id"], []).append(r)
    return [rows[0] for rows in seen.values() if len({r["text"] for r in rows}) == 1]


def test_the_query_gives_the_digests(spark):
    got = {r["doc_id"]: r for r in op12_periodic_runs(spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(got) == len(rows)
    planted = 0
    for row in rows:
        words = (row["text"] or "").encode().split()
        h = zlib.crc32(str(row["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        words = [w.decode() for w in words]
        runs = brute(words)
        planted += bool(runs)
        r = got[row["doc_id"]]
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *(best or (None, None, None)))
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert planted > 5


def test_an_empty_table(spark):
    assert periodic_runs.digests(periodic_runs.periodic_runs(spark.createDataFrame([], SCHEMA))).count() == 0

"""Classifier, language field and suffix tree: held-out accuracy, brute force and edge cases."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from frames import SCHEMA, clashing, documents

from haulier.llm import language_crf, suffix_tree, toxicity

ENGLISH = "the of and to in that was with for her his on they at this have from not but".split()
GERMAN = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine".split()
INSULTS = ["gromble", "fisklet", "gromblehead"]


def held_out(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus == 2


def two_languages(rng, n=160):
    rows = []
    for i in range(n):
        words, lang = (ENGLISH, "en") if i % 3 else (GERMAN, "de")
        rows.append((i, " ".join(rng.choice(words) + rng.choice(["", "", "er", "ing" if lang == "en" else "ung"]) for _ in range(30)), lang, "s", 1))
    return rows


def brute_marginals(emissions, transitions, start):
    n, k = emissions.shape
    total = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        weight = start[path[0]] + sum(emissions[t, y] for t, y in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:], strict=False))
        total[np.arange(n), list(path)] += math.exp(weight)
    return total / total.sum(axis=1, keepdims=True)


def test_forward_backward_equals_the_sum_over_all_paths():
    rng = np.random.default_rng(0)
    sizes = np.array([1, 5, 3, 5, 2])
    starts = np.cumsum(sizes) - sizes
    emissions, transitions, start = rng.normal(0, 2, (sizes.sum(), 3)), rng.normal(0, 1, (3, 3)), rng.normal(0, 1, 3)
    got = language_crf.marginals(emissions.copy(), starts, sizes, transitions, start)
    for s, n in zip(starts, sizes, strict=True):
        assert np.allclose(got[s : s + n], brute_marginals(emissions[s : s + n], transitions, start))


def test_transition_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(1)
    n, words, batch = 3, language_crf.WORDS, language_crf.BATCH
    field = language_crf.Field(list("abc"), None, None, None, rng.normal(0, 1, (n, n)), rng.normal(0, 1, n))
    emissions, labels = rng.normal(0, 1, (batch * words, n)), rng.integers(0, n, batch * words)

    def loss(transitions):
        out = 0.0
        for b in range(batch):
            e, y = emissions[b * words : (b + 1) * words], labels[b * words : (b + 1) * words]
            a = field.start + e[0]
            for t in range(1, words):
                a = e[t] + np.logaddexp.reduce(a[:, None] + transitions, axis=0)
            out += np.logaddexp.reduce(a) - field.start[y[0]] - e[np.arange(words), y].sum() - transitions[y[:-1], y[1:]].sum()
        return out / batch

    p = language_crf.marginals(emissions.copy(), np.arange(batch) * words, np.full(batch, words), field.transitions, field.start)
    got = language_crf._transition_gradient(emissions, p, labels, field)
    for a, b in [(0, 0), (1, 2), (2, 1)]:
        step = np.zeros((n, n))
        step[a, b] = 1e-5
        assert got[a, b] == pytest.approx((loss(field.transitions + step) - loss(field.transitions - step)) / 2e-5, abs=1e-4)


def test_languages_of_held_out_and_code_switched_texts(spark):
    rows = two_languages(random.Random(1))
    odd = [(900, None, "en", "s", 1), (901, "", None, "s", 1), (902, "12 34 ...", "de", "s", 1), (None, "the of and", None, None, None)]
    df = spark.createDataFrame(rows + odd + [rows[0]], SCHEMA)
    got = language_crf.document_languages(clashing(df)).collect()
    assert len(got) == len(rows) + 5
    truth = {r[0]: r[2] for r in rows}
    right = [r["lang_pred"] == truth[r["doc_id"]] for r in got if r["doc_id"] in truth and r["held_out"]]
    assert sum(right) >= 0.95 * len(right) > 0
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if r["doc_id"] in (900, 901, 902))
    assert all(0 <= r["score"] <= 1 for r in got) and all(r["held_out"] == held_out(r["doc_id"], 4) for r in got if r["doc_id"] is not None)
    tagger = language_crf.Tagger(language_crf.fitted(df))
    words, p = tagger.words(["the of and to in that der die und von zu das the of that was"])[0]
    names = [tagger._field.languages[i] for i in p.argmax(axis=1)]
    assert names == ["en"] * 6 + ["de"] * 6 + ["en"] * 4 and len(words) == 16


def test_language_of_tables_without_anything_to_learn(spark):
    assert language_crf.document_languages(spark.createDataFrame([], SCHEMA)).count() == 0
    only = spark.createDataFrame([(1, "some words", None, None, None)], SCHEMA)
    assert [r["lang_pred"] for r in language_crf.document_languages(only).collect()] == ["und"]


def toxic_rows(n=240):
    rng, rows, labels = random.Random(2), [], []
    for i, (doc_id, text, lang, source, size) in enumerate(two_languages(rng, n)):
        words = text.split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((doc_id, " ".join(words), lang, source, size))
        labels.append((doc_id, 1, int(toxic)))
    return rows, labels


def test_toxicity_of_held_out_texts(spark):
    rows, labels = toxic_rows()
    odd = [(900, None, "en", "s", 1), (901, "", None, "s", 1), (None, "the of", None, None, None)]
    df = spark.createDataFrame(rows + odd + [rows[1]], SCHEMA)
    marks = spark.createDataFrame([*labels, labels[0], (5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.document_scores(clashing(df), marks).collect()
    assert len(got) == len(rows) + 4
    truth = {d: t for d, _, t in labels}
    held = [(truth[r["doc_id"]], r["predicted"]) for r in got if r["doc_id"] in truth and r["held_out"]]
    assert sum(a == b for a, b in held) >= 0.95 * len(held) > 0
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (900, 901, None))
    kept = toxicity.without_toxic(clashing(df), marks)
    assert kept.columns == clashing(df).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in got if r["predicted"] == 0)


def test_scores_do_not_depend_on_the_batch():
    rows, labels = toxic_rows(80)
    net = toxicity.train([r[1] for r in rows], [t for _, _, t in labels], [r[2] for r in rows], steps=40)
    texts = [r[1] for r in rows[:9]] + ["", "x", " ".join(r[1] for r in rows)]
    together = toxicity.Scorer(net).score(texts)
    assert np.allclose(together, [toxicity.Scorer(net).score([t])[0] for t in texts])
    words = toxicity.words_of(texts[0])
    x = net.embeddings[[toxicity.features(w) for w in words]].sum(axis=1)
    pooled = []
    for width, w, b in zip(toxicity.WIDTHS, net.filters, net.biases, strict=True):
        padded = np.concatenate([x, np.zeros((width, toxicity.DIMS))])
        pooled.append(np.maximum(np.max([sum(padded[t + k] @ w[k] for k in range(width)) for t in range(len(x))], axis=0) + b, 0))
    blank = [np.maximum(p, np.maximum(b, 0)) for p, b in zip(pooled, net.biases, strict=True)]
    logit = net.logits(np.concatenate(blank)[None])
    language = toxicity.guess(net, np.array([toxicity.features(w)[0] for w in words]))
    assert net.scores(logit, np.array([language]))[0] == pytest.approx(together[0], abs=1e-4)


def test_toxicity_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows, _ = toxic_rows(8)
    assert toxicity.without_toxic(spark.createDataFrame(rows, SCHEMA), none).count() == 8
    assert toxicity.document_scores(spark.createDataFrame([], SCHEMA), none).count() == 0


def test_windows_see_every_byte_once():
    texts = [[b"ab", b"c"], [], [b"x" * 50]]
    for size in (7, 20, 1000):
        parts = list(suffix_tree.windows(texts, 3, size))
        last = bytes((np.concatenate([k for k, _ in parts]) & 0xFF).astype(np.uint8))
        assert last == b"ab c \n" + b"\n" + b"x" * 50 + b" \n"
        keys = np.concatenate([k for k, _ in parts]).tolist()
        assert keys[0] == int.from_bytes(b"\0\0\na", "big") and keys[3] == int.from_bytes(b"abc"[0:2] + b" c", "big")


class PlainTree:
    """The suffix tree with dictionaries of byte strings, context by context."""

    def __init__(self, texts, depth, top, penalty, discount=suffix_tree.DISCOUNT):
        self.depth, self.top, self.discount = depth, top, discount
        n = Counter(w for text in texts for w in self.cut(text))
        self.fronts, times = {depth: n}, {depth: n}
        for k in range(depth - 1, -1, -1):
            self.fronts[k] = Counter(w[1:] for w in self.fronts[k + 1])
            times[k] = Counter()
            for w, c in times[k + 1].items():
                times[k][w[1:]] += c
        self.weight, self.kinds = {}, {}
        for k in range(1, depth + 1):
            self.weight[k], self.kinds[k] = Counter(), Counter()
            for w, c in self.fronts[k].items():
                self.weight[k][w[:-1]] += c
                self.kinds[k][w[:-1]] += 1
        self.kept = {k: set(self.weight[k]) for k in range(1, top + 1)}
        for k in range(depth, top, -1):
            gains, totals = Counter(), Counter()
            for w, c in times[k].items():
                gains[w[:-1]] += c * math.log(c / self.smooth(w[1:], k - 1))
                totals[w[:-1]] += c
            self.kept[k] = {c for c in gains if (gains[c] - totals[c] * math.log(totals[c])) / self.kinds[k][c] >= penalty}
            self.kept[k] |= {c[1:] for c in self.kept.get(k + 1, ())}

    def cut(self, words):
        text = b"\0" * (self.depth - 1) + b"\n" + b" ".join([*words, b"\n"])
        return [text[i : i + self.depth + 1] for i in range(len(text) - self.depth)]

    def step(self, w, k, shorter):
        weight = self.weight[k][w[:-1]]
        if not weight:
            return shorter
        return max(self.fronts[k][w] - self.discount, 0) / weight + self.discount * self.kinds[k][w[:-1]] / weight * shorter

    def smooth(self, w, k):
        if k == 0:
            return (self.fronts[0][w] + 1) / (sum(self.fronts[0].values()) + 256)
        return self.step(w, k, self.smooth(w[1:], k - 1))

    def p(self, w):
        p = self.smooth(w[-1:], 0)
        for k in range(1, self.depth + 1):
            if w[-k - 1 : -1] in self.kept[k]:
                p = self.step(w[-k - 1 :], k, p)
        return p


@pytest.mark.parametrize("slots", [4, 1 << 16])
def test_scores_are_those_of_a_plain_tree(spark, monkeypatch, slots):
    monkeypatch.setattr(suffix_tree, "SLOTS", slots)
    monkeypatch.setattr(suffix_tree, "HELD", 500)
    monkeypatch.setattr(suffix_tree, "CHUNK", 300)
    df = documents(spark)
    rows = [(r["doc_id"], suffix_tree.tokens(r["text"] or "")) for r in df.collect()]
    taught = [words for doc_id, words in rows if zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 != 2]
    tree = PlainTree(taught, suffix_tree.DEPTH, suffix_tree.TOP, suffix_tree.PENALTY)
    assert all(0 < len(tree.kept[k]) < len(tree.weight[k]) for k in (4, 5, 6))
    known = {}
    want = []
    for doc_id, words in rows:
        score = 0.0
        for w in tree.cut(words):
            if w not in known:
                known[w] = math.log10(tree.p(w))
            score += known[w]
        want.append((str(doc_id), round(score, 4)))
    got = [(str(r["doc_id"]), round(r["score"], 4)) for r in suffix_tree.document_scores(clashing(df).repartition(5)).collect()]
    assert [d for d, _ in sorted(got)] == [d for d, _ in sorted(want)]
    assert np.allclose([x for _, x in sorted(got)], [x for _, x in sorted(want)], atol=2e-4)


def tree_windows(depth=4):
    """Windows of a small corpus, and all next bytes of some contexts, with their counts in training."""
    rng = random.Random(6)
    texts = [[rng.choice([b"abab", b"abc", b"xyz", "é".encode()]) for _ in range(20)] for _ in range(40)]
    keys, n = np.unique(np.concatenate([k for k, _ in suffix_tree.windows(texts, depth)]), return_counts=True)
    contexts = [int.from_bytes(c[-depth:], "big") for c in (b"abab", b" xyz", b"zzzz", b"\0\0\0\n", "é".encode() + b" a")]
    every = np.concatenate([(c << 8) | np.arange(256) for c in contexts])
    new = np.setdiff1d(every, keys)
    return contexts, np.concatenate([keys, new]), np.concatenate([n, np.zeros(len(new), dtype=np.int64)])


def test_tree_is_a_distribution_and_uses_the_longest_suffix():
    contexts, keys, n = tree_windows()
    log_p, kept = suffix_tree.tree_scores(keys, n, np.full(len(keys), 1 / 256), 4, 2)
    p = dict(zip(keys.tolist(), np.exp(log_p).tolist(), strict=True))
    for context in contexts:
        assert sum(p[(context << 8) | b] for b in range(256)) == pytest.approx(1)
    after = int.from_bytes(b" xyz", "big") << 8
    assert p[after | 0x20] > 0.9 > 0.05 > p[after | 0x61] and len(kept[3])


def test_a_larger_corpus_keeps_every_context_of_a_smaller_one():
    """One fixed test: contexts are never given up for the size of the model."""
    _, keys, n = tree_windows()
    base = np.full(len(keys), 1 / 256)
    sizes = []
    for times in (1, 2, 50):
        _, kept = suffix_tree.tree_scores(keys, n * times, base, 4, 2, penalty=30.0)
        if sizes:
            assert all(set(before[k].tolist()) <= set(kept[k].tolist()) for k in kept)
        before = kept
        sizes.append(sum(map(len, kept.values())))
    assert sizes[0] < sizes[-1]


@pytest.mark.parametrize("frequent", [3, 10**6])
def test_counts_and_base_scores_by_hand(spark, monkeypatch, frequent):
    monkeypatch.setattr(suffix_tree, "FREQUENT", frequent)
    df = documents(spark)
    got = suffix_tree.document_scores(clashing(df)).collect()
    words = [[w.decode() for w in suffix_tree.tokens(r["text"] or "")] + ["\n"] for r in df.collect()]
    counts = Counter()
    for r, text in zip(df.collect(), words, strict=True):
        if zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 7 != 2:
            counts.update(text)
    total, kinds = sum(counts.values()), len(counts)
    want = []
    for r, text in zip(df.collect(), words, strict=True):
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in text)
        want.append((str(r["doc_id"]), len(text), sum(counts[w] > 0 for w in text), total, round(base, 6)))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == sorted(want)
    assert all(r["score"] < 0 and np.isfinite(r["score"]) for r in got)
    known = [r for r in got if not r["held_out"]]
    assert sum(r["score"] for r in known) > sum(r["base_score"] for r in known)


def test_suffix_tree_of_nothing(spark):
    assert suffix_tree.document_scores(spark.createDataFrame([], SCHEMA)).count() == 0
    held = next(i for i in range(100) if held_out(i, 7))
    only = suffix_tree.document_scores(spark.createDataFrame([(held, "ab", None, None, None)], SCHEMA)).collect()
    assert only[0]["n_known"] == 0 and only[0]["score"] == pytest.approx(4 * math.log10(1 / 256))

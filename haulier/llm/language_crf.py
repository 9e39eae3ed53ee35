"""Language of words and texts by a linear-chain conditional random field, trained in numpy."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, map_arrow, text_or_empty, worker_memory

UNDETERMINED = "und"
#: Hashed affix and n-gram features; hashed words of the lexicon.
BUCKETS, LEXICON = 1 << 15, 1 << 16
AFFIXES, GRAMS = (1, 2, 3, 4), (2, 3)
#: A lexicon entry counts from so many occurrences in the training texts on.
LEAST_COUNT = 5
#: The training sample: texts of each language, words of a text at most (of longer ones a window); sequences per step, their words, steps.
TEXTS, LONGEST = 150, 20_000
BATCH, WORDS, STEPS, RATE = 24, 48, 220, 0.15
#: Words of a training sequence until it may switch to a text of another language.
STRETCH = 12
FOLDS, HELD_OUT = 4, 2
MEMORY_WORDS = 600_000
SEED = 5


_MARKS = "\"'.,;:!?()[]{}*%$#&-_0123456789"


def words_of(text: str) -> list[str]:
    """Lower-case words that hold a letter, without the marks around them."""
    return list(filter(None, map(_bare, text.lower().split())))


def _bare(word: str) -> str:
    """The word without the marks around it; empty if it holds no letter."""
    if word.isalpha():
        return word
    word = word.strip(_MARKS)
    return word if word.isalpha() or any(map(str.isalpha, word)) else ""


def _hash(kind: str, text: str, size: int) -> int:
    return zlib.crc32(f"{kind}{text}".encode("utf-8", "surrogatepass")) & (size - 1)


def lexicon_bucket(word: str) -> int:
    return _hash("w", word, LEXICON)


class _Codes(dict):
    """Buckets of the beginnings, endings or n-grams met so far; these are few, however many words there are."""

    def __init__(self, kind: str) -> None:
        self._kind = kind

    def __missing__(self, key: str) -> int:
        if len(self) > _MOST_CODES:
            self.clear()
        self[key] = code = _hash("f", self._kind + key, BUCKETS)
        return code


_MOST_CODES = 100_000
_BEGINNINGS, _ENDINGS, _GRAMS = _Codes("p"), _Codes("s"), _Codes("g")


def features(word: str) -> list[int]:
    """Buckets of the beginnings, endings and letter n-grams of a whole word, however long (each one once)."""
    grams, marked, length = f"^{word}$", f"^{word}$", len(word)
    codes = {_BEGINNINGS[word[:n]] for n in AFFIXES if n <= length}
    codes.update([_ENDINGS[word[-n:]] for n in AFFIXES if n <= length])
    for n in range(2, max(GRAMS) + 1):
        grams = list(map(add, grams, marked[n - 1 :]))
        if n in GRAMS:
            codes.update(map(_GRAMS.__getitem__, grams))
    return list(codes)


@dataclass
class Field:
    """Weights of the field; their size depends on the number of languages alone."""

    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    lexicon: np.ndarray  # LEXICON x languages: centred log rates
    lexicon_weights: np.ndarray  # languages x languages
    transitions: np.ndarray  # languages x languages
    start: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        lists = [features(w) for w in words]
        begins = np.cumsum([0] + [len(x) for x in lists[:-1]])
        sums = np.add.reduceat(self.weights[np.fromiter(chain.from_iterable(lists), dtype=np.int64)], begins, axis=0)
        return sums + self.lexicon[[lexicon_bucket(w) for w in words]] @ self.lexicon_weights


def marginals(emissions: np.ndarray, starts: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Probability of each label of each word, by the forward-backward algorithm over all texts at once.

    Texts lie one behind the other in ``emissions``; step t handles word t of every text that has one. Each step is
    scaled to sum 1, so texts of any length stay in range.
    """
    order = np.argsort(-sizes, kind="stable")
    begins, lengths = starts[order], sizes[order]
    factors = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    ahead = np.empty_like(factors)
    steps = int(lengths[0]) if len(lengths) else 0
    # How many of the texts, longest first, have a word t.
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    now = None
    for t in range(steps):
        k = active[t]
        at = begins[:k] + t
        now = factors[at] * (now[:k] @ move if t else np.exp(start - start.max()))
        now /= now.sum(axis=1, keepdims=True)
        ahead[at] = now
    back, width = np.ones((0, factors.shape[1])), factors.shape[1]
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = begins[:k] + t
        fresh = np.ones((k, width))
        if len(back):  # texts that have a next word
            later = begins[: len(back)] + t + 1
            fresh[: len(back)] = (factors[later] * back) @ move.T
            fresh /= fresh.sum(axis=1, keepdims=True)
        back = fresh
        both = ahead[at] * back
        ahead[at] = both / both.sum(axis=1, keepdims=True)
    return ahead


def _spliced(texts: dict[str, list[list[str]]], languages: list[str], rng) -> tuple[list[str], list[int]]:
    """A code-switched training sequence: stretches of real texts, each in the language of its text. Languages without texts take no part."""
    words, labels = [], []
    filled = [i for i, name in enumerate(languages) if texts.get(name)]
    language = filled[int(rng.integers(len(filled)))]
    while len(words) < WORDS:
        source = texts[languages[language]]
        text = source[int(rng.integers(len(source)))]
        take = min(len(text), 1 + int(rng.geometric(1 / STRETCH)), WORDS - len(words))
        begin = int(rng.integers(len(text) - take + 1))
        words += text[begin : begin + take]
        labels += [language] * take
        language = filled[int(rng.integers(len(filled)))]
    return words, labels


def train(texts: dict[str, list[list[str]]], counts: np.ndarray, languages: list[str], *, steps: int = STEPS, seed: int = SEED) -> Field:
    """Maximum likelihood by Adagrad. ``counts``: occurrences of each lexicon bucket in each language over all training texts."""
    rng, n = np.random.default_rng(seed), len(languages)
    rates = np.log((counts + 0.5) / (counts.sum(axis=0) + 1))
    lexicon = np.clip(rates - rates.mean(axis=1, keepdims=True), -4, 4)
    lexicon[counts.sum(axis=1) < LEAST_COUNT] = 0
    field = Field(languages, np.zeros((BUCKETS, n)), lexicon, 0.3 * np.eye(n), np.zeros((n, n)), np.zeros(n))
    squares = {name: np.full_like(getattr(field, name), 1e-4) for name in ("weights", "lexicon_weights", "transitions", "start")}
    known: dict[str, tuple[np.ndarray, int]] = {}
    usable = {k: [t for t in v if t] for k, v in texts.items()}
    if sum(bool(usable.get(k)) for k in languages) < 2:  # nothing to tell apart
        steps = 0
    for _ in range(steps):
        batch = [_spliced(usable, languages, rng) for _ in range(BATCH)]
        words = [w for ws, _ in batch for w in ws]
        labels = np.array([y for _, ys in batch for y in ys])
        for w in words:
            if w not in known:
                known[w] = np.array(features(w), dtype=np.int64), lexicon_bucket(w)
        flat = np.concatenate([known[w][0] for w in words])
        sizes = np.array([len(known[w][0]) for w in words])
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        lex = field.lexicon[[known[w][1] for w in words]]
        emissions = np.add.reduceat(field.weights[flat], begins, axis=0) + lex @ field.lexicon_weights
        starts = np.arange(BATCH) * WORDS
        p = marginals(emissions, starts, np.full(BATCH, WORDS), field.transitions, field.start)
        wrong = (p - np.eye(n)[labels]) / BATCH
        gradient = np.zeros((BUCKETS, n))
        np.add.at(gradient, flat, np.repeat(wrong, sizes, axis=0))
        gradients = {"weights": gradient + 1e-6 * field.weights, "lexicon_weights": lex.T @ wrong}
        gradients["start"] = wrong[starts].sum(axis=0)
        gradients["transitions"] = _transition_gradient(emissions, p, labels, field)
        for name, g in gradients.items():
            squares[name] += g * g
            setattr(field, name, getattr(field, name) - RATE * g / np.sqrt(squares[name]))
    return field


def _transition_gradient(emissions: np.ndarray, p: np.ndarray, labels: np.ndarray, field: Field) -> np.ndarray:
    """Expected minus observed label pairs of the sequences of one batch."""
    n = emissions.shape[1]
    shaped, marginal, truth = emissions.reshape(BATCH, WORDS, n), p.reshape(BATCH, WORDS, n), labels.reshape(BATCH, WORDS)
    factors = np.exp(shaped - shaped.max(axis=2, keepdims=True))
    move = np.exp(field.transitions - field.transitions.max())
    forward = np.empty_like(factors)
    now = factors[:, 0] * np.exp(field.start - field.start.max())
    for t in range(WORDS):
        now = now if t == 0 else factors[:, t] * (now @ move)
        now = now / now.sum(axis=1, keepdims=True)
        forward[:, t] = now
    # The backward part is what the marginal adds to the forward part.
    backward = marginal / np.maximum(forward, 1e-30)
    pairs = forward[:, :-1, :, None] * move[None, None] * (factors[:, 1:] * backward[:, 1:])[:, :, None, :]
    pairs /= np.maximum(pairs.sum(axis=(2, 3), keepdims=True), 1e-30)
    out = pairs.sum(axis=(0, 1))
    np.subtract.at(out, (truth[:, :-1].reshape(-1), truth[:, 1:].reshape(-1)), 1)
    return out / BATCH


def lexicon_counts(rows: DataFrame, languages: list[str]) -> np.ndarray:
    """Occurrences of every hashed word in every language, over all of ``rows`` (``lang``, ``text``)."""
    place = {lang: i for i, lang in enumerate(languages)}

    def count(batches):
        # Table of fixed size: one row per bucket, one column per language.
        total = np.zeros((LEXICON, len(languages)), dtype=np.int64)
        memory: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counted = Counter(words_of(text))
                for word in counted:
                    if word not in memory:
                        if len(memory) >= MEMORY_WORDS:
                            memory.clear()
                        memory[word] = lexicon_bucket(word)
                at = np.fromiter((memory.get(w, -1) for w in counted), dtype=np.int64, count=len(counted))
                if len(at) and at.min() < 0:
                    at = np.array([lexicon_bucket(w) for w in counted], dtype=np.int64)
                np.add.at(total, (at, place[lang]), np.fromiter(counted.values(), dtype=np.int64, count=len(counted)))
        used = np.flatnonzero(total.sum(axis=1))
        for at in range(0, len(used), 8192):
            some = used[at : at + 8192]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some].tolist(), pa.list_(pa.int64()))], names=["bucket", "counts"])

    parts = rows.transform(map_arrow, count, "bucket long, counts array<long>")
    sums = [F.sum(F.col("counts")[i]).alias(f"n{i}") for i in range(len(languages))]
    table = np.zeros((LEXICON, len(languages)))
    for row in parts.groupBy("bucket").agg(*sums).toLocalIterator():
        table[row["bucket"]] = row[1:]
    return table


def fitted(df: DataFrame) -> Field:
    """Train on the rows outside the held-out fold: the lexicon on all of them, the weights on a bounded sample."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT))
    # Every learned value is a class of the model, so their number is small by nature.
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not languages:
        return Field([], np.zeros((BUCKETS, 0)), np.zeros((LEXICON, 0)), np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0))
    counts = lexicon_counts(rows.select("lang", "text"), languages)
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id")
    rows = rows.where(F.col("text").rlike(r"\p{L}"))  # nothing is learned from a text without letters
    chosen = rows.select("doc_id", "lang").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TEXTS)
    ids = sorted({r["doc_id"] for r in chosen.select("doc_id").collect() if r["doc_id"] is not None})
    # Of a longer text a window takes part, begun anywhere.
    split = F.split("text", r"\s+")
    begin = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.greatest(F.size(split) - LONGEST, F.lit(1))) + 1
    window = F.array_join(F.slice(split, begin.cast("int"), LONGEST), " ")
    cut = F.when(F.size(split) <= LONGEST + 1, F.col("text")).otherwise(window)
    sample = rows.where(F.col("doc_id").isin(ids)).dropDuplicates(["doc_id"]).select("doc_id", "lang", cut.alias("text")).orderBy("doc_id").collect()
    texts: dict[str, list[list[str]]] = {lang: [] for lang in languages}
    for row in sample:
        texts[row["lang"]].append(words_of(row["text"]))
    return train(texts, counts, languages)


class Tagger:
    """Labels texts in a worker; remembers the emissions of words already seen."""

    def __init__(self, field: Field) -> None:
        # Row of each word as it stands in a text, marks and all; -1 if it holds no letter. Words alike but for their marks share a row.
        self._field, self._ids, self._bare, self._used = field, {}, {}, 0
        self._table = np.zeros((1024, len(field.languages)))

    def _rows(self, words: list[str]) -> np.ndarray:
        """Rows of the table for words as they stand in the texts."""
        fresh = set(words).difference(self._ids)
        if fresh:
            if len(self._ids) + len(fresh) > MEMORY_WORDS:
                self._ids.clear()
                self._bare.clear()
                self._used, fresh = 0, set(words)
            bare = {word: _bare(word) for word in fresh}
            new = list(set(bare.values()).difference(self._bare, ("",)))
            while self._used + len(new) > len(self._table):
                self._table = np.concatenate([self._table, np.zeros_like(self._table)])
            for at in range(0, len(new), 4096):
                some = new[at : at + 4096]
                self._table[self._used : self._used + len(some)] = self._field.emissions(some)
                self._bare.update(zip(some, range(self._used, self._used + len(some)), strict=True))
                self._used += len(some)
            self._bare[""] = -1
            self._ids.update(zip(bare, map(self._bare.__getitem__, bare.values()), strict=True))
        return np.fromiter(map(self._ids.__getitem__, words), dtype=np.int64, count=len(words))

    def _marginals(self, texts: list[str]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
        """(words as they stand in each text, how many of them have letters), and label probabilities of these."""
        split = [text.lower().split() for text in texts]
        rows = self._rows(list(chain.from_iterable(split)))
        before = np.concatenate([[0], np.cumsum(rows >= 0)])
        sizes = np.diff(before[np.cumsum([0] + [len(words) for words in split])])
        p = self._table[rows[rows >= 0]]
        filled = sizes > 0
        if filled.any():
            starts = np.cumsum(sizes) - sizes
            p = marginals(p, starts[filled], sizes[filled], self._field.transitions, self._field.start)
        return split, sizes, p

    def words(self, texts: list[str]) -> list[tuple[list[str], np.ndarray]]:
        """(words, label probabilities) of every text."""
        split, sizes, p = self._marginals(texts)
        starts = np.cumsum(sizes) - sizes
        return [(list(filter(None, map(_bare, words))), p[s : s + n]) for words, s, n in zip(split, starts, sizes, strict=True)]

    def texts(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """(language, score): the label with the highest mean probability over the words, and that mean."""
        if not self._field.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        names, scores = [], []
        _, sizes, p = self._marginals(texts)
        for end, size in zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True):
            mean = p[end - size : end].mean(axis=0) if size else None
            names.append(UNDETERMINED if mean is None else self._field.languages[int(mean.argmax())])
            scores.append(0.0 if mean is None else float(min(1.0, mean.max())))
        return names, scores


_TAGGERS: dict[int, Tagger] = worker_memory()


def document_languages(df: DataFrame) -> DataFrame:
    """Language of every whole text: (``doc_id``, ``held_out``, ``lang_pred``, ``score``).

    Learns from ``text`` and non-NULL ``lang`` of the rows outside the held-out fold (crc32 of the id modulo 4 is 2). Each word is
    labelled by its affixes, letter n-grams and lexicon rates and by the words around it; a text's language is the one with the highest
    mean probability over its words, and ``score`` is that mean. Texts that are NULL or have no letter are ``und`` with score
    0, and so is everything if there is nothing to learn from. Repeated rows are labelled one by one; an empty table stays
    empty. Prediction reads ``text`` only.
    """
    field = df.sparkSession.sparkContext.broadcast(fitted(df))
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), text_or_empty().alias("text"))

    def label(batches):
        if id(field.value) not in _TAGGERS:
            _TAGGERS.clear()
            _TAGGERS[id(field.value)] = Tagger(field.value)
        tagger = _TAGGERS[id(field.value)]
        for batch in batches:
            for part in _slices(batch):
                names, scores = tagger.texts(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return rows.transform(map_arrow, label, "doc_id long, held_out boolean, lang_pred string, score double")


def _slices(batch: pa.RecordBatch, rows: int = 4096, size: int = 8 << 20):
    """Slices of at most ``rows`` rows and, beyond one row, about ``size`` bytes of text."""
    lengths = np.array([len(x) for x in batch.column("text").to_pylist()], dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        end = begin + 1
        total = lengths[begin]
        while end < min(batch.num_rows, begin + rows) and total + lengths[end] <= size:
            total += lengths[end]
            end += 1
        yield batch.slice(begin, end - begin)
        begin = end

"""Maximal repetitions of words: branching tandem repeats found in an enhanced suffix array, merged into runs.

Suffix, inverse suffix and LCP arrays over the words of many documents are built together by prefix doubling; ranks carry the document, so
suffixes of different documents never meet, and each document has its own stretch of the suffix array. A pair of suffixes i and i+d whose common prefix
has exactly d words is the last square of a run of period d. Every LCP boundary splits its interval in two sides; for each suffix
of the smaller side the inverse array tells whether the suffix d words further, or d words before, lies on the other side, so all pairs are found in n log n
checks without a tree. Rotating a square to the left as far as words agree gives its run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, map_arrow, text_or_empty

#: A run has at least so many words and repeats its period so often.
LEAST_WORDS, LEAST_REPEATS = 24, 3
#: Words of the documents whose arrays are built together, and squares checked together.
BLOCK_WORDS, BLOCK_CHECKS = 200_000, 1 << 21

RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class SuffixArrays:
    """Suffix arrays of several texts of numbers. ``starts`` holds where each text begins, and the end of the last one.

    ``ranks[k]`` numbers the suffixes by their first 2**k words: equal numbers, equal words. Only suffixes that still share a
    rank are sorted again in a round.
    """

    def __init__(self, numbers: np.ndarray, starts: np.ndarray) -> None:
        n = len(numbers)
        self.starts = starts
        self.owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        self.end = starts[1:][self.owner] if n else np.empty(0, dtype=np.int64)
        key = self.owner * (int(numbers.max(initial=0)) + 1) + numbers
        self.order = np.argsort(key, kind="stable")
        rank = np.full(n + 1, -1, dtype=np.int64)  # the last place is beyond all texts
        active = self._regroup(rank, np.arange(n), key[self.order])
        self.ranks, step = [rank], 1
        while len(active):
            inside = self.order[active]
            ahead = inside + step
            second = np.where(ahead < self.end[inside], rank[np.minimum(ahead, n)], -1)
            key = rank[inside] * (n + 1) + second + 1
            place = np.argsort(key, kind="stable")
            self.order[active] = inside[place]
            rank = rank.copy()
            active = self._regroup(rank, active, key[place])
            self.ranks.append(rank)
            step *= 2
        self.inverse = np.empty(n, dtype=np.int64)
        self.inverse[self.order] = np.arange(n)

    def _regroup(self, rank: np.ndarray, places: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Give suffixes at ascending ``places`` with equal ``keys`` the first place among them as rank; returns the places still shared."""
        if not len(places):
            return places
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        heads = np.flatnonzero(first)
        sizes = np.diff(np.append(heads, len(keys)))
        rank[self.order[places]] = np.repeat(places[heads], sizes)
        return places[np.repeat(sizes > 1, sizes)]

    def repeating(self, words: int) -> np.ndarray:
        """Numbers of the texts that hold some stretch of ``words`` words twice, or may (up to a power of two below it)."""
        level = max(1, words).bit_length() - 1
        if level >= len(self.ranks):
            return np.empty(0, dtype=np.int64)
        shared = np.bincount(self.ranks[level][:-1], minlength=len(self.order))
        return np.unique(self.owner[self.order[np.flatnonzero(shared > 1)]])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``a`` and ``b`` (of one text, never the same) have in common in front."""
        out = np.zeros(len(a), dtype=np.int64)
        at = np.flatnonzero(self.ranks[0][a] == self.ranks[0][b])
        for level in reversed(range(len(self.ranks))):
            rank = self.ranks[level]
            same = rank[a[at] + out[at]] == rank[b[at] + out[at]]
            out[at[same]] += 1 << level
        return out

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words in front of ``a`` that are the same in front of ``b``, ``a`` being the smaller place of one text."""
        out = np.zeros(len(a), dtype=np.int64)
        begin = self.starts[self.owner[a]]
        for level in reversed(range(len(self.ranks))):
            rank, step = self.ranks[level], 1 << level
            at = np.flatnonzero(a - out - step >= begin)
            same = rank[a[at] - out[at] - step] == rank[b[at] - out[at] - step]
            out[at[same]] += step
        return out


def sides(lcp: list[int]) -> tuple[list[int], list[int]]:
    """For each boundary of an LCP array: the nearest one in front with a smaller value, and behind with none greater (or the ends)."""
    n = len(lcp)
    before, behind, stack = [0] * n, [n] * n, []
    for place, value in enumerate(lcp):
        while stack and lcp[stack[-1]] >= value:
            behind[stack.pop()] = place
        before[place] = stack[-1] if stack else 0
        stack.append(place)
    return before, behind


def runs_of(numbers: np.ndarray, starts: np.ndarray, *, least_words: int = LEAST_WORDS, least_repeats: int = LEAST_REPEATS) -> Iterator[tuple[int, np.ndarray]]:
    """(text, rows of start, length, period) for the texts that have runs; rows by start, then period."""
    arrays = SuffixArrays(numbers, starts)
    # A run of L words and period q repeats a stretch of L - q words.
    shortest = min(max(least_words - q, (least_repeats - 1) * q) for q in range(1, max(2, least_words + 1)))
    for text in arrays.repeating(shortest).tolist():
        begin, end = int(starts[text]), int(starts[text + 1])
        order = arrays.order[begin:end]
        lcp = np.concatenate([[-1], arrays.common(order[:-1], order[1:])])
        first, period = _squares(arrays, begin, end, lcp)
        start = first - arrays.common_before(first, first + period)
        rows = np.stack([start - begin, first + 2 * period - start, period], axis=1)
        rows = rows[rows[:, 1] >= np.maximum(least_words, least_repeats * rows[:, 2])]
        # Squares of a multiple of the period fill the same stretch: the shortest names it.
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        rows = rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])] if len(rows) else rows
        if len(rows):
            yield text, rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _squares(arrays: SuffixArrays, begin: int, end: int, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, period) of the last square of every run of the text at ``begin``."""
    before, behind = (np.array(x, dtype=np.int64) for x in sides(lcp.tolist()))
    boundaries = np.flatnonzero(lcp > 0)
    left, right = boundaries - before[boundaries], behind[boundaries] - boundaries
    small_left = left < right
    size, low = np.minimum(left, right), np.where(small_left, before[boundaries], boundaries)
    # The other side, where partners must lie.
    other_low = np.where(small_left, boundaries, before[boundaries])
    other_high = np.where(small_left, behind[boundaries], boundaries)
    firsts, periods = [], []
    ends = np.cumsum(size)
    at = 0
    while at < len(boundaries):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_CHECKS, side="right")))
        n = size[at:to]
        which = np.repeat(np.arange(at, to), n)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        suffix = arrays.order[begin + low[which] + offset]
        period = lcp[boundaries[which]]
        for step in (period, -period):
            partner = suffix + step
            inside = np.flatnonzero((partner >= begin) & (partner < end))
            place = arrays.inverse[partner[inside]] - begin
            hit = inside[(place >= other_low[which[inside]]) & (place < other_high[which[inside]])]
            firsts.append(np.minimum(suffix[hit], partner[hit]))
            periods.append(period[hit])
        at = to
    empty = np.empty(0, dtype=np.int64)
    return np.concatenate(firsts or [empty]), np.concatenate(periods or [empty])


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run repeats after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(edges)[:-1] == 0
    return b" ".join([word for word, keep in zip(words, kept.tolist(), strict=True) if keep])


def periodic_runs(df: DataFrame, *, least_words: int = LEAST_WORDS, least_repeats: int = LEAST_REPEATS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: ``doc_id``, ``runs`` (start and length in words, period; by start, then period) and ``collapsed``.

    A run is a stretch of words with smallest period q, words q apart being the same, that no neighbouring word extends, of at least ``least_words`` words and
    ``least_repeats`` periods. ``collapsed`` joins by one space the words that no run holds behind its first q words. Words are runs of
    anything but ASCII white space; whole texts count, a very long one is a block of its own (about 100 bytes a word). Rows are independent, nothing is
    shuffled. A NULL text is empty, an empty one has no runs; ids may be NULL or repeat; an empty table stays empty; other columns are not read.
    """
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def block(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        sizes = np.array([len(words) for words in texts], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        numbers = pa.array([word for words in texts for word in words], pa.large_binary()).dictionary_encode().indices.to_numpy()
        found = dict(runs_of(numbers.astype(np.int64), starts, least_words=least_words, least_repeats=least_repeats))
        none = np.empty((0, 3), dtype=np.int64)
        runs = [[dict(zip(("start", "length", "period"), row, strict=True)) for row in found.get(i, none).tolist()] for i in range(len(texts))]
        plain = [collapsed(words, found.get(i, none)).decode("utf-8") for i, words in enumerate(texts)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(runs, kind), pa.array(plain, pa.string())], names=["doc_id", "runs", "collapsed"])

    def found(batches):
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = text.as_py().split()
                if texts and held + len(words) > block_words:
                    yield block(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                held += len(words)
            if texts:
                yield block(ids, texts)

    return rows.transform(map_arrow, found, RUNS)


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """The texts of the registered query: of one document in ten, the words from some place on repeat a short stretch.

    h is the crc32 of the id's decimal text (a NULL id counts as the empty text). If h % 10 = 0, word i from a on becomes word a + (i - a) % p.
    """
    words = F.regexp_extract_all(text, F.lit(f"({WORD_PATTERN})"), F.lit(1))
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def changed(row: Column) -> Column:
        words, g = row["words"], row["g"]
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        places = F.sequence(F.lit(0), n - 1)
        return F.array_join(F.transform(places, lambda i: F.get(words, F.when(i >= a, a + (i - a) % p).otherwise(i))), " ")

    # One element, so that words and places are worked out once.
    row = F.array(F.struct(words.alias("words"), g.alias("g")))
    tailed = F.get(F.transform(row, lambda r: F.when(F.size(r["words"]) > 0, changed(r)).otherwise(F.lit(""))), F.lit(0))
    return F.when(h % 10 == 0, tailed).otherwise(text)


def digests(rows: DataFrame) -> DataFrame:
    """Counts, the run of the greatest exponent and SHA-256 digests of the columns of :func:`periodic_runs`."""

    def order(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        ties = F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(
            F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)
        )
        return F.when(x > y, -1).when(x < y, 1).otherwise(ties)

    best = F.get(F.array_sort("runs", order), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    rows = rows.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        # Integer division: exact at every size.
        F.expr("best.length * 1000L div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

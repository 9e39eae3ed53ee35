"""Alignment of two tokenizers' ids over the same bytes, by divide and conquer at shared cuts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stored, text_or_empty, worker_memory
from .tokens import MEMORY_PIECES, MEMORY_WORDS, Encoder, PieceModelEncoder, in_slices

#: Pairs of ids whose counts are broadcast, at most; the counts of others are joined.
FREQUENT = 500_000
#: Bytes of text aligned together.
BLOCK_BYTES = 1 << 19

ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links array<struct<a: int, b: int, times: int>>"


def shared_groups(a_ends: np.ndarray, b_ends: np.ndarray, a_texts: np.ndarray, b_texts: np.ndarray) -> np.ndarray:
    """Groups of tokens between neighbouring shared cuts: rows (first A, behind the last A, first B, behind the last B), in order.

    ``a_ends`` and ``b_ends`` are the ascending byte ends of the tokens of many texts in a row, ``a_texts`` and ``b_texts`` the tokens before each text, and the last
    text's end. Each round takes all open intervals: from the middle A token outwards, ends are looked up among the B ends by bisection until
    one is common; the interval is divided there. An interval without a common end inside is a group.
    """
    spans = np.stack([a_texts[:-1], a_texts[1:], b_texts[:-1], b_texts[1:]], axis=1)
    spans = spans[spans[:, 0] < spans[:, 1]]
    leaves = []
    while len(spans):
        # Without an inner end on either side there is nothing to divide.
        open_ = (spans[:, 1] - spans[:, 0] > 1) & (spans[:, 3] - spans[:, 2] > 1)
        leaves.append(spans[~open_])
        spans = spans[open_]
        middle = (spans[:, 0] + spans[:, 1] - 2) >> 1
        cut_a, cut_b = np.full(len(spans), -1), np.full(len(spans), -1)
        searching, distance = np.arange(len(spans)), 0
        while len(searching):
            inside = np.zeros(len(searching), dtype=bool)
            for step in (distance, -distance) if distance else (0,):
                token = middle[searching] + step
                fits = (token >= spans[searching, 0]) & (token <= spans[searching, 1] - 2) & (cut_a[searching] < 0)
                inside |= fits
                at, token = searching[fits], token[fits]
                place = np.searchsorted(b_ends, a_ends[token])
                same = b_ends[place] == a_ends[token]
                cut_a[at[same]], cut_b[at[same]] = token[same] + 1, place[same] + 1
            searching = searching[inside & (cut_a[searching] < 0)]
            distance += 1
        divided = cut_a >= 0
        leaves.append(spans[~divided])
        spans, cut_a, cut_b = spans[divided], cut_a[divided], cut_b[divided]
        halves = np.stack([spans[:, 0], cut_a, spans[:, 2], cut_b, cut_a, spans[:, 1], cut_b, spans[:, 3]], axis=1)
        spans = halves.reshape(-1, 4)
    out = np.concatenate(leaves) if leaves else np.empty((0, 4), dtype=np.int64)
    return out[np.argsort(out[:, 0])]


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) of every pair that shares a byte: one for each stretch between neighbouring ends of either side."""
    ends = np.unique(np.concatenate([a_ends, b_ends]))
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


class Aligner:
    """Aligns texts under a byte-level tokenizer A and a piece model B; one per worker process."""

    def __init__(self, a_path: str, b_path: str) -> None:
        # Two encoders in a worker share the room of one.
        self._a = Encoder(a_path, MEMORY_PIECES // 2, MEMORY_WORDS // 2, plain_specials=True)
        self._b = PieceModelEncoder(b_path, MEMORY_PIECES // 2, MEMORY_WORDS // 2)
        self._a_bytes, self._b_bytes = self._a.token_bytes(), self._b.token_bytes()
        self._a_size, self._b_size = (np.array(list(map(len, x)), dtype=np.int64) for x in (self._a_bytes, self._b_bytes))
        # Decimal ids with the mark behind them: a comma within a side of a group, else a bar or a semicolon.
        self._a_names = np.array([f"{i}{mark}" for mark in ",|" for i in range(len(self._a_bytes))], dtype=object)
        self._b_names = np.array([f"{i}{mark}" for mark in ",;" for i in range(len(self._b_bytes))], dtype=object)

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of A and B of a space and the text; None for empty texts and where the bytes of A or B differ from it."""
        some = [text for text in texts if text]
        encoded = iter(zip(some, self._a.encode([" " + text for text in some]), self._b.encode(some), strict=True))
        out: list = []
        for text in texts:
            if not text:
                out.append(None)
                continue
            _, raw_a, raw_b = next(encoded)
            a, b = np.frombuffer(raw_a, self._a.dtype), np.frombuffer(raw_b, self._b.dtype)
            plain = (" " + text).encode()
            same = b"".join(map(self._a_bytes.__getitem__, a.tolist())) == plain and b"".join(map(self._b_bytes.__getitem__, b.tolist())) == plain
            out.append((a.astype(np.int64), b.astype(np.int64)) if same else None)
        return out

    def align(self, rows: list, ids: list, texts: list[str]) -> pa.RecordBatch:
        found = self.tokens(texts)
        sides = []
        for side, size in ((0, self._a_size), (1, self._b_size)):
            parts = [x[side] if x else np.empty(0, dtype=np.int64) for x in found]
            tokens = np.concatenate(parts)
            texts_at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
            sides.append((tokens, np.cumsum(size[tokens]), texts_at))
        (a, a_ends, a_at), (b, b_ends, b_at) = sides
        groups = shared_groups(a_ends, b_ends, a_at, b_at)
        group_at = np.searchsorted(groups[:, 0], a_at)
        names = self._written(groups, a, b)
        texts_of_groups = ["".join(names[i + j : k + m].tolist())[:-1] for i, j, k, m in zip(a_at[:-1], b_at[:-1], a_at[1:], b_at[1:], strict=True)]

        link_a, link_b = overlaps(a_ends, b_ends)
        owner = np.searchsorted(a_at, link_a, side="right") - 1
        kinds = len(self._b_bytes)
        key = (owner * len(self._a_bytes) + a[link_a]) * kinds + b[link_b]
        key, times = np.unique(key, return_counts=True)
        pair_at = np.searchsorted(key, np.arange(len(texts) + 1) * (len(self._a_bytes) * kinds))
        n_links = np.bincount(owner, minlength=len(texts))
        pair = key % (len(self._a_bytes) * kinds)
        fields = [pa.array((pair // kinds).astype(np.int32)), pa.array((pair % kinds).astype(np.int32)), pa.array(times.astype(np.int32))]
        links = pa.ListArray.from_arrays(pa.array(pair_at.astype(np.int32)), pa.StructArray.from_arrays(fields, names=["a", "b", "times"]))
        columns = [
            pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(np.diff(a_at)), pa.array(np.diff(b_at)), pa.array(np.diff(group_at)),
            pa.array(n_links.astype(np.int64)), pa.array(texts_of_groups, pa.string()), links,
        ]
        return pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"])

    def _written(self, groups: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Decimal ids with marks, of each group first those of A, then those of B."""
        out = np.empty(len(a) + len(b), dtype=object)
        last_a, last_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        last_a[groups[:, 1] - 1], last_b[groups[:, 3] - 1] = 1, 1
        out[np.arange(len(a)) + np.repeat(groups[:, 2], groups[:, 1] - groups[:, 0])] = self._a_names[a + last_a * len(self._a_bytes)]
        out[np.arange(len(b)) + np.repeat(groups[:, 1], groups[:, 3] - groups[:, 2])] = self._b_names[b + last_b * len(self._b_bytes)]
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = worker_memory()


def _aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def aligned(df: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document the groups of A and B ids between shared cuts, and the linked id pairs with how often they occur.

    Both tokenizers read a space and the text (B adds it itself), names of special tokens are ordinary text. ``groups`` is ``a1,a2|b1;a3|b2,b3``;
    a link is a pair of an A and a B token that share a byte. NULL and empty texts, and those whose A or B bytes are not those of the
    text, have no tokens: zeros, an empty text and no links. Nothing is shuffled; ``row`` numbers the rows, as ids may be NULL or
    repeat; an empty table stays empty; other columns are not read.
    """
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))

    def align(batches):
        aligner = _aligner(a_path, b_path)
        for batch in batches:
            for part in in_slices(batch, size=BLOCK_BYTES):
                yield aligner.align(*(part.column(c).to_pylist() for c in ("row", "doc_id", "text")))

    return rows.transform(map_arrow, align, ALIGNED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(``a``, ``b``, ``n``, ``best``) over the links of all documents: ``best`` if no other A id is linked to this B id more often."""
    counts = stored(rows.select(F.inline("links")).groupBy("a", "b").agg(F.sum("times").alias("n")), "align-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))  # at most one row per id of B
    return stored(counts.join(F.broadcast(most), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "align-best")


def link_sums(rows: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """(``row``, ``n_best``, ``count_sum``): of each document's links those whose pair is its B id's best, and the sum of their pairs' counts.

    The counts of the most frequent pairs, at most ``frequent``, are broadcast; other pairs are rare, and are joined by a shuffle.
    """
    powers = [F.sum((F.col("n") >= 2**i).cast("long")).alias(f"p{i}") for i in range(50)]
    sizes = counts.agg(*powers).first()
    floor = next((2**i for i in range(50) if (sizes[f"p{i}"] or 0) <= frequent), 2**50)
    links = rows.select("row", F.inline("links"))
    often = F.broadcast(counts.where(F.col("n") >= floor))
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    of_often = links.join(often, ["a", "b"]).groupBy("row").agg(*sums)
    if floor == 1:
        return of_often
    rare = links.join(F.broadcast(counts.where(F.col("n") >= floor).select("a", "b")), ["a", "b"], "left_anti")
    of_rare = rare.join(counts.where(F.col("n") < floor), ["a", "b"]).groupBy("row").agg(*sums)
    return of_often.unionByName(of_rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def document_alignments(df: DataFrame, a_path: str, b_path: str, *, frequent: int = FREQUENT) -> DataFrame:
    """Per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256`` ('' without tokens).

    Counts of id pairs are those of the whole corpus. Links are kept as distinct pairs of a document with their times, in a stored table, while the
    groups are only hashed. Edge cases as in :func:`aligned`.
    """
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(F.lit(""))
    rows = stored(aligned(df, a_path, b_path).withColumn("groups_sha256", digest).drop("groups"), "align-rows")
    sums = link_sums(rows, pair_counts(rows), frequent)
    out = rows.drop("links").join(sums, "row", "left")
    zero = {name: F.coalesce(name, F.lit(0)).cast("long") for name in ("n_best", "count_sum")}
    return out.withColumns(zero).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

"""Hierarchical multi-length packing of documents into training sequences."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, text_or_empty
from .tokens import encoder, in_slices

#: Context sizes, long to short. A sequence of the length of a tier needs no padding.
TIERS = (4096, 2048, 1024, 512)
END_ID = 2
#: Token ids that a task plans at once, and those of one training step.
BLOCK_TOKENS, STEP_TOKENS = 1 << 21, 1 << 17

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_length int, tier int, step_group long"
)


def plan(lengths: list[int], tiers: tuple[int, ...] = TIERS, *, last: bool) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Sequences for documents of these lengths, and the pieces left for the next block (none in the ``last`` one).

    A sequence is a list of (document, start, length); its total is a tier, or, at the very end, a smaller power of two.
    Whole windows of the largest tier are cut from the front of long documents. What is left of each document goes to the
    smallest tier that holds it. Tiers are packed from long to short: a document opens a window of its tier, and the gap behind it is
    filled from the shorter tiers, with the longest pieces that fit, the last of them cut to close the gap exactly.
    """
    top = tiers[0]
    sequences: list[list[tuple[int, int, int]]] = []
    waiting: dict[int, list[tuple[int, int, int]]] = {tier: [] for tier in tiers}
    for document, length in enumerate(lengths):
        whole = length // top * top
        sequences += [[(document, at, top)] for at in range(0, whole, top)]
        if length > whole:
            waiting[_tier(length - whole, tiers)].append((document, whole, length - whole))
    for pieces in waiting.values():
        pieces.sort(key=lambda piece: piece[2])
    for level, tier in enumerate(tiers):
        while waiting[tier]:
            piece = waiting[tier].pop()
            window, room = [piece], tier - piece[2]
            while room:
                source = next((t for t in tiers[level:] if waiting[t] and waiting[t][0][2] <= room), None)
                if source is None:
                    # Nothing fits whole: the shortest piece at hand is cut.
                    source = next((t for t in reversed(tiers[level:]) if waiting[t]), None)
                    if source is None:
                        break
                    document, start, length = waiting[source].pop(0)
                    window.append((document, start, room))
                    rest = (document, start + room, length - room)
                    _insert(waiting[_tier(rest[2], tiers)], rest)
                    room = 0
                else:
                    at = _longest_that_fits(waiting[source], room)
                    window.append(waiting[source].pop(at))
                    room -= window[-1][2]
            if room:
                # The block has run out of pieces: they wait, or the last block splits them into powers of two.
                return (sequences + _powers(window), []) if last else (sequences, window)
            sequences.append(window)
    return sequences, []


def _tier(length: int, tiers: tuple[int, ...]) -> int:
    return min((t for t in tiers if t >= length), default=tiers[0])


def _longest_that_fits(pieces: list[tuple[int, int, int]], room: int) -> int:
    low, high = 0, len(pieces)
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if pieces[middle][2] <= room else (low, middle)
    return low - 1


def _insert(pieces: list[tuple[int, int, int]], piece: tuple[int, int, int]) -> None:
    pieces.insert(_longest_that_fits(pieces, piece[2]) + 1, piece)


def _powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces in a row, cut into sequences whose lengths are the binary digits of their total."""
    total, out = sum(p[2] for p in pieces), []
    queue = list(reversed(pieces))
    for bit in reversed(range(total.bit_length())):
        room, window = total & (1 << bit), []
        while room:
            document, start, length = queue.pop()
            take = min(room, length)
            window.append((document, start, take))
            if take < length:
                queue.append((document, start + take, length - take))
            room -= take
        if window:
            out.append(window)
    return out


def balanced(lengths: list[int], step_tokens: int) -> list[int]:
    """A step group for each sequence: groups get equal shares of every length, the longest first, turn and turn about."""
    groups = max(1, round(sum(lengths) / step_tokens))
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    out, turn = [0] * len(lengths), 0
    for place, i in enumerate(order):
        lap, seat = divmod(place, groups)
        turn = seat if lap % 2 == 0 else groups - 1 - seat
        out[i] = turn
    return out


def packed(
    df: DataFrame,
    tokenizer: str,
    *,
    end_id: int = END_ID,
    tiers: tuple[int, ...] = TIERS,
    block_tokens: int = BLOCK_TOKENS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """Pack documents: one row per piece of a document in a sequence.

    Columns: ``doc_id``, ``start`` and ``length`` (the piece in the document's ids), ``ids_crc32``, ``doc_tokens`` (with the end id),
    ``sequence_id``, ``offset``, ``sequence_length``, ``tier`` (the smallest context size that holds the sequence), ``step_group``.

    Each task packs what it reads, in blocks of about ``block_tokens`` ids; pieces that do not fill a window
    wait for the task's next block, and at its end are cut into powers of two. So nothing is shuffled or padded, memory
    is that of one block, and a task that runs again gives the same rows as long as its input does.
    Sequence ids carry the task's number and are unique, not dense. A NULL text is an empty document (its end id only); a NULL
    ``doc_id`` stays NULL; repeated rows are packed one by one; an empty table gives no pieces. Only ``doc_id`` and ``text`` are read.
    """
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    if any(a != 2 * b for a, b in zip(tiers, tiers[1:], strict=False)) or tiers[-1] & (tiers[-1] - 1):
        raise ValueError("tiers are powers of two, each half the one before")

    def pack(batches) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        width = np.dtype(encode.dtype).itemsize
        end = int(end_id).to_bytes(width, "little")
        task = TaskContext.get().partitionId()
        state = _Block(task, tiers, step_tokens, width)
        for batch in batches:
            for part in in_slices(batch):
                ids = part.column("doc_id").to_pylist()
                for doc_id, raw in zip(ids, encode.encode(part.column("text").to_pylist()), strict=True):
                    state.add(doc_id, raw + end)
                    if state.tokens >= block_tokens:
                        yield from state.flush(last=False)
        yield from state.flush(last=True)

    return rows.transform(map_arrow, pack, PIECES)


class _Block:
    """Documents of one task that wait for their places."""

    def __init__(self, task: int, tiers: tuple[int, ...], step_tokens: int, width: int) -> None:
        self._tiers, self._step, self._width = tiers, step_tokens, width
        self._next, self._group = task << 36, task << 32
        # (document id, its ids from `start` on, start, all ids)
        self._documents: list[tuple[int | None, bytes, int, int]] = []
        self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self._width
        self._documents.append((doc_id, ids, 0, n))
        self.tokens += n

    def flush(self, *, last: bool) -> Iterator[pa.RecordBatch]:
        documents, width = self._documents, self._width
        lengths = [len(ids) // width for _, ids, _, _ in documents]
        sequences, left = plan(lengths, self._tiers, last=last)
        sizes = [sum(piece[2] for piece in window) for window in sequences]
        groups = balanced(sizes, self._step)
        out = defaultdict(list)
        for window, size, group in zip(sequences, sizes, groups, strict=True):
            offset = 0
            for document, at, length in window:
                doc_id, ids, start, total = documents[document]
                piece = np.frombuffer(ids, dtype=f"<u{width}", count=length, offset=at * width)
                row = (doc_id, start + at, length, zlib.crc32(piece.astype("<u4").tobytes()), total, self._next, offset, size, _tier(size, self._tiers), self._group + group)
                for name, value in zip(_NAMES, row, strict=True):
                    out[name].append(value)
                offset += length
            self._next += 1
            if len(out["doc_id"]) >= 8192:
                yield _pieces(out)
                out = defaultdict(list)
        if out:
            yield _pieces(out)
        self._group += max(groups, default=-1) + 1
        # A piece that waits becomes a document of the next block that begins where the piece does.
        self._documents = [
            (documents[d][0], documents[d][1][at * width : (at + n) * width], documents[d][2] + at, documents[d][3]) for d, at, n in left
        ]
        self.tokens = sum(n for _, _, n in left)


_NAMES = [field.split()[0] for field in PIECES.split(", ")]
_KINDS = [pa.int32() if field.endswith(" int") else pa.int64() for field in PIECES.split(", ")]


def _pieces(columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[n], k) for n, k in zip(_NAMES, _KINDS, strict=True)], names=_NAMES)

"""Token files: independent zstandard frames, a trailing seek table and per-frame checksums.

One file holds consecutive documents in ascending id order::

    frame, frame, ...        zstandard frames; each one decompresses without the others
    skippable frame          document index: per frame its first and last document id and number of documents
    skippable frame          seek table: per frame its compressed size, plain size and checksum, then a footer

The seek table is that of the public zstandard seekable format, so other tools can read the frames. A frame's plain content
is: number of documents, their ids, their numbers of token ids, the token ids (little-endian; two or four bytes each).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, shared_path, stored, text_or_empty
from .tokens import encoder, in_slices

# Fixed values of the seekable format: skippable frame magic, seek table footer magic, checksum flag.
SKIPPABLE, SEEKABLE, WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
#: The document index is a skippable frame of the neighbouring number.
INDEX = 0x184D2A5D
FRAME_BYTES = 1 << 20
LEVEL = 3
_EMPTY_ID = -(1 << 63)  # stands for a NULL document id


def open_store(path: str):
    """(file system, path on it) of a URL or local path; any store that pyarrow knows."""
    from pyarrow import fs

    if urlparse(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(path).path
    return fs.FileSystem.from_uri(path)


class FrameWriter:
    """Writes one token file; documents come in order."""

    def __init__(self, stream, dtype: str, frame_bytes: int = FRAME_BYTES, level: int = LEVEL) -> None:
        import zstandard

        self._stream, self._dtype, self._limit = stream, dtype, frame_bytes
        self._compressor = zstandard.ZstdCompressor(level=level)
        self._ids, self._parts, self._size, self._table, self._index = [], [], 0, [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._ids.append(_EMPTY_ID if doc_id is None else doc_id)
        self._parts.append(ids)
        self._size += len(ids)
        if self._size >= self._limit:
            self._flush()

    def _flush(self) -> None:
        import xxhash

        if not self._ids:
            return
        width = np.dtype(self._dtype).itemsize
        lengths = np.array([len(p) // width for p in self._parts], dtype="<i8")
        plain = b"".join([struct.pack("<IB", len(self._ids), width), np.array(self._ids, dtype="<i8").tobytes(), lengths.tobytes(), *self._parts])
        packed = self._compressor.compress(plain)
        self._stream.write(packed)
        self._table.append(struct.pack("<III", len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self._index.append(struct.pack("<qqI", self._ids[0], self._ids[-1], len(self._ids)))
        self._ids, self._parts, self._size = [], [], 0

    def close(self) -> int:
        """Write index and seek table; returns the number of frames."""
        self._flush()
        index = b"".join(self._index)
        self._stream.write(struct.pack("<II", INDEX, len(index)) + index)
        table = b"".join(self._table) + struct.pack("<IBI", len(self._table), WITH_CHECKSUMS, SEEKABLE)
        self._stream.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        return len(self._table)


class FrameReader:
    """Random access to one token file: reads the two tables at the end, then only the frames asked for."""

    def __init__(self, file) -> None:
        self._file = file
        size = file.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or not flags & WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        begin = size - 9 - 12 * frames
        table = np.frombuffer(self._at(begin, 12 * frames), dtype="<u4").reshape(frames, 3).astype(np.int64)
        self.sizes, self.plain, self.checksums = table[:, 0], table[:, 1], table[:, 2]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        index = np.frombuffer(
            self._at(begin - 8 - 20 * frames, 20 * frames), dtype=np.dtype([("first", "<i8"), ("last", "<i8"), ("documents", "<u4")])
        )
        self.first, self.last, self.documents = index["first"], index["last"], index["documents"]

    def _at(self, begin: int, size: int) -> bytes:
        self._file.seek(begin)
        return self._file.read(size)

    def frame(self, number: int) -> Iterator[tuple[int | None, np.ndarray]]:
        """Documents of one frame, checked against its checksum."""
        import xxhash
        import zstandard

        packed = self._at(int(self.starts[number]), int(self.sizes[number]))
        plain = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self.plain[number]))
        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.checksums[number]:
            raise ValueError(f"checksum of frame {number} does not fit")
        count, width = struct.unpack_from("<IB", plain)
        ids = np.frombuffer(plain, dtype="<i8", count=count, offset=5)
        lengths = np.frombuffer(plain, dtype="<i8", count=count, offset=5 + 8 * count)
        tokens = np.frombuffer(plain, dtype=f"<u{width}", offset=5 + 16 * count)
        ends = np.cumsum(lengths)
        for doc_id, end, length in zip(ids.tolist(), ends.tolist(), lengths.tolist(), strict=True):
            yield (None if doc_id == _EMPTY_ID else doc_id), tokens[end - length : end]

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for number in range(len(self.sizes)):
            yield from self.frame(number)

    def chosen(self, wanted: Iterable[int | None]) -> Iterator[tuple[int | None, np.ndarray]]:
        """Every document with a wanted id, repeated and NULL ids too, in file order; decompresses only frames whose id range may hold one."""
        asked = set(wanted)
        wanted = sorted(_EMPTY_ID if i is None else i for i in asked)
        for number, (first, last) in enumerate(zip(self.first.tolist(), self.last.tolist(), strict=True)):
            at = np.searchsorted(wanted, first)
            if at < len(wanted) and wanted[at] <= last:
                yield from ((doc_id, ids) for doc_id, ids in self.frame(number) if doc_id in asked)

    def read(self, wanted: Iterable[int]) -> dict[int, np.ndarray]:
        """Token ids of the wanted documents by id; of a repeated id the last one (:meth:`chosen` has all)."""
        return dict(self.chosen(wanted))


MANIFEST = "path string, place int, first_id long, last_id long, documents long, tokens long, frames int"


def write_token_files(
    df: DataFrame, tokenizer: str, *, end_id: int | None = 0, folder: str | None = None, frame_bytes: int = FRAME_BYTES
) -> DataFrame:
    """Encode ``text`` and write token files; returns their manifest (one row per file, ``place`` in id order).

    Rows are range-partitioned by ``doc_id``, so files are in id order and each task writes one. A task writes under a name of its
    own attempt and only the names of attempts that succeeded enter the manifest, which is stored: a lost
    executor leaves at most a file that no manifest names. A NULL text is an empty document, a NULL id stands first, repeated ids stay
    side by side in the order of a hash of their texts (files may part them), an empty table gives an empty manifest. Only ``doc_id`` and ``text`` are read.
    """
    folder = folder or shared_path(df.sparkSession, "token-files")
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # Rows that repeat an id or have none are told apart by their text, so that they spread over files like others.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches):
        encode = encoder(tokenizer)
        width = np.dtype(encode.dtype).itemsize
        end = b"" if end_id is None else int(end_id).to_bytes(width, "little")
        context, stream, writer = TaskContext.get(), None, None
        ids_seen, documents, tokens = [None, None], 0, 0
        for batch in batches:
            for part in in_slices(batch):
                ids = part.column("doc_id").to_pylist()
                if not ids:
                    continue
                if writer is None:
                    store, base = open_store(folder)
                    store.create_dir(base, recursive=True)
                    path = f"{base}/part-{context.partitionId():06d}-{context.taskAttemptId()}.tokens"
                    stream = store.open_output_stream(path)
                    writer = FrameWriter(stream, encode.dtype, frame_bytes)
                    ids_seen[0] = ids[0]
                for doc_id, raw in zip(ids, encode.encode(part.column("text").to_pylist()), strict=True):
                    writer.add(doc_id, raw + end)
                    documents, tokens = documents + 1, tokens + (len(raw) + len(end)) // width
                ids_seen[1] = ids[-1]
        if writer is not None:
            frames = writer.close()
            stream.close()
            name = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}.tokens"
            row = [[name], [context.partitionId()], [ids_seen[0]], [ids_seen[1]], [documents], [tokens], [frames]]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds, strict=True)],
                names=["path", "place", "first_id", "last_id", "documents", "tokens", "frames"],
            )

    return stored(rows.transform(map_arrow, write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame, *, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents of the files: ``doc_id``, ``start`` (token ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    Each file is read by one task, frame by frame. ``doc_ids`` reads just these: files whose range cannot hold them
    are pruned, and of the others only the frames that may; ``start`` is then NULL. NULL asks for documents without an id, a
    repeated id gives all its documents, an id that no file has gives none. An empty manifest gives no rows.
    """
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    if doc_ids is not None:
        wanted = F.array(*[F.lit(_EMPTY_ID if i is None else i).cast("long") for i in doc_ids])
        files = files.where(F.exists(wanted, lambda i: (i >= F.coalesce("first_id", F.lit(_EMPTY_ID))) & (i <= F.coalesce("last_id", F.lit(_EMPTY_ID)))))
    files = files.select("path", "base", "place")
    # One partition per file, as far as hashing goes: the listing is small, the files are not.
    files = files.repartition(max(1, min(manifest.count(), 20_000)), "place")

    def read(batches):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                store, inner = open_store(path)
                with store.open_input_file(inner) as file:
                    reader = FrameReader(file)
                    chosen = reader if doc_ids is None else reader.chosen(doc_ids)
                    rows, start = [], base
                    for doc_id, ids in chosen:
                        crc = zlib.crc32(ids.astype("<u4").tobytes())
                        rows.append((doc_id, start if doc_ids is None else None, len(ids), crc))
                        start += len(ids)
                        if len(rows) >= 4096:
                            yield _batch(rows, kinds)
                            rows = []
                    if rows:
                        yield _batch(rows, kinds)

    return files.transform(map_arrow, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _batch(rows: list[tuple], kinds: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

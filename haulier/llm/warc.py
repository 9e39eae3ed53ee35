"""WARC archives without repeated payloads: records that repeat a payload become revisits of one response.

An archive is a file of WARC/1.1 records, each compressed on its own (gzip members in a row), so that a record can be read by its place. Only headers
are shuffled; payloads go from one archive to the next inside the task that reads them.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.storage import Storage
from .common import join_hot, map_arrow, shared_path, stored
from .token_files import open_store

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A file that has reached this size is closed, and the task goes on with a new one.
FILE_BYTES = 1 << 30
LEVEL = 6
_CHUNK = 1 << 20
_URI_SAFE = "".join(chr(c) for c in range(0x21, 0x7F))

#: What is known of a record without its payload. ``payload_check`` is the payload's SHA-256, so that SHA-1 alone never decides.
HEADERS = (
    "path string, offset long, size long, record_id string, record_type string, page_id long, uri string, date string, "
    "payload_bytes long, payload_digest string, payload_check string, refers_to_record string"
)
_NAMES = [field.split()[0] for field in HEADERS.split(", ")]
_KINDS = [pa.int64() if field.endswith(" long") else pa.string() for field in HEADERS.split(", ")]


class Record(NamedTuple):
    record_id: str
    record_type: str
    page_id: int | None
    uri: str | None
    date: str
    payload_bytes: int
    payload_digest: str
    payload_check: str
    refers_to_record: str | None = None
    refers_to_uri: str | None = None
    refers_to_date: str | None = None


def payload_digest(payload: bytes) -> str:
    """SHA-1 in base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digests(payload: bytes) -> tuple[str, str]:
    """(base32 SHA-1, hex SHA-256)."""
    return payload_digest(payload), hashlib.sha256(payload).hexdigest()


def member(record: Record, payload: bytes) -> bytes:
    """The record as one gzip member; a revisit has the response's head, but no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {record.payload_bytes}\r\n\r\n".encode()
    block = head if record.record_type == "revisit" else head + payload
    lines = [
        VERSION,
        f"WARC-Type: {record.record_type}",
        f"WARC-Record-ID: <{record.record_id}>",
        f"WARC-Date: {record.date}",
        *([f"WARC-Target-URI: {quote(record.uri, safe=_URI_SAFE)}"] if record.uri is not None else []),
        f"WARC-Payload-Digest: sha1:{record.payload_digest}",
        f"Payload-SHA256: {record.payload_check}",
        f"Payload-Length: {record.payload_bytes}",
        *([f"Page-ID: {record.page_id}"] if record.page_id is not None else []),
    ]
    if record.record_type == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
        lines.append(f"WARC-Refers-To: <{record.refers_to_record}>")
        if record.refers_to_uri is not None:
            lines.append(f"WARC-Refers-To-Target-URI: {quote(record.refers_to_uri, safe=_URI_SAFE)}")
        if record.refers_to_date is not None:
            lines.append(f"WARC-Refers-To-Date: {record.refers_to_date}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, payload) of a plain record. Payload digests of responses are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    block = rest[: int(headers["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record {headers.get('warc-record-id')} does not end where it says")
    payload = block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").startswith("application/http") else block
    given = headers.get("warc-payload-digest", "")
    if headers["warc-type"] != "revisit" and given.startswith("sha1:") and given != f"sha1:{payload_digest(payload)}":
        raise ValueError(f"payload of {headers.get('warc-record-id')} does not have its digest")
    return headers, payload


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(offset, size, plain bytes) of every gzip member of a file, read in chunks."""
    offset, held = 0, b""
    while True:
        unpacker, parts, used = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            held = held or stream.read(_CHUNK)
            if not held:
                if used:
                    raise ValueError("the file ends within a record")
                return
            parts.append(unpacker.decompress(held))
            used += len(held) - len(unpacker.unused_data)
            held = unpacker.unused_data
        yield offset, used, b"".join(parts)
        offset += used


class ArchiveWriter:
    """Files of one task attempt; ``rows`` collects the headers of what was written."""

    def __init__(self, folder: str, run: str, file_bytes: int) -> None:
        context = TaskContext.get()
        self._part, self._run, self._limit = context.partitionId(), run, file_bytes
        self._name = f"part-{self._part:06d}-{context.taskAttemptId()}"
        self._folder, self._stream, self._files, self._records, self._at = folder, None, 0, 0, 0
        self.rows: list[tuple] = []

    def record_id(self) -> str:
        """A new one, the same whenever the task runs over the same rows."""
        self._records += 1
        return uuid.uuid5(uuid.NAMESPACE_URL, f"{self._run}/{self._part}/{self._records}").urn

    def add(self, record: Record, payload: bytes = b"") -> None:
        if self._stream is None:
            store, base = open_store(self._folder)
            store.create_dir(base, recursive=True)
            name = f"{self._name}-{self._files}.warc.gz"
            self._stream, self._path, self._at = store.open_output_stream(f"{base}/{name}", compression=None), f"{self._folder}/{name}", 0
            self._files += 1
        data = member(record, payload)
        self._stream.write(data)
        self.rows.append((self._path, self._at, len(data), *record[:9]))
        self._at += len(data)
        if self._at >= self._limit:
            self.close()

    def batch(self) -> pa.RecordBatch:
        columns, self.rows = list(zip(*self.rows, strict=True)), []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names=_NAMES)

    def close(self) -> None:
        if self._stream is not None:
            self._stream.close()
            self._stream = None


def _now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def write_archives(df: DataFrame, *, folder: str | None = None, date: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """One response per row of ``page_id``, ``url``, ``html``, the payload in UTF-8; returns the headers of all records.

    Each task writes files of its own attempt, and only those of attempts that succeeded are in the stored headers. A NULL ``html``
    is an empty payload; a NULL ``page_id`` or ``url`` leaves its header out; repeated rows are records of their own; an
    empty table gives no file and no header. Other columns are not read.
    """
    folder, date, run = folder or shared_path(df.sparkSession, "warc"), date or _now(), uuid.uuid4().hex
    rows = df.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("html"))

    def write(batches):
        writer = ArchiveWriter(folder, run, file_bytes)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for page_id, url, payload in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                    writer.add(Record(writer.record_id(), "response", page_id, url, date, len(payload), *digests(payload)), payload)
                yield writer.batch()
        writer.close()

    return stored(rows.transform(map_arrow, write, HEADERS), "warc-headers")


def _per_file(headers: DataFrame) -> DataFrame:
    """The files named by headers, dealt out one by one; the list is small."""
    files = stored(headers.select("path").distinct(), "warc-files")
    return files.repartition(_tasks(files), "path")


def _tasks(files: DataFrame) -> int:
    return max(1, min(files.count(), 20_000))


def read_headers(headers: DataFrame) -> DataFrame:
    """Headers of all records in the archives named by the column ``path``, read from the files; payloads are checked on the way.

    Archives of other writers may lack some headers: sizes and digests of responses are then taken from the payload, those of revisits are
    NULL. No files give no rows.
    """

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, inner = open_store(path)
                rows: list[tuple] = []
                with store.open_input_stream(inner, compression=None) as stream:
                    for offset, size, data in members(stream):
                        headers, payload = parsed(data)
                        if headers["warc-type"] not in ("response", "resource", "revisit"):
                            continue
                        if headers["warc-type"] == "revisit":
                            digest, check, length = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None, headers.get("payload-sha256"), headers.get("payload-length")
                        else:
                            # A digest in the header has just been checked.
                            given = headers.get("warc-payload-digest", "")
                            digest = given.removeprefix("sha1:") if given.startswith("sha1:") else payload_digest(payload)
                            check, length = hashlib.sha256(payload).hexdigest(), len(payload)
                        rows.append(
                            (
                                path, offset, size, headers["warc-record-id"].strip("<>"), headers["warc-type"],
                                int(headers["page-id"]) if "page-id" in headers else None, headers.get("warc-target-uri"), headers.get("warc-date"),
                                None if length is None else int(length), digest, check, headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None,
                            )
                        )
                        if len(rows) >= 4096:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    return stored(_per_file(headers).transform(map_arrow, read, HEADERS), "warc-read")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=_NAMES)


def resolved(headers: DataFrame) -> DataFrame:
    """Revisits joined to their responses: all columns of ``headers`` and ``origin_*`` (path, offset, size, page_id, bytes, digest, check).

    A response is its own origin; a revisit whose response is in no archive has NULLs.
    """
    responses = headers.where("record_type <> 'revisit'")
    origin = responses.select(
        F.col("record_id").alias("refers_to_record"),
        *[F.col(c).alias(f"origin_{c}") for c in ("path", "offset", "size", "page_id", "payload_bytes", "payload_digest", "payload_check")],
    )
    own = responses.select(*_NAMES, *[F.col(c.removeprefix("origin_")).alias(c) for c in origin.columns[1:]])
    revisits = headers.where("record_type = 'revisit'").select(*_NAMES)
    return own.unionByName(join_hot(revisits, origin, "refers_to_record", "warc-origins"))


def write_deduplicated(headers: DataFrame, *, least_bytes: int = 0, folder: str | None = None, date: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """New archives in which each payload of at least ``least_bytes`` bytes is kept once; returns the headers of their records.

    Of the records with one payload that with the smallest ``page_id`` (NULL last, then by place) is written as its response, the others as
    revisits of it, all with new ids, dates and digests. Payloads are the same if SHA-1, SHA-256 and length are. A smaller payload stays a
    response everywhere. A revisit without its response is written again as it is. Headers are shuffled by payload digest with
    minima taken before the shuffle; digests that hold much of the input are joined apart. Payloads are read by place by the
    task that writes them.
    """
    folder, date, run = folder or shared_path(headers.sparkSession, "warc-dedup"), date or _now(), uuid.uuid4().hex
    rows = resolved(headers)
    known = rows.where("origin_path IS NOT NULL").withColumn("key", F.concat_ws(":", "origin_payload_digest", "origin_payload_check", F.col("origin_payload_bytes").cast("string")))
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "path", "offset")
    alone = F.col("origin_payload_bytes") < F.lit(least_bytes)
    firsts = known.where(~alone).groupBy("key").agg(F.min(F.struct(rank.alias("rank"), "record_id", "uri")).alias("f"))
    firsts = firsts.select("key", F.col("f.record_id").alias("first_record"), F.col("f.uri").alias("first_uri"))
    joined = join_hot(known, firsts, "key", "warc-firsts")
    first = alone | (F.col("record_id") == F.col("first_record"))
    todo = joined.select(
        # A response is written where its payload lies, a revisit anywhere.
        F.when(first, F.col("origin_path")).otherwise(F.col("path")).alias("path"),
        F.when(first, F.col("origin_offset")).otherwise(F.col("offset")).alias("offset"),
        F.when(first, F.col("origin_size")).otherwise(F.col("size")).alias("size"),
        "record_id", F.when(first, "response").otherwise("revisit").alias("record_type"), "page_id", "uri",
        F.col("origin_payload_bytes").alias("payload_bytes"), F.col("origin_payload_digest").alias("payload_digest"), F.col("origin_payload_check").alias("payload_check"),
        F.when(~first, F.col("first_record")).alias("refers_to_record"), F.when(~first, F.col("first_uri")).alias("refers_to_uri"),
    )
    lost = rows.where("origin_path IS NULL").select(*todo.columns[:-1], F.lit(None).cast("string").alias("refers_to_uri"))
    todo = todo.unionByName(lost)
    todo = todo.repartition(_tasks(headers.select("path").distinct()), "path").sortWithinPartitions("path", "offset", "record_id")

    def write(batches):
        writer = ArchiveWriter(folder, run, file_bytes)
        path, file = None, None
        for batch in batches:
            for row in batch.to_pylist():
                payload = b""
                if row["record_type"] == "response":
                    if row["path"] != path:
                        if file is not None:
                            file.close()
                        store, inner = open_store(row["path"])
                        path, file = row["path"], store.open_input_file(inner)
                    file.seek(row["offset"])
                    payload = parsed(zlib.decompress(file.read(row["size"]), 31))[1]
                # The new id follows from the old one, so revisits know that of their response.
                refers = row["refers_to_record"] and _renewed(run, row["refers_to_record"])
                record = Record(
                    _renewed(run, row["record_id"]), row["record_type"], row["page_id"], row["uri"], date, row["payload_bytes"] or 0,
                    row["payload_digest"] or "", row["payload_check"] or "", refers, row["refers_to_uri"], date if refers else None,
                )
                writer.add(record, payload)
                if len(writer.rows) >= 1024:
                    yield writer.batch()
        if file is not None:
            file.close()
        if writer.rows:
            yield writer.batch()
        writer.close()

    return stored(todo.transform(map_arrow, write, HEADERS), "warc-dedup-headers")


def _renewed(run: str, record_id: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{run}/{record_id}").urn


def payloads(headers: DataFrame) -> DataFrame:
    """(``page_id``, ``html``) of every record, revisits with the payload of their response, read by place from the archives."""
    rows = resolved(headers).where("origin_path IS NOT NULL").select("page_id", F.col("origin_path").alias("path"), F.col("origin_offset").alias("offset"), F.col("origin_size").alias("size"))
    # Dealt out by record, not by file: one payload may be asked for by many revisits.
    rows = rows.repartition("path", "offset", F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(64)))

    def read(batches):
        path, file = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for row in batch.slice(at, 256).to_pylist():
                    if row["path"] != path:
                        store, inner = open_store(row["path"])
                        path, file = row["path"], store.open_input_file(inner)
                    file.seek(row["offset"])
                    out.append((row["page_id"], parsed(zlib.decompress(file.read(row["size"]), 31))[1].decode("utf-8")))
                ids, texts = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["page_id", "html"])

    return rows.transform(map_arrow, read, "page_id long, html string")


def page_records(headers: DataFrame) -> DataFrame:
    """Per record: ``page_id``, ``payload_bytes``, ``payload_digest`` (of the full payload), ``record_type``, ``refers_to`` (the response's page of a revisit)."""
    return resolved(headers).select(
        "page_id",
        F.coalesce("origin_payload_bytes", "payload_bytes").alias("payload_bytes"),
        F.coalesce("origin_payload_digest", "payload_digest").alias("payload_digest"),
        "record_type",
        F.when(F.col("record_type") == "revisit", F.col("origin_page_id")).alias("refers_to"),
    )


def deduplicated_pages(df: DataFrame, *, least_bytes: int = 0) -> DataFrame:
    """Pages written as responses, read back, written again with revisits, and read back: see :func:`page_records`.

    NULL html counts as empty, NULL ids come last, repeated rows are revisits of the first; an empty table gives an empty result.
    """
    folder = shared_path(df.sparkSession, "warc-crawl")
    written = write_deduplicated(read_headers(write_archives(df, folder=folder)), least_bytes=least_bytes)
    Storage(df.sparkSession, folder).delete()  # all that is kept is in the new archives
    return page_records(read_headers(written))

"""WARC archives: writing, and normalising whole-file gzip streams to one member a record.

Archives and their indexes are files under a folder that every executor can
reach (a ``file``, ``hdfs`` or object-store URI). A file counts only once the
task that wrote it has finished: the manifest lists it then, so files of lost
or repeated tasks are never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import cut, shared_dir

#: Uncompressed bytes after which a new archive begins.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
GZIP = 31  # window bits that ask zlib for the gzip format
#: Shorter payloads are never stored as revisits.
REVISIT_BYTES = 1000
END = b"\r\n\r\n"

MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64())])
READ = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
     ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)


def place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if re.match(r"\w[\w+.-]+:", uri) else f"file://{uri}")


def record(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One record: an HTTP response with the payload, or a revisit with the response's head alone."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    body = http if revisit else http + payload
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url:
        head.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%~-._"))
    if revisit:
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: {digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + END + body + END


def headers(raw: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in raw.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def _write(batches: Iterable[pa.RecordBatch], folder: str, date: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Archives of (page_id, url, payload, refers_to) rows, each one gzip stream from end to end."""
    system, root = place(folder)
    system.create_dir(root, recursive=True)
    out = path = None
    records = size = 0

    def close():
        out.write(packer.flush())
        out.close()
        return pa.RecordBatch.from_pylist([{"path": f"{folder}/{path}", "records": records}], MANIFEST)

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if out is None:
                path, packer = f"{uuid.uuid4()}.warc.gz", zlib.compressobj(6, zlib.DEFLATED, GZIP)
                out, records, size = system.open_output_stream(f"{root}/{path}", compression=None), 0, 0
            page_id, url, html, refers_to = row
            data = record(page_id, url, (html or "").encode(), refers_to, date)
            out.write(packer.compress(data))
            records, size = records + 1, size + len(data)
            if size > limit:
                yield close()
                out = None
    if out is not None:
        yield close()


def inflate(file) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, in bounded chunks."""
    unpacker, rest = zlib.decompressobj(GZIP), b""
    while data := rest or file.read(CHUNK):
        yield unpacker.decompress(data, CHUNK)
        rest = unpacker.unconsumed_tail
        if unpacker.eof:
            rest, unpacker = unpacker.unused_data, zlib.decompressobj(GZIP)


class Parts:
    """Reads a stream of chunks by length or up to a mark."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.held = chunks, bytearray()

    def _more(self) -> bool:
        for chunk in self.chunks:
            if chunk:
                self.held += chunk
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """Up to and with ``mark``; empty at the end of the stream."""
        at = -1
        while (at := self.held.find(mark, max(0, at))) < 0:
            at = len(self.held) - len(mark) + 1
            if not self._more():
                if self.held.strip():
                    raise ValueError("the archive ends inside a record's head")
                return b""
        out = bytes(self.held[: at + len(mark)])
        del self.held[: at + len(mark)]
        return out

    def take(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.held and not self._more():
                raise ValueError("the archive ends inside a record")
            out = bytes(self.held[:size])
            del self.held[:size]
            size -= len(out)
            yield out


def _normalise(batches: Iterable[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Each archive inflated once; every record written as a member of its own, its place to a sidecar index."""
    system, root = place(folder)
    system.create_dir(root, recursive=True)
    for batch in batches:
        for source in batch.column(0).to_pylist():
            name, records, offset = f"{uuid.uuid4()}.warc.gz", 0, 0
            from_system, from_path = place(source)
            with (
                from_system.open_input_stream(from_path, compression=None) as raw,
                system.open_output_stream(f"{root}/{name}", compression=None) as out,
                system.open_output_stream(f"{root}/{name}.idx", compression=None) as index,
            ):
                parts = Parts(inflate(raw))
                while head := parts.until(END):
                    fields = headers(head)
                    packer, length = zlib.compressobj(6, zlib.DEFLATED, GZIP), 0
                    for data in chain([head.lstrip(b"\r\n")], _one(parts, int(fields["content-length"]))):
                        packed = packer.compress(data)
                        out.write(packed)
                        length += len(packed)
                    packed = packer.flush()
                    out.write(packed)
                    length += len(packed)
                    entry = {"offset": offset, "length": length, "type": fields["warc-type"], "id": fields["warc-record-id"], "digest": fields.get("warc-payload-digest")}
                    index.write(json.dumps(entry).encode() + b"\n")
                    offset, records = offset + length, records + 1
            yield pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "records": records}], MANIFEST)


def _one(parts: Parts, size: int) -> Iterator[bytes]:
    yield from parts.take(size)
    yield b"".join(parts.take(len(END)))


def _entries(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, Callable[[int, int], bytes], dict]]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, name = place(path)
            with system.open_input_file(name) as file, system.open_input_stream(f"{name}.idx", compression=None) as index:
                tail = b""
                while chunk := index.read(CHUNK):
                    *lines, tail = (tail + chunk).split(b"\n")
                    for line in lines:
                        yield path, lambda offset, length: file.read_at(length, offset), json.loads(line)


def _page(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every record by its index entry, with the payload's size and digest taken again where it is there."""
    rows, size = [], 0
    for path, at, entry in _entries(batches):
        head, _, body = gzip.decompress(at(entry["offset"], entry["length"])).partition(END)
        fields = headers(head)
        http, _, payload = body[: int(fields["content-length"])].partition(END)
        told = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
        length = int(headers(http)["content-length"])
        if fields["warc-type"] == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != told):
            raise ValueError(f"{path}: the record at {entry['offset']} is damaged")
        rows.append((_page(fields["warc-record-id"]), length, told, fields["warc-type"], _page(fields.get("warc-refers-to")), path, entry["offset"], entry["length"]))
        if len(rows) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), READ)], schema=READ)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), READ)], schema=READ)


def _spread(manifest: DataFrame) -> DataFrame:
    """A task for a few files each; the rows are too small for Spark to see the work in them."""
    spark = manifest.sparkSession
    return manifest.select("path").repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path")


def write_archives(df: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of rows (page_id, url, html, refers_to), each file one gzip stream; returns the manifest (path, records)."""
    rows = df.select("page_id", "url", "html", "refers_to")
    return cut(rows.mapInArrow(partial(_write, folder=folder, date=date, limit=limit), "path string, records long"))


def normalise(manifest: DataFrame, folder: str) -> DataFrame:
    """Rewrites the listed archives with one gzip member a record and a sidecar ``.idx`` of JSON lines; returns their manifest."""
    return cut(_spread(manifest).mapInArrow(partial(_normalise, folder=folder), "path string, records long"))


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of normalised archives, read through their indexes."""
    return _spread(manifest).mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, path string, offset long, length long"
    )


def revisits(df: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, refers_to): refers_to is the largest id with the same payload, unless that is the row's own.

    Payloads are compared by size and SHA-256, so a hot payload moves as digests only.
    """
    size, digest = F.octet_length(F.coalesce("html", F.lit(""))), F.sha2(F.coalesce("html", F.lit("")), 256)
    last = df.where(size >= least).groupBy(digest.alias("of"), size.alias("bytes")).agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1")
    joined = df.join(last, (digest == F.col("of")) & (size == F.col("bytes")), "left")
    return joined.select("page_id", "url", "html", F.when(~F.col("last").eqNullSafe(F.col("page_id")), F.col("last")).alias("refers_to"))


def archive(df: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None, least: int = REVISIT_BYTES) -> DataFrame:
    """One row (page_id, payload_bytes, payload_digest, record_type, refers_to, path, offset, length) per row of ``df``, read back from archives.

    A record's payload is the html in UTF-8, empty for null. Of records with equal payloads of at least ``least`` bytes,
    the one with the largest id is the response and the others revisit it; rows that share that id are all
    responses, and a null id never is one where others are. Smaller payloads are always responses. Payload digests are SHA-1 of the full payload, hex.
    Ids are integers; other columns are not read; an empty table gives an empty one. ``folder`` is where archives and
    indexes go, by default the session's shared folder. A task holds an Arrow batch of pages and one record, which may be very long.
    """
    folder = folder or f"{shared_dir(df.sparkSession)}/warc/{uuid.uuid4()}"
    pages = df.select(F.col(f"`{id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{html}`").cast("string").alias("html"))
    raw = write_archives(revisits(pages, least), f"{folder}/raw")
    return read_archives(normalise(raw, f"{folder}/members"))

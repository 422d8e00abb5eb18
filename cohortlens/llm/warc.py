"""WARC archives: a writer, and a sequential reader that verifies.

Writer: every page is one record in one gzip member. Of records with equal
payloads of at least ``min_bytes`` bytes the one with the smallest page id is
a response and the others are revisits that refer to it. Each task writes
files of its own under a fresh name; the manifest, itself a written table,
names exactly one file set per partition, so a task that runs again after a
lost executor leaves no doubled record.

Reader: a task streams an archive member by member with incremental zlib
decompression, takes the header, frames the block by its Content-Length,
hashes it on the way and compares the block digest (and for responses the
payload digest). Memory is bounded by the read size, whatever the payload.

Defined results: a null payload is empty. A null url has no target header, a
null page id is written as ``null`` and read back as null; as a copy it is a
revisit. Repeated rows of the smallest id are all responses. A damaged record
is returned with its ``problem`` and the reading goes on with the next member
where the compressed stream allows it. An empty table gives no archives.
Archive folders are URIs that ``pyarrow.fs`` opens (file, hdfs, s3, gs).
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import attach
from cohortlens.session import materialize, scratch_root

MIN_BYTES = 100                 # smaller payloads are never revisits
ARCHIVE_BYTES = 128 << 20       # a task starts another file beyond this size
READ_BYTES = 1 << 18
LEVEL = 5
DATE = "2024-01-01T00:00:00Z"

# fixed values of the format
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder URI (s3a is s3; a plain path is local)."""
    uri = re.sub(r"^s3[an]:", "s3:", uri)
    if re.match(r"^[a-z0-9]+:", uri):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))
    return pafs.LocalFileSystem(), uri


# --- writing ---------------------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           date: str = DATE) -> bytes:
    """One uncompressed record."""
    def urn(i):
        return f"<urn:page:{'null' if i is None else i}>"

    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [VERSION.decode(), f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page_id)}",
            f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if revisit:
        head += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
             "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    """One gzip member."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = open_folder(folder)
        out, path, size, count, done = None, None, 0, 0, []

        def close():
            if out is not None:
                out.close()
                done.append({"path": path, "records": count, "bytes": size})

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for values in zip(*columns):
                if out is None or size >= archive_bytes:
                    close()
                    path, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{top}/{path}", compression=None)
                data = member(record(*(v.as_py() for v in values)))
                out.write(data)
                size, count = size + len(data), count + 1
        close()
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema(
            [("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = MIN_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages below ``folder``; returns the manifest (path, records, bytes)."""
    fs, top = open_folder(folder)
    fs.create_dir(top, recursive=True)
    payload = F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.octet_length("payload") >= min_bytes)
    copies = materialize(
        large.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND first_id IS NOT NULL").select("digest", "first_id"), "warc-copies")
    marked = attach(rows, copies, "digest", copies.count())
    revisit = (F.octet_length("payload") >= min_bytes) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(
        F.col("first_id"))
    marked = marked.withColumn("refers_to", F.when(revisit, F.col("first_id")))
    written = marked.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(
        _writer(folder, archive_bytes), "path string, records long, bytes long")
    return materialize(written, "warc-manifest")


# --- reading ------------------------------------------------------------------------------

class _Record:
    """Takes the bytes of one member in any portions and frames the record."""

    def __init__(self):
        self.head, self.headers, self.left = b"", None, 0
        self.tail, self.http, self.payload_bytes = b"", b"", 0
        self.block, self.payload = hashlib.sha256(), hashlib.sha256()
        self.http_done = False

    def feed(self, data: bytes) -> None:
        if self.headers is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if end < 0:
                if len(self.head) > 1 << 20:
                    raise ValueError("no end of the record header")
                return
            lines = self.head[:end].split(b"\r\n")
            if lines[0] != VERSION:
                raise ValueError("not a record")
            self.headers = {k.strip().lower(): v.strip() for k, _, v in
                            (x.decode("utf-8", "replace").partition(":") for x in lines[1:])}
            self.left = int(self.headers["content-length"])
            data, self.head = self.head[end + 4:], b""
        body, rest = data[:self.left], data[self.left:]
        self.left -= len(body)
        self.block.update(body)
        if not self.http_done:
            self.http += body
            end = self.http.find(b"\r\n\r\n")
            if end < 0:
                if len(self.http) > 1 << 20:
                    raise ValueError("no end of the message header")
                body = b""
            else:
                body, self.http, self.http_done = self.http[end + 4:], self.http[:end], True
        self.payload.update(body)
        self.payload_bytes += len(body)
        self.tail += rest
        if len(self.tail) > 4:
            raise ValueError("data after the block")

    def finish(self) -> dict:
        """The record's row; digests and framing are verified."""
        if self.headers is None or self.left or self.tail != b"\r\n\r\n":
            raise ValueError("the record is cut off")
        h = self.headers
        if h.get("warc-block-digest") != "sha256:" + self.block.hexdigest():
            raise ValueError("block digest differs")
        digest = h.get("warc-payload-digest", "").removeprefix("sha256:")
        kind, size = h.get("warc-type"), self.payload_bytes
        if kind == "response":
            if digest != self.payload.hexdigest():
                raise ValueError("payload digest differs")
        else:
            sizes = re.findall(rb"(?im)^Content-Length:\s*(\d+)", self.http)
            size = int(sizes[0]) if sizes else None
        return {"page_id": _urn(h.get("warc-record-id")), "url": h.get("warc-target-uri"), "payload_bytes": size,
                "payload_digest": digest, "record_type": kind, "refers_to": _urn(h.get("warc-refers-to")),
                "problem": None}


def _urn(value: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(m[1]) if m else None


def read_members(stream, read_bytes: int = READ_BYTES) -> Iterator[dict]:
    """Rows of the records of one open archive, in order."""
    data = stream.read(read_bytes)
    while data:
        z, rec, problem = zlib.decompressobj(31), _Record(), None
        while not z.eof:
            if not data and not (data := stream.read(read_bytes)):
                problem = problem or "the archive is cut off"
                break
            try:
                out = z.decompress(data, read_bytes)
            except zlib.error as exc:
                yield {"problem": f"not a gzip member: {exc}"}
                return
            data = z.unused_data if z.eof else z.unconsumed_tail
            if problem is None:
                try:
                    rec.feed(out)
                except (ValueError, KeyError) as exc:
                    problem = str(exc)
        if problem is None:
            try:
                yield rec.finish()
            except ValueError as exc:
                problem = str(exc)
        if problem is not None:
            yield {"page_id": _urn((rec.headers or {}).get("warc-record-id")), "problem": problem}
        data = data or stream.read(read_bytes)


_ROWS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                   ("problem", pa.string())])


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the manifest's archives, read sequentially and verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = open_folder(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with fs.open_input_stream(f"{top}/{path}", compression=None) as stream:
                    for row in read_members(stream):
                        rows.append(row)
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)

    files = max(1, manifest.count())
    return manifest.select("path").repartition(files).mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
             "refers_to long, problem string")


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives below the scratch folder of this application."""
    return f"{scratch_root(spark)}/warc-{uuid.uuid4().hex}"

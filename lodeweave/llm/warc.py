"""WARC files: a writer of one gzip member per record, and a sequential reader.

The reader decompresses incrementally, takes a record's block by its Content-Length, and compares the block's and
the payload's SHA-1 with the digests in the header. A damaged record gives a row that says what is wrong, and
reading goes on at the next gzip member. Memory is bounded by one record. Files are read and written through
Arrow's file systems, so any shared storage that these know will do; a file is read by one task from its start, and
the files are spread over the tasks.

The writer's tasks name their files themselves, with a random part, and report them; only files that are reported
by successful tasks are in the list that ``write_warc`` returns, so a task that runs twice does no harm.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeweave.llm.common import scratch, written

#: Compressed bytes after which the writer begins another file.
ROLL_BYTES = 1 << 30
DATE = "2024-01-01T00:00:00Z"
_READ = 1 << 18
_END = b"\r\n\r\n"
_GZIP = b"\x1f\x8b\x08"
_ROWS = 512
#: Bytes of blocks in a batch of rows.
_BATCH = 16 << 20
_COLUMNS = "file string, offset bigint, page_id bigint, url string, html string, n_bytes bigint, digest_ok boolean, error string"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, html: str | None) -> bytes:
    """A response record as one gzip member. Its Page-Fields header has the exact page_id and url, and whether html is null."""
    payload = b"" if html is None else html.encode("utf-8", "surrogatepass")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    safe = "".join(c if " " < c < "\x7f" or c > "\xa0" else f"%{ord(c):02X}" for c in url or "")
    head = [
        "WARC/1.1",
        "WARC-Type: response",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([page_id, url]))}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {safe}",
        f"WARC-Block-Digest: {digest(block)}",
        f"WARC-Payload-Digest: {digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        "Page-Fields: " + json.dumps([page_id, url, html is None]),
    ]
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress("\r\n".join(head).encode() + _END + block + _END) + c.flush()


def _written(folder: str, roll: int):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        out, name, size, n = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        try:
            for batch in batches:
                for page_id, url, html in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    if out is None:
                        name, size, n = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = system.open_output_stream(f"{path}/{name}", compression=None)
                    data = record(page_id, url, html)
                    out.write(data)
                    size, n = size + len(data), n + 1
                    if size >= roll:
                        out.close()
                        done.append((name, n, size))
                        out = None
        finally:
            if out is not None:
                out.close()
        if out is not None:
            done.append((name, n, size))
        yield pa.record_batch([pa.array([f"{folder}/{x[0]}" for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.int64())], names=["file", "records", "bytes"])

    return f


def write_warc(pages: DataFrame, folder: str, roll: int = ROLL_BYTES) -> DataFrame:
    """Write (page_id, url, html) to files in ``folder``, a URI on shared storage; gives (file, records, bytes).

    Nulls and any characters in url and html survive; a repeated row is a record of its own; an empty table writes
    no file. Extra columns are left out.
    """
    made = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(_written(folder, roll), "file string, records bigint, bytes bigint")
    return written(made, "warc-list")


class _Source:
    """A stream's bytes, with a place to look ahead from."""

    def __init__(self, stream: BinaryIO) -> None:
        self.stream, self.held, self.at = stream, bytearray(), 0

    def more(self) -> bool:
        data = self.stream.read(_READ)
        self.held += data
        return bool(data)

    def drop(self, n: int) -> None:
        del self.held[:n]
        self.at += n


def members(stream: BinaryIO) -> Iterator[tuple[int, bytes, str | None]]:
    """(offset, data, error) of each gzip member; after damage, from the next place that looks like one."""
    src = _Source(stream)
    while src.held or src.more():
        while len(src.held) < 3 and src.more():
            pass
        start = src.at
        if not src.held.startswith(_GZIP):
            yield start, b"", "not a gzip member"
        else:
            d, out = zlib.decompressobj(31), []
            try:
                fed = 0
                while not d.eof:
                    if fed == len(src.held) and not src.more():
                        raise zlib.error("ends within a member")
                    out.append(d.decompress(src.held[fed:]))
                    fed = len(src.held)
                src.drop(fed - len(d.unused_data))
                yield start, b"".join(out), None
                continue
            except zlib.error as e:
                yield start, b"", str(e)[:100]
        src.drop(1)
        while (found := src.held.find(_GZIP)) < 0:
            src.drop(max(0, len(src.held) - 2))
            if not src.more():
                return
        src.drop(found)


def parsed(data: bytes) -> tuple[dict[str, str], bytes, str | None]:
    """Header fields by lower-case name, block and what is wrong with a record."""
    head, end, rest = data.partition(_END)
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not end or not lines[0].startswith("WARC/"):
        return {}, b"", "no WARC header"
    fields: dict[str, str] = {}
    last = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            fields[last] = value.strip()
    try:
        size = int(fields["content-length"])
    except (KeyError, ValueError):
        return fields, b"", "no Content-Length"
    if size < 0 or len(rest) < size:
        return fields, rest, "block is shorter than Content-Length"
    if rest[size:] != _END:
        return fields, rest[:size], "no record end after Content-Length bytes"
    return fields, rest[:size], None


def _matches(stated: str | None, data: bytes) -> bool | None:
    """Whether a labelled digest is right; None where there is none that we can compute."""
    name, _, value = (stated or "").partition(":")
    if name.lower() not in ("sha1", "sha256", "md5"):
        return None
    made = hashlib.new(name.lower(), data)
    return value.upper().rstrip("=") == base64.b32encode(made.digest()).decode().rstrip("=") or value.lower() == made.hexdigest()


def pages_of(stream: BinaryIO) -> Iterator[tuple]:
    """(offset, page_id, url, html, n_bytes, digest_ok, error) of each response, resource or damaged record."""
    for offset, data, error in members(stream):
        if error:
            yield offset, None, None, None, None, None, error
            continue
        fields, block, error = parsed(data)
        kind = fields.get("warc-type", "")
        if error is None and kind not in ("response", "resource"):
            continue
        payload = block
        if kind == "response" and block.startswith(b"HTTP/"):
            payload = block.partition(_END)[2]
        checks = [_matches(fields.get("warc-block-digest"), block), _matches(fields.get("warc-payload-digest"), payload)]
        known = [x for x in checks if x is not None]
        page_id, url, missing = None, fields.get("warc-target-uri"), False
        if "page-fields" in fields:
            try:
                page_id, url, missing = json.loads(fields["page-fields"])
            except ValueError:
                error = error or "Page-Fields can't be read"
        html = None if missing or error else payload.decode("utf-8", "replace")
        yield offset, page_id, url, html, None if missing or error else len(payload), all(known) if known else None, error


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.string()]
    names = ["file", "offset", "page_id", "url", "html", "n_bytes", "digest_ok", "error"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for files in batches:
        for name in files.column(0).to_pylist():
            system, path = fs.FileSystem.from_uri(name)
            with system.open_input_stream(path, compression=None) as stream:
                rows: list[tuple] = []
                size = 0
                for row in pages_of(stream):
                    rows.append((name, *row))
                    size += row[4] or 0
                    if len(rows) >= _ROWS or size >= _BATCH:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)


def read_warc(files: DataFrame, tasks: int) -> DataFrame:
    """The pages of WARC files, given as URIs in ``file``, by up to ``tasks`` tasks.

    (file, offset, page_id, url, html, n_bytes, digest_ok, error): digest_ok is null where a record states no
    digest; a damaged record has an error, its offset, and nulls for html and n_bytes. Null files are left out;
    a file that is listed twice is read twice. No files give no rows.
    """
    return files.where("file is not null").select("file").repartition(max(1, tasks)).mapInArrow(_read, _COLUMNS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages to WARC files in the shared folder and read them back."""
    made = write_warc(pages, scratch(pages.sparkSession, "warc"))
    return read_warc(made, made.count())

"""WARC output with payload deduplication, and a splittable WARC reader.

Writing: every record is a gzip member of its own, so an archive is a plain concatenation. Reading:
a task scans its byte range for the gzip magic, accepts a candidate only if it inflates to a WARC
header block with the fields that every record has, and owns the records that start inside the range; the last one may be read
past the range's end. No index and no whole-file task is needed.

Archives are written by tasks under names of their own; the manifest, a written table, lists those
of successful tasks only, so files of lost or repeated tasks are never read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragstone.llm.common import filesystem, fresh_path, lookup_join, slices, written

#: Records with equal payloads are deduplicated from this payload size on.
LEAST_BYTES = 1000
#: An archive is closed beyond this size.
ARCHIVE_BYTES = 256 << 20
#: Bytes that a reading task scans.
RANGE_BYTES = 8 << 20
_READ = 1 << 20
_FEED = 1 << 13
#: Bytes within which a record's header block ends.
_MOST_HEAD = 1 << 16
_PAGE = re.compile(r"<urn:page:(-?[0-9]+)>")
MAGIC = b"\x1f\x8b\x08"
#: Fixed value: the revisit profile that the WARC 1.1 standard names.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, bytes long, records long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def with_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, refers_to (null for responses).

    Among rows with equal payloads of at least ``least_bytes`` bytes the largest page_id is the
    response and the others refer to it; rows that share that page_id are all responses. A null
    page_id never is a response to others and stays one itself. Null html: an empty payload.
    Equality is by SHA-256 and length; the SHA-1 is only reported.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumns(
        {"payload_bytes": F.octet_length("html").cast("long"), "payload_key": F.sha2("html", 256)}
    )
    keys = rows.filter(F.col("payload_bytes") >= least_bytes).select("payload_key", "page_id")
    copies = keys.groupBy("payload_key").agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    rows = lookup_join(rows, written(copies, "warc-copies"), ["payload_key"], salt=F.xxhash64("page_id"))
    refers = F.when((F.col("payload_bytes") >= least_bytes) & (F.col("page_id") != F.col("response_id")), F.col("response_id"))
    return rows.select("page_id", "url", "html", "payload_bytes", F.sha1("html").alias("payload_digest"), refers.alias("refers_to"))


def record(page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None) -> bytes:
    """One gzip member holding a WARC 1.1 response or revisit record."""
    payload = html.encode() if refers_to is None else b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"X-Payload-Length: {len(html.encode())}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(http) + len(payload)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n") + packer.flush()


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        out, path, size, n = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{path}"], "bytes": [size], "records": [n]})

        for batch in batches:
            for part in slices(batch):
                for row in part.to_pylist():
                    if out is None:
                        fs.create_dir(root, recursive=True)
                        path, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = fs.open_output_stream(f"{root}/{path}", compression=None)
                    member = record(row["page_id"], row["url"], row["html"], row["payload_digest"], row["refers_to"])
                    out.write(member)
                    size, n = size + len(member), n + 1
                    if size >= ARCHIVE_BYTES:
                        yield closed()
                        out = None
        if out is not None:
            yield closed()

    return write


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives under ``folder``; returns their manifest (path, bytes, records)."""
    folder = folder or fresh_path(pages.sparkSession, "warc")
    rows = with_revisits(pages, least_bytes).drop("payload_bytes")
    return written(rows.mapInArrow(_writer(folder), MANIFEST), "warc-manifest")


class _Window:
    """A file read forward; the bytes from ``base`` on are held, and let go only when more are read."""

    def __init__(self, file, at: int):
        self.file, self.base, self.data, self.free = file, at, b"", at
        file.seek(at)

    @property
    def end(self) -> int:
        return self.base + len(self.data)

    def more(self) -> bool:
        got = self.file.read(_READ)
        self.data, self.base = self.data[self.free - self.base :] + got, self.free
        return bool(got)


def _fields(head: bytes) -> dict[str, str]:
    """The named fields of a WARC header block, names in lower case; empty if it is none."""
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        return {}
    pairs = [line.partition(":") for line in lines if line]
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _is_record(window: _Window, at: int) -> bool:
    """Whether the gzip magic at ``at`` starts a member with a WARC header: a version line, and the fields that every record has."""
    unpacker, head, fed = zlib.decompressobj(31), b"", at
    while b"\r\n\r\n" not in head and len(head) < _MOST_HEAD and not unpacker.eof:
        if fed >= window.end and not window.more():
            break
        piece = window.data[fed - window.base : fed - window.base + 512]
        fed += len(piece)
        try:
            head += unpacker.decompress(piece)
        except zlib.error:
            return False
        if not b"WARC/".startswith(head[:5]):
            return False
    block, end, _ = head.partition(b"\r\n\r\n")
    fields = _fields(block) if end else {}
    return fields.get("content-length", "").isdecimal() and all(fields.get(x) for x in ("warc-type", "warc-record-id"))


def members(file, start: int, end: int) -> Iterator[bytes]:
    """The inflated members that start in bytes [start, end) of ``file``."""
    window, at = _Window(file, start), start
    while at < end:
        window.free = at
        found = window.data.find(MAGIC, at - window.base)
        if found < 0:
            at = window.free = max(at, window.end - len(MAGIC) + 1)
            if not window.more():
                return
            continue
        at = window.free = window.base + found
        if at >= end:
            return
        if not _is_record(window, at):
            at += 1
            continue
        unpacker, chunks, fed = zlib.decompressobj(31), [], at
        while not unpacker.eof:
            window.free = fed
            if fed == window.end and not window.more():
                raise EOFError(f"a record that starts at byte {at} is cut off")
            piece = window.data[fed - window.base : fed - window.base + _FEED]
            chunks.append(unpacker.decompress(piece))
            fed += len(piece) - len(unpacker.unused_data)
        at = fed
        yield b"".join(chunks)


def parsed(member: bytes) -> dict:
    """A member as a row of RECORDS; archives by other writers are read as well.

    payload_bytes and the digest are those of the full payload where the record tells them; else they
    are taken from the record's own body. page_id and refers_to are null where they are no page's.
    The payload of http responses starts behind their own header; revisits have none.
    """
    head, _, body = member.partition(b"\r\n\r\n")
    fields = _fields(head)
    body, kind = body[: int(fields["content-length"])], fields["warc-type"]
    number = lambda name: int(x.group(1)) if (x := _PAGE.fullmatch(fields.get(name, ""))) else None
    payload = body.partition(b"\r\n\r\n")[2] if "application/http" in fields.get("content-type", "") else body
    length, digest = fields.get("x-payload-length", ""), fields.get("warc-payload-digest", "")
    return {
        "page_id": number("warc-record-id"),
        "payload_bytes": int(length) if length.isdecimal() else len(payload),
        "payload_digest": digest.removeprefix("sha1:") if digest else hashlib.sha1(payload).hexdigest(),
        "record_type": kind,
        "refers_to": number("warc-refers-to"),
        "payload": None if kind == "revisit" else payload,
    }


def _reader(schema: pa.Schema):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span in batch.to_pylist():
                fs, path = filesystem(span["path"])
                rows, held = [], 0
                with fs.open_input_file(path) as file:
                    for member in members(file, span["start"], span["end"]):
                        rows.append(parsed(member))
                        held += len(member)
                        if held > 8 << 20 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return read


def read_archives(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of the archives in ``manifest``, read by byte ranges dealt to tasks of their own."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    spans = manifest.select("path", starts.alias("start")).withColumn("end", F.col("start") + F.lit(range_bytes).cast("long"))
    # Numbered, or adaptive execution would join the few small rows in one task.
    spans = written(spans, "warc-spans")
    return spans.repartitionByRange(max(1, spans.count()), "path", "start").mapInArrow(_reader(schema), RECORDS)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    The length and digest of a response are taken from its payload as read. Empty table: empty result;
    further columns of ``pages`` are not read.
    """
    rows = read_archives(write_archives(pages))
    own = lambda name, of: F.when(F.col("record_type") == "response", of).otherwise(F.col(name)).alias(name)
    return rows.select("page_id", own("payload_bytes", F.octet_length("payload").cast("long")), own("payload_digest", F.sha1("payload")), "record_type", "refers_to")

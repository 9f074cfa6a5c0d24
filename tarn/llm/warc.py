"""WARC archives: a writer with payload deduplication and a reader that splits gzip files by byte ranges."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, key_mark, record, salt_of, salted

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
#: Bytes of an archive that one task scans; bytes read at a time.
SPLIT, BLOCK = 8 << 20, 1 << 18


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---------------------------------------------------------------------------------------- write


def member(page, url: str | None, payload: bytes | None, size: int, sha1: str, refers) -> bytes:
    """One record as its own gzip member: a response with its payload, or a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{sha1}"]
    if url:
        head.append("WARC-Target-URI: " + "".join(url.split()))
    if refers is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def write_warc(pages: DataFrame, scratch: Scratch, least: int = 0) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html); returns the archives (file, size).

    Of rows with equal payloads of at least ``least`` bytes the one with the smallest page_id is a
    response and the others revisit it.  A null html is an empty payload; a null page_id is written as an
    empty id and never deduplicates; repeated rows with one id are all responses.  An empty table gives
    no archive.  Tasks write under names of their own and only those that a finished task reports count,
    so a repeated or lost task leaves no wrong record.
    """
    body = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", "html", F.sha1(body.cast("binary")).alias("_sha1"), F.octet_length(body).cast("long").alias("_size"))
    copies = rows.where((F.col("_size") >= least) & F.col("page_id").isNotNull()).groupBy("_sha1", "_size").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    copies = scratch.save(copies, "copies")
    # a payload that no other page has goes straight to its archive; copies of one are spread over salts
    marked = key_mark(rows, F.col("_sha1"), copies, F.col("_sha1"))
    some = marked.where("_tarn_may").withColumn("_salt", salt_of(F.coalesce("page_id", F.length("url")))).join(salted(copies).hint("merge"), ["_sha1", "_size", "_salt"], "left")
    columns = ["page_id", "url", body.alias("html"), "_sha1", "_size"]
    refers = F.when(F.col("page_id") > F.col("_first"), F.col("_first"))
    some = some.withColumn("_refers", refers).select("page_id", "url", F.when(F.col("_refers").isNull(), body).alias("html"), "_sha1", "_size", "_refers")
    marked = marked.where("not _tarn_may").select(*columns, F.lit(None).cast("long").alias("_refers")).union(some)
    root = scratch.path("warc")
    schema = pa.schema([("file", pa.string()), ("size", pa.int64()), ("records", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, size, n = f"{root}/{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page, url, html, sha1, length, refers = row
                if out is None:
                    fs, path = pafs.FileSystem.from_uri(root)
                    fs.create_dir(path, recursive=True)
                    out = fs.open_output_stream(f"{path}/{name.rsplit('/', 1)[1]}", compression=None)
                data = member(page, url, None if html is None else html.encode(), length, base64.b32encode(bytes.fromhex(sha1)).decode(), refers)
                out.write(data)
                size, n = size + len(data), n + 1
        if out is not None:
            out.close()
            yield record(schema, ([name], [size], [n]))

    return scratch.save(marked.mapInArrow(write, "file string, size long, records long"), "archives")


# ----------------------------------------------------------------------------------------- read


class Bytes:
    """A file's bytes by offset, read a block at a time."""

    def __init__(self, file, size: int) -> None:
        self.file, self.size, self.at, self.held = file, size, 0, b""

    def get(self, offset: int) -> bytes:
        """Bytes from ``offset`` on, at least one unless the file has ended."""
        if not self.at <= offset < self.at + len(self.held):
            self.file.seek(offset)
            self.at, self.held = offset, self.file.read(min(BLOCK, max(0, self.size - offset)))
        return self.held[offset - self.at :]


def inflate(data: Bytes, offset: int, most: int | None = None) -> tuple[bytes, int] | None:
    """The gzip member at ``offset`` and where it ends; with ``most``, its first bytes only; None: not one."""
    unpack, out, at = zlib.decompressobj(31), [], offset
    try:
        while not unpack.eof:
            chunk = data.get(at)
            if not chunk:
                return None
            at += len(chunk)
            out.append(unpack.decompress(chunk, most or 0))
            if most and sum(map(len, out)) >= most:
                break
    except zlib.error:
        return None
    return b"".join(out), at - len(unpack.unused_data)


def candidates(data: Bytes, start: int, end: int) -> Iterator[int]:
    """Offsets in [start, end) at which the gzip magic stands, across block borders too."""
    at = start
    while at < end:
        chunk = data.get(at)[: end - at + 2]
        if len(chunk) < 3:
            more = data.get(at + len(chunk)) if chunk else b""
            chunk += more[: 3 - len(chunk)]
            if len(chunk) < 3:
                return
        i = chunk.find(MAGIC)
        while i >= 0:
            if at + i < end:
                yield at + i
            i = chunk.find(MAGIC, i + 1)
        at += max(1, len(chunk) - 2)


def records(data: Bytes, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, raw record) of the members that begin in [start, end).

    A candidate counts if it decodes to a WARC header and whole, and if the file ends or a next member
    stands where it ends; from then on members follow one another without a search.
    """
    at = start
    while at < end:
        for found in candidates(data, at, end):
            head = inflate(data, found, len(VERSION))
            if head and head[0].startswith(VERSION) and (whole := inflate(data, found)):
                after = data.get(whole[1])
                if not after or after.startswith(MAGIC[: len(after)]):
                    break
        else:
            return
        at = found
        while at < end and (whole or (whole := inflate(data, at))) and whole[0].startswith(VERSION):
            yield at, whole[0]
            at, whole = whole[1], None


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record (names in lower case)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields.get("content-length", len(rest)))]
    if "application/http" not in fields.get("content-type", ""):
        return fields, {}, block
    top, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(top), payload


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def read_warc(archives: DataFrame, split: int = SPLIT, payloads: bool = True) -> DataFrame:
    """Records of ``archives`` (file, size): file, offset, record_id, record_type, uri, refers_to,
    payload_bytes, payload_digest and, unless ``payloads`` is off, payload.

    Each file is cut into ranges of ``split`` bytes that are read apart; a range owns the records that
    start in it, so none is lost or read twice.  A revisit has no payload; its length and digest are
    those its headers state.  A payload that differs from its stated digest raises an error.
    """
    ranges = archives.select("file", "size", F.explode(F.sequence(F.lit(0), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split).cast("long"))).alias("start"))
    count = archives.agg(F.sum(F.ceil(F.greatest(F.col("size"), F.lit(1)) / split))).first()[0] or 1
    ranges = ranges.repartition(int(count), "file", "start")
    fields = [("file", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
    fields = fields if payloads else fields[:-1]
    schema = pa.schema(fields)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, path = pafs.FileSystem.from_uri(name)
                rows, held = [], 0
                with fs.open_input_file(path) as file:
                    for offset, raw in records(Bytes(file, size), start, min(size, start + split)):
                        head, http, payload = parse(raw)
                        kind, stated = head.get("warc-type"), head.get("warc-payload-digest", "").removeprefix("sha1:")
                        length = len(payload)
                        if kind == "revisit":
                            length, payload = int(http.get("content-length", 0)), None
                        elif stated and digest(payload) != stated:
                            raise ValueError(f"{name} at {offset}: the payload differs from its digest")
                        row = (name, offset, head.get("warc-record-id"), kind, head.get("warc-target-uri"), head.get("warc-refers-to"), length, stated or digest(payload), payload)
                        rows.append(row[: len(fields)])
                        held += len(raw) if payloads else 300
                        if held > 4 << 20:
                            yield record(schema, zip(*rows, strict=True))
                            rows, held = [], 0
                if rows:
                    yield record(schema, zip(*rows, strict=True))

    ddl = "file string, offset long, record_id string, record_type string, uri string, refers_to string, payload_bytes long, payload_digest string" + ", payload binary" * payloads
    return ranges.mapInArrow(read, ddl)


def page_records(read: DataFrame) -> DataFrame:
    """The contract's columns from what was read back."""
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]*)>$', 1) as bigint)")
    return read.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))

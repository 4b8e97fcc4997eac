"""WARC archives (operator 10): writer and sequential reader.

Writing: each task writes its rows to one archive in the shared folder, one
gzip member for each record, and returns one manifest row. Archives are named
at random, and only those that the committed manifest names are read, so
repeated or lost task attempts leave no wrong rows. Large equal payloads are
stored once: a digest aggregate (combined before its shuffle) finds the page
with the largest id, the others become ``revisit`` records.

Reading: one task for each archive, decompressing in steps with zlib, one
member after the other; a record is framed by its Content-Length, and block
and payload digests are verified. A damaged record raises ``ValueError``.

Edge cases: a null payload is an empty one; a null url gives no target address;
a null page id is kept, counts as the smallest, and its record holds no id;
rows that repeat both page id and payload of a stored response are responses
too; an empty table gives an empty manifest and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import create, map_arrow, materialize, open_shared, shared_folder

MIN_REVISIT_BYTES = 1000
READ_BYTES = 256 << 10
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:x-page:"
MANIFEST = "archive string, n_records long, n_bytes long"


def _base32(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _id(page_id: int | None) -> str:
    return f"<{PAGE_URN}{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One WARC record, not compressed. A revisit holds the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(page_id)}", f"WARC-Date: {DATE}"]
    if url:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else "%%%02X" % ord(c) for c in url))
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_id(refers_to)}"]
    lines += [
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: {_base32(sha1_hex)}",
        f"WARC-Block-Digest: {_base32(hashlib.sha1(block).hexdigest())}", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(stream, step: int = READ_BYTES) -> Iterator[bytes]:
    """The gzip members of a stream, decompressed one after the other."""
    rest = b""
    while True:
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            piece = rest or stream.read(step)
            rest = b""
            if not piece:
                if parts:
                    raise ValueError("the archive ends inside a gzip member")
                return
            parts.append(z.decompress(piece) or b"")
        rest = z.unused_data
        yield b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs if k}


def _verify(what: str, data: bytes, named: str | None) -> None:
    """Compare with a labelled digest (``sha256:...``), in hex or base32; an algorithm
    that is not known here is no damage."""
    label, _, value = (named or "").partition(":")
    algorithm = label.strip().lower().replace("-", "")
    if algorithm not in ("md5", "sha1", "sha224", "sha256", "sha384", "sha512"):
        return
    digest = hashlib.new(algorithm, data).digest()
    value = value.strip()
    if value.lower() != digest.hex() and value.upper().rstrip("=") != base64.b32encode(digest).decode().rstrip("="):
        raise ValueError(f"{what} digest differs: {named}")


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, body) of a record, framed and verified."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    size = int(fields["content-length"])
    block, tail = rest[:size], rest[size:]
    if len(block) != size or tail != b"\r\n\r\n":
        raise ValueError("a record's length differs from its Content-Length")
    _verify("block", block, fields.get("warc-block-digest"))
    http, _, body = block.partition(b"\r\n\r\n")
    if fields["warc-type"] == "response":
        _verify("payload", body, fields.get("warc-payload-digest"))
    return fields, _fields(http), body


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to, revisit) of each row."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    stored = (
        rows.filter(F.octet_length("payload") >= min_bytes)
        .groupBy(F.col("sha1").alias("_sha1")).agg(F.max("page_id").alias("_keeper"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1").select("_sha1", "_keeper")
    )
    revisit = F.col("_keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_keeper"))
    return rows.join(stored, rows.sha1 == stored._sha1, "left").select("page_id", "url", "payload", "sha1", F.when(revisit, F.col("_keeper")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(marked: DataFrame, folder: str | None = None, level: int = 6) -> DataFrame:
    """Write the rows of ``mark_revisits``; returns the written manifest."""
    folder = folder or shared_folder(marked.sparkSession, "warc")

    def write(batches):
        n = size = 0
        with create(folder, f"part-{TaskContext.get().partitionId():06d}.warc.gz") as (uri, out):
            for batch in batches:
                columns = [batch.column(c) for c in ("page_id", "url", "payload", "sha1", "refers_to", "revisit")]
                for i in range(batch.num_rows):
                    page_id, url, payload, sha1, refers_to, revisit = (c[i].as_py() for c in columns)
                    data = member(record(page_id, url, payload.encode(), sha1, refers_to, revisit), level)
                    out.write(data)
                    n, size = n + 1, size + len(data)
        if n:
            yield pa.RecordBatch.from_pydict({"archive": [uri], "n_records": [n], "n_bytes": [size]})

    return materialize(map_arrow(marked, write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Read archives one task each: (page_id, url, payload_bytes,
    payload_digest, record_type, refers_to), with the payload if asked for."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    names = [x.split()[0] for x in schema.split(", ")]

    def page(name: str | None) -> int | None:
        digits = (name or "").removeprefix(f"<{PAGE_URN}").removesuffix(">")
        return int(digits) if digits else None

    def rows(uri: str):
        with open_shared(uri) as stream:
            for data in members(stream):
                fields, http, body = parse(data)
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                kind = fields["warc-type"]
                row = (page(fields["warc-record-id"]), fields.get("warc-target-uri"), int(http["content-length"]), digest, kind, page(fields.get("warc-refers-to")))
                yield row + (body if kind == "response" else None,) * with_payload

    def read(batches):
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                out: list = []
                size = 0
                for row in rows(uri):
                    out.append(row)
                    size += row[2] if with_payload else 1
                    if len(out) >= 4096 or size > 16 << 20:
                        yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out, strict=True), strict=True)), schema=arrow)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out, strict=True), strict=True)), schema=arrow)

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")])
    n = max(1, manifest.count())
    return map_arrow(manifest.select("archive").repartition(n), read, schema)

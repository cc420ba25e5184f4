"""WARC archives: one gzip member per record, written and read back as Spark jobs.

Writing: pages become ``response`` records; a page whose payload another page
has as well becomes a ``revisit`` of the page with the largest id.  Each task
writes its records one behind the other into one archive in the shared folder.

Reading: each archive is read sequentially.  Members are inflated piece by
piece, the header block is framed by its blank line and the content by its
Content-Length, and block and payload digests are verified.  A record that
fails a check is returned with its ``problem``.  A damaged member is one such
row; reading goes on at the next member that begins with a record.

Null payloads count as empty, null ids are lowest and stay null, null URLs have
no target header.  Rows that repeat id and payload are records of their own;
all rows with the largest id of their payload are responses.  An empty table
gives an archive without records.  Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import io
import urllib.parse
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm.common import stored

RECORD_URN = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLANK_LINE = b"\r\n\r\n"
CHUNK = 1 << 16
MAGIC = b"\x1f\x8b\x08"
RECORD_START = b"WARC/"
LEAST_MEMBER = 1 << 10  # enough of a member to see how it begins

READ_SCHEMA = (
    "record_id long, record_type string, target_uri string, refers_to long,"
    " payload_bytes long, payload_digest string, problem string"
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- writing -------------------------------------------------------------------


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str
) -> bytes:
    """A whole record, not yet compressed."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{RECORD_URN}{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:  # a line break in a URL must not end the header
        fields.insert(3, ("WARC-Target-URI", urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{RECORD_URN}{refers_to}>")]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + BLANK_LINE


def member(data: bytes) -> bytes:
    compress = zlib.compressobj(6, zlib.DEFLATED, 31)
    return compress.compress(data) + compress.flush()


def _members(date: str):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                data = member(record(page_id, url, payload, refers_to, date))
                # The writer ends every row with a zero byte, as nearly every member ends:
                # the top byte of its length.  One of 16 MiB and more ends otherwise and gets
                # the zero as padding, which gzip allows between members.
                out.append(data[:-1] if data[-1] == 0 else data)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    return made


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Rows (id, url, payload, refers_to): null for responses, else the page revisited.

    Only payloads of at least ``min_bytes`` bytes are compared.  Grouping sees digests alone;
    the payload moves only if the payloads that occur twice are too many to broadcast.
    """
    payload = F.coalesce(F.col("payload").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("id").cast("long").alias("id"), "url", payload.alias("payload"))
    hashed = rows.select("id", F.sha2("payload", 256).alias("hash"), F.length("payload").alias("n"))
    groups = (
        hashed.where(F.col("n") >= min_bytes)
        .groupBy("hash")
        .agg(F.max("id").alias("original"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select(F.col("hash").alias("known"), "original")
    )
    groups = stored(groups, "warc-copies")
    marked = rows.join(groups, F.sha2("payload", 256) == F.col("known"), "left")
    same = F.col("id").eqNullSafe(F.col("original"))
    return marked.select("id", "url", "payload", F.when(~same, F.col("original")).alias("refers_to"))


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Write a record per row of (id, url, payload) below ``path``, an archive per task."""
    members = with_revisits(pages, min_bytes).mapInArrow(_members(date), "member binary")
    # The text writer passes the bytes of a string on as they are.
    lines = members.select(F.col("member").cast("string").alias("value"))
    lines.write.option("lineSep", "\0").text(path)


# --- reading -------------------------------------------------------------------


def _next_member(data: bytes, source: BinaryIO) -> bytes:
    """What is left from the next place on where a member with a record begins; empty if there is none."""
    at = 0
    while True:
        at = data.find(MAGIC, at)
        if at < 0:
            data, at = data[-len(MAGIC) + 1 :], 0
            if not (more := source.read(CHUNK)):
                return b""
            data += more
            continue
        begins = b""
        with contextlib.suppress(zlib.error):
            begins = zlib.decompressobj(31).decompress(data[at : at + CHUNK], len(RECORD_START))
        if begins == RECORD_START:
            return data[at:]
        if len(data) - at < LEAST_MEMBER and (more := source.read(CHUNK)):
            data = data[at:] + more
            at = 0
            continue
        at += 1


def read_members(source: BinaryIO) -> Iterator[bytes | str]:
    """Each member inflated, piece by piece; a text instead of bytes says what is wrong.

    Behind a damaged member the next one that holds a record is looked for, from
    the byte behind the start of the damaged one on: it may have run on into it.
    """
    data = b""
    while True:
        while not (data := data.lstrip(b"\0")):  # padding between members
            data = source.read(CHUNK)
            if not data:
                return
        inflate, parts, raw, problem = zlib.decompressobj(31), [], [], None
        try:
            while not inflate.eof:
                raw.append(data)
                parts.append(inflate.decompress(data))
                data = inflate.unused_data
                if not inflate.eof and not (data := source.read(CHUNK)):
                    problem = "truncated member"
                    break
        except zlib.error:
            problem = "damaged member"
        if problem is None:
            yield b"".join(parts)
        else:
            yield problem
            data = _next_member(b"".join(raw)[1:], source)


def _number(urn: str | None) -> int | None:
    text = (urn or "").strip("<>").removeprefix(RECORD_URN)
    return int(text) if text.lstrip("-").isdigit() else None


def parse(data: bytes) -> dict[str, object]:
    """Fields of one record, with the first check it fails in ``problem``."""
    head, blank, rest = data.partition(BLANK_LINE)
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    length = int(n) if (n := fields.get("content-length", "")).isdigit() else -1
    block = rest[: max(length, 0)]
    http, http_blank, payload = block.partition(BLANK_LINE)
    declared = [
        line.partition(b":")[2].strip()
        for line in http.split(b"\r\n")
        if line.lower().startswith(b"content-length:")
    ]
    size = int(declared[0]) if declared and declared[0].isdigit() else len(payload)
    payload_digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields.get("warc-type")
    problem = None
    if not lines[0].startswith("WARC/") or not blank:
        problem = "no record header"
    elif length < 0 or rest[length:] != BLANK_LINE:
        problem = "content length"
    elif fields.get("warc-block-digest") != f"sha1:{digest(block)}":
        problem = "block digest"
    elif not http_blank:
        problem = "no response header"
    elif kind == "response" and size != len(payload):
        problem = "payload length"
    elif kind == "response" and payload_digest != digest(payload):
        problem = "payload digest"
    return {
        "record_id": _number(fields.get("warc-record-id")),
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": _number(fields.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": payload_digest,
        "problem": problem,
        "payload": payload if kind == "response" else None,
    }


def _read(names: list[str], types: pa.Schema):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows, held = [], 0
                for data in read_members(io.BytesIO(archive.as_buffer())):
                    got = {"problem": data} if isinstance(data, str) else parse(data)
                    rows.append({name: got.get(name) for name in names})
                    held += len(data)
                    if held > 1 << 23:
                        yield pa.RecordBatch.from_pylist(rows, types)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, types)

    return made


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives below ``path``: ids, type, digest, length, problem.

    Spark hands a task one archive as one value, so an archive must fit in a
    task's memory; those written here hold one input split.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path)
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    kinds = [pa.int64() if " long" in x else pa.string() for x in READ_SCHEMA.split(", ")]
    schema = READ_SCHEMA
    if with_payload:
        names, kinds, schema = [*names, "payload"], [*kinds, pa.binary()], f"{schema}, payload binary"
    return files.select("content").mapInArrow(_read(names, pa.schema(list(zip(names, kinds)))), schema)

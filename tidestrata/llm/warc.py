"""WARC archives: one gzip member per record, written by Spark and read from byte ranges.

The reader is splittable. A task takes a range of a file, looks for gzip's first bytes, and accepts
a place as a record's start only if decoding there gives a WARC header. It owns the records that
start inside its range and reads the last one to its end, wherever that is.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestrata.llm.common import new_folder

#: Payloads of fewer bytes are always written in full.
REVISIT_BYTES = 1000
RANGE_BYTES = 8 * 1024 * 1024
#: Bytes read from a file at a time.
CHUNK = 1024 * 1024
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
RECORDS = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload binary, "
    "payload_digest string, file string, position bigint"
)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    number = record.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record_bytes(page_id, url, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One record, uncompressed. A null URL has no target line."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe='!#$&()*+,/:;=?@[]~')}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    body = b"" if revisit else payload
    lines += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """``data`` as gzip that ends in a zero byte.

    The last byte is the highest of the length, so it is zero below 16 MB; an empty member follows
    a longer record, which readers pass over.
    """
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    member = packer.compress(data) + packer.flush()
    return member if member[-1] == 0 else member + gzip_member(b"")


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, refers_to, revisit): which pages repeat another's payload.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest id is written
    in full. Payloads are grouped by SHA-1 and length, narrow rows that are combined before the
    shuffle; pages whose payload is unique meet no other page.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        payload.alias("payload"),
    ).withColumns({"sha": F.unhex(F.sha1("payload")), "bytes": F.octet_length("payload")})
    repeated = (
        rows.where(F.col("bytes") >= least)
        .groupBy("sha", "bytes")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .drop("n")
    )
    joined = rows.join(repeated, ["sha", "bytes"], "left")
    later = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return joined.select("page_id", "url", "payload", F.when(later, F.col("refers_to")).alias("refers_to"), later.alias("revisit"))


def write_archive(pages: DataFrame, path: str, least: int = REVISIT_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as archives under ``path``.

    Spark's own writer commits the files, so a lost executor leaves no half-written archive, and any
    store that Spark writes to will do. It puts a separator after each row; as every member ends in
    a zero byte, that byte is the separator, and files hold gzip members and nothing else. A null
    html is an empty payload. Rows repeated in id and payload, of which none is larger, are all
    written in full.
    """

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = (gzip_member(record_bytes(*(c.as_py() for c in row)))[:-1] for row in zip(*batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["member"])

    archive = with_revisits(pages, least).mapInArrow(members, "member binary")
    archive.select(F.col("member").cast("string")).write.option("lineSep", "\0").text(path)


def read_archive(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records under ``path``: page_id, url, record_type, refers_to, payload, payload_digest, file, position.

    Files are listed by Spark and cut into ranges of ``range_bytes``, dealt to tasks one by one. A
    revisit's payload is null and its digest (lower-case hex) the one it was written with. A member
    that breaks off, or a response whose payload does not have its digest, raises an error. Members
    that hold no WARC record are passed over.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes)))
    ranges = files.where(F.col("length") > 0).select("path", starts.alias("start"))
    tasks = ranges.repartition(max(1, ranges.count()), "path", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[k]) for n, k in (c.split() for c in RECORDS.split(", "))]
        )
        for batch in batches:
            for file, start in zip(*(c.to_pylist() for c in batch.columns)):
                rows, held = [], 0
                for position, data in owned_members(file, start, start + range_bytes):
                    row = parsed(data)
                    if row is None:
                        continue
                    rows.append(row | {"file": file, "position": position})
                    held += len(data)
                    if held > 4 * CHUNK:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return tasks.mapInArrow(read, RECORDS)


class Window:
    """A file's bytes from a place on, read in chunks as they are asked for."""

    def __init__(self, file, start: int):
        self.file, self.start, self.data, self.ended = file, start, b"", False
        file.seek(start)

    def more(self) -> bool:
        chunk = self.file.read(CHUNK)
        self.ended = not chunk
        self.data += chunk
        return not self.ended

    def drop_before(self, place: int) -> None:
        self.data = self.data[place - self.start :]
        self.start = place


def store_uri(uri: str) -> str:
    """A path as Spark names it, for pyarrow, which knows one scheme for S3."""
    return re.sub("^s3[an]:", "s3:", uri)


def owned_members(uri: str, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """(position, content) of the records that start in [start, stop) of a file."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(store_uri(uri))
    with store.open_input_file(name) as file:
        window, place = Window(file, start), start
        while place < stop:
            found = window.data.find(MAGIC, place - window.start)
            if found < 0:
                place = max(place, window.start + len(window.data) - len(MAGIC) + 1)
                window.drop_before(place)
                if not window.more():
                    return
                continue
            place = window.start + found
            if place >= stop:
                return
            window.drop_before(place)
            content, used = _member(window)
            if content is None:
                place += 1
            else:
                yield place, content
                place += used


def _member(window: Window) -> tuple[bytes | None, int]:
    """The record that starts with the window, and its compressed size; no record: None."""
    unpacker, at, parts, checked, size = zlib.decompressobj(31), 0, [], False, 0
    while True:
        piece = window.data[at : at + CHUNK]
        if not piece:
            if window.more():
                continue
            if checked:
                raise ValueError("an archive breaks off within a record")
            return None, 0
        try:
            out = unpacker.decompress(piece)
        except zlib.error:
            if checked:
                raise ValueError("an archive has a damaged record") from None
            return None, 0
        at += len(piece)
        parts.append(out)
        size += len(out)
        if not checked and (size >= len(VERSION) or unpacker.eof):
            if not b"".join(parts).startswith(VERSION):
                return None, 0
            checked = True
        if unpacker.eof:
            return b"".join(parts), at - len(unpacker.unused_data)


def parsed(data: bytes) -> dict | None:
    """A record's fields; other kinds than response and revisit give None."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    payload = rest[: int(fields["content-length"])] if kind == "response" else None
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if payload is not None and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    url = fields.get("warc-target-uri")
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "url": None if url is None else unquote(url),
        "record_type": kind,
        "refers_to": page_of(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload,
        "payload_digest": digest,
    }


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with ``payload_bytes`` of the full payload, also of revisits.

    A revisit's size is that of the response it refers to with the same digest. Many revisits of one
    response are split by adaptive execution; the responses come as one narrow row per id and digest.
    """
    sizes = (
        records.where(F.col("record_type") == "response")
        .groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
        .agg(F.max(F.octet_length("payload")).cast("bigint").alias("referred_bytes"))
    )
    own = records.withColumn("own_bytes", F.octet_length("payload").cast("bigint"))
    # The planner takes records for as few as the files they come from; merged, they may be many.
    return own.join(sizes.hint("merge"), ["refers_to", "payload_digest"], "left").withColumn(
        "payload_bytes", F.coalesce("own_bytes", "referred_bytes")
    ).drop("own_bytes", "referred_bytes")


def round_trip(pages: DataFrame) -> DataFrame:
    """``pages`` written as archives in the shared folder and read back."""
    path = new_folder(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path)

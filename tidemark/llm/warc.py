"""WARC archives: written by Spark's own committed file writer, read back by a reader that salvages.

A record is one gzip member, so that each can be read without those before it. Spark's text writer puts one member
after the other; its separator is an empty member, which readers of such files skip. Equal payloads are
stored once: the record of the smallest id is a response, the others are revisits that refer to it.

The reader takes an archive from its first byte. What stands there must be a gzip member of whole records, or a record
that is not compressed, and it must pass all checks: the member's own checksum, version line, headers, length
of the block, the line ends after it, and the digests it names. If it fails, the reader looks for the next
place where a member or a version line opens and tries again there; what it went over is reported as a
gap, with the reason, beside the records it recovered. Inside of a member that unpacks well the same is done
by version lines. Of one that does not, those records stay that unpacked whole and that a digest of their own proves.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.shared import scratch_folder

EPOCH = "1970-01-01T00:00:00Z"
#: Records of one archive at most, and bytes of records that leave the reader at once.
ARCHIVE_RECORDS, BATCH_BYTES = 4096, 8_000_000
#: Bytes that a member may unpack to; more is reported as a gap.
MEMBER_BYTES = 2**31 - 1
#: Bytes that are unpacked at once.
CHUNK = 2**16

MAGIC, VERSION, GAP = b"\x1f\x8b\x08", re.compile(rb"WARC/1\.[01]\r\n"), b"\r\n\r\n"
SIGN = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = (
    "archive string, start long, end long, reason string, type string, record_id string, refers_to string, uri string, date string, "
    "payload_digest string, payload_bytes long, headers map<string,string>, payload binary"
)


def packed(data: bytes) -> bytes:
    """data as a gzip member, the same bytes whenever it is made."""
    work = zlib.compressobj(6, zlib.DEFLATED, 31)
    return work.compress(data) + work.flush()


EMPTY = packed(b"")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def write_archives(pages: DataFrame, folder: str, least: int = 0, date: str = EPOCH) -> None:
    """A WARC record per row of pages (page_id, url, html) in a new folder, some thousand to an archive.

    The payload is the html in UTF-8; null is an empty payload. Of the rows whose payloads are equal and have `least`
    bytes at least, the one with the smallest page_id becomes a response, the others revisits of it. Rows that
    share this id are all responses. Null ids come last: a row without an id is a revisit where another
    row has one, and if none has, all are responses. A null url gives no target; control characters
    in it are written as %XX. Other columns do not matter. An empty table makes a folder without records.
    """
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("same", F.sha2("payload", 256))
    large = F.octet_length("payload") >= least
    firsts = rows.where(large).groupBy("same").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    joined = rows.join(firsts.where("n > 1 and first is not null").select("same", "first"), "same", "left")
    refers = F.when(large & (F.coalesce(F.col("id") != F.col("first"), F.col("first").isNotNull())), F.col("first"))
    records = joined.select("id", "url", "payload", refers.alias("refers")).mapInArrow(_written(date), "member binary")
    writer = records.select(F.col("member").cast("string").alias("value")).write
    writer = writer.option("lineSep", EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1")
    writer.option("maxRecordsPerFile", ARCHIVE_RECORDS).text(folder)


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """A row per record and per gap: archive, start and end (its bytes there), reason (null for records), and
    of records type, record_id, refers_to, uri, date, payload_digest, payload_bytes, headers, payload.

    Digest and size are those of the full payload: of what stands in the record, or as the headers of a revisit give
    them. Header names are in lower case; of a repeated one the last counts. start and end of records
    inside one member are the member's. A task holds one archive and its records one after the other. With
    payloads=False the payload is null. Empty files have neither records nor gaps.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(_read(payloads), RECORDS)


def records(found: DataFrame) -> DataFrame:
    return found.where("reason is null").drop("reason")


def gaps(found: DataFrame) -> DataFrame:
    """Quarantined bytes: archive, start, end, reason."""
    return found.where("reason is not null").select("archive", "start", "end", "reason")


def page_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every row, read back from archives of pages."""
    folder = scratch_folder(pages.sparkSession, "archives")
    write_archives(pages, folder, least)
    found = records(read_archives(pages.sparkSession, folder, payloads=False))
    return found.select(
        _page_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        _page_id("refers_to").alias("refers_to"),
    )


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(column: str):
    return F.nullif(F.regexp_extract(column, r"^<urn:page:(-?\d*)>$", 1), F.lit("")).cast("long")


def record(page_id: int | None, url: str | None, payload: bytes, refers: int | None, date: str = EPOCH) -> bytes:
    """A response with its payload, or, if it refers to another page, a revisit without."""
    http = HTTP.format(len(payload)).encode()
    block = http + payload if refers is None else http
    headers = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else re.sub(r"[\x00-\x20\x7f-\x9f]", lambda c: "".join(f"%{b:02X}" for b in c[0].encode()), url)),
        ("WARC-Profile", None if refers is None else PROFILE),
        ("WARC-Refers-To", None if refers is None else record_id(refers)),
        ("WARC-Payload-Digest", "sha1:" + digest(payload)),
        ("WARC-Block-Digest", "sha1:" + digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers if value is not None)
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "replace") + b"\r\n" + block + GAP


def _written(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, refers = (batch.column(i).to_pylist() for i in (0, 1, 3))
            made, held = [], 0
            for id_, url, payload, to in zip(ids, urls, batch.column(2), refers, strict=True):
                made.append(packed(record(id_, url, payload.as_py(), to, date)))
                held += len(made[-1])
                if held > BATCH_BYTES:
                    yield pa.record_batch([pa.array(made, pa.binary())], ["member"])
                    made, held = [], 0
            if made:
                yield pa.record_batch([pa.array(made, pa.binary())], ["member"])

    return run


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    payload: bytes
    payload_digest: str
    payload_bytes: int
    proved: bool
    start: int = 0
    end: int = 0


@dataclass(frozen=True)
class Gap:
    start: int
    end: int
    reason: str


class Damaged(Exception):
    """What stands here fails a check; the message says which, kept has what is whole all the same."""

    def __init__(self, reason: str, kept: list[Record] | None = None):
        super().__init__(reason)
        self.kept = kept or []


def salvaged(data: bytes, members: bool = True) -> Iterator[Record | Gap]:
    """Records and gaps of an archive, in order; together they cover it."""
    at, opened, reason = 0, None, ""
    signs = SIGN if members else VERSION
    while at < len(data):
        try:
            found, end = _member(data, at) if members and data.startswith(MAGIC, at) else _plain(data, at)
        except Damaged as error:
            if opened is None:
                opened, reason = at, str(error)
            sign = signs.search(data, at + 1)
            past = sign.start() if sign else len(data)
            yield from (replace(r, start=at, end=past) for r in error.kept)
            at = past
            continue
        if opened is not None:
            yield Gap(opened, at, reason)
            opened = None
        yield from (replace(r, start=at, end=end) for r in found)
        at = end
    if opened is not None:
        yield Gap(opened, len(data), reason)


def _member(data: bytes, at: int) -> tuple[list[Record | Gap], int]:
    """Records (and gaps between them) of the gzip member at a place, and where it ends."""
    work, view, parts, held, to, why = zlib.decompressobj(31), memoryview(data), [], 0, at, ""
    try:
        while not work.eof and to < len(data) and held <= MEMBER_BYTES:
            parts.append(work.decompress(view[to : to + CHUNK]))
            held += len(parts[-1])
            to = min(to + CHUNK, len(data))
    except zlib.error as error:
        why = str(error).rpartition(": ")[2]
    if not work.eof:
        why = why or ("too large" if held > MEMBER_BYTES else "cut off")
    found = list(salvaged(b"".join(parts), members=False))
    if why:
        raise Damaged(f"gzip member: {why}", [r for r in found if isinstance(r, Record) and r.proved])
    if found and not any(isinstance(r, Record) for r in found):
        raise Damaged(found[0].reason)
    return [r if isinstance(r, Record) else replace(r, reason=f"inside a member: {r.reason}") for r in found], to - len(work.unused_data)


def _plain(data: bytes, at: int) -> tuple[list[Record], int]:
    """The record that is not compressed at a place, and where it ends."""
    version = VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    close = data.find(GAP, version.end() - 2)
    if close < 0:
        raise Damaged("headers cut off")
    headers = _headers(data[version.end() : close])
    length = headers.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        raise Damaged("no content length")
    start = close + len(GAP)
    end = start + int(length)
    if end + len(GAP) > len(data):
        raise Damaged("block cut off")
    if data[end : end + len(GAP)] != GAP:
        raise Damaged("block of another length")
    return [_checked(headers, data[start:end])], end + len(GAP)


def _headers(data: bytes) -> dict[str, str]:
    found, last = {}, None
    for line in data.decode("utf-8", "replace").split("\r\n") if data else []:
        name, colon, value = line.partition(":")
        if last and line[:1] in (" ", "\t"):
            found[last] += " " + line.strip()
        elif not colon or not re.fullmatch(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name):
            raise Damaged("header line")
        else:
            last = name.lower()
            found[last] = value.strip()
    return found


def _checked(headers: dict[str, str], block: bytes) -> Record:
    """The record, if its block is what its digests say."""
    if not {"warc-type", "warc-record-id"} <= headers.keys():
        raise Damaged("no type or record id")
    proved = _proved("block", headers.get("warc-block-digest"), block)
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        payload = block.partition(GAP)[2]
    if headers["warc-type"] == "revisit":
        told = re.fullmatch(r"sha1:([A-Z2-7]{32})", headers.get("warc-payload-digest", ""))
        length = re.search(rb"(?im)^content-length: *([0-9]{1,18})\r$", block)
        if not told or not length:
            raise Damaged("revisit without digest or size")
        return Record(headers, payload, told[1], int(length[1]), proved)
    proved = _proved("payload", headers.get("warc-payload-digest"), payload) or proved
    return Record(headers, payload, digest(payload), len(payload), proved)


def _proved(what: str, told: str | None, data: bytes) -> bool:
    """Whether the data has the digest told; none, or one of another kind than SHA-1, proves nothing."""
    if not told or not told.startswith("sha1:"):
        return False
    if told[5:] != digest(data):
        raise Damaged(f"{what} digest")
    return True


def _read(payloads: bool):
    def rows_of(archive: str, data: bytes) -> Iterator[tuple]:
        for found in salvaged(data):
            if isinstance(found, Gap):
                yield archive, found.start, found.end, found.reason, *[None] * 9
            else:
                h = found.headers
                named = (h.get(k) for k in ("warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri", "warc-date"))
                payload = found.payload if payloads else None
                yield archive, found.start, found.end, None, *named, found.payload_digest, found.payload_bytes, list(h.items()), payload

    text, long = pa.string(), pa.int64()
    kinds = [text, long, long, text, text, text, text, text, text, text, long, pa.map_(text, text), pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, held = [], 0
                for row in rows_of(path.as_py(), content.as_py()):
                    rows.append(row)
                    held += 1000 + len(row[-1] or b"")
                    if held > BATCH_BYTES:
                        yield made(rows)
                        rows, held = [], 0
                if rows:
                    yield made(rows)

    return run

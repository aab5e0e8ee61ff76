"""Write pages as web archive records, and read archives back past damage."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import shared_table, table
from gridloom.session import shared_folder

VERSION = b"WARC/1.1"
# All records carry one date, so that reruns write the same bytes.
DATE = "2024-01-01T00:00:00Z"
# A payload of at least so many bytes is stored once.
LEAST_PAYLOAD = 0
RECORDS_PER_FILE = 2000
# Records of up to so many bytes, and how many of them a file holds at most: a file is read whole
# by one task, so that its size is bounded by bytes too. Longer records have a file each.
SIZE_CLASSES = [(1 << 16, 2000), (1 << 20, 128), (1 << 24, 8)]
PIECE = 1 << 14
# A whole compressed member that holds nothing: it ends a record in Spark's text writer, which
# puts a separator after each row.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000030300" + "00" * 8)

_VERSION_LINE = re.compile(rb"WARC/[0-9]+\.[0-9]+\r\n")
# Headers end before a line that holds nothing but a version.
_NEXT_VERSION = re.compile(rb"\r\nWARC/[0-9]+\.[0-9]+\r\n")
_LENGTH_LINE = re.compile(rb"\r\nContent-Length[ \t]*:", re.IGNORECASE)
_MEMBER = b"\x1f\x8b\x08"

RECORD_SCHEMA = (
    "file string, start long, length long, kind string, reason string, record_id string, warc_type string,"
    " refers_to string, uri string, payload_digest string, payload_length long, payload binary"
)


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(
    page_id, url: str | None, payload: bytes, digest: str, refers_to=None, compress: bool = True
) -> bytes:
    """One record: a response with its payload, or a revisit with the response's headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_digest(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines.append(f"Content-Length: {len(block)}")
    record = VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    if not compress:
        # The separator of the text writer ends the record.
        return record[:-4]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def dealt_payloads(pages: DataFrame, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """Pages with their payload, its digest, and the page whose response stands for it.

    The response to a digest is the one with the largest page_id. Digests that occur once stay out
    of the join; those that occur more often are a table of their own, so that the join has plain
    exchanges on both sides and a digest with most of the pages is split while it runs.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    hashed = pages.select(F.col("page_id"), F.col("url"), payload.alias("payload"), F.sha1(payload).alias("sha1"))
    repeated = (
        hashed.where(F.length("payload") >= least_payload)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("sha1").alias("repeated_sha1"), "response_id")
    )
    repeated = shared_table(repeated, "repeated")
    return hashed.join(repeated, F.col("sha1") == F.col("repeated_sha1"), "left").drop("repeated_sha1")


def write_archives(
    pages: DataFrame,
    path: str,
    least_payload: int = LEAST_PAYLOAD,
    compress: bool = True,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write one record per page into archives below ``path``, by Spark's own text writer.

    Of pages with equal payloads of at least ``least_payload`` bytes the one with the largest
    page_id is written as response, the others as revisits of it; where all of their ids are null,
    all are responses, as are rows that repeat the page_id of the response. A null html is an
    empty payload, a null url has no target. Compressed records are a gzip member each. A file
    holds at most ``records_per_file`` records of one task, and fewer of longer ones: records are
    written by classes of size, so that no file outgrows what a task can read.
    """
    rows = dealt_payloads(pages, least_payload).select("page_id", "url", "payload", "response_id")
    size = F.length("payload") + 3 * F.coalesce(F.octet_length("url"), F.lit(0))
    place = F.lit(len(SIZE_CLASSES))
    for i, (bytes_, _) in reversed(list(enumerate(SIZE_CLASSES))):
        place = F.when(size <= bytes_, i).otherwise(place)
    html = 3 * F.coalesce(F.octet_length("url"), F.lit(0)) + F.coalesce(F.octet_length("html"), F.lit(0))
    longest = pages.agg(F.max(html)).first()[0] or 0
    limits = [*(n for _, n in SIZE_CLASSES), 1]
    held = [i for i in range(len(limits)) if i == 0 or longest > SIZE_CLASSES[i - 1][0]]

    def records(batches):
        for batch in batches:
            out, held = [], 0
            for page_id, url, payload, response in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                refers_to = response if response is not None and response != page_id else None
                record = record_bytes(page_id, url, payload, base32_digest(payload), refers_to, compress)
                out.append(record)
                held += len(record)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    separator = EMPTY_MEMBER.decode("latin-1") if compress else "\r\n\r\n"
    for i in held:
        own = rows if len(held) == 1 else rows.where(place == i)
        (
            own.mapInArrow(records, "record binary")
            .select(F.col("record").cast("string").alias("value"))
            .write.mode("append" if i else "errorifexists")
            .option("lineSep", separator)
            .option("encoding", "ISO-8859-1")
            .option("maxRecordsPerFile", min(records_per_file, limits[i]))
            .text(path)
        )


def _headers(block: bytes) -> dict[str, str]:
    found = {}
    for line in block.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            found[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return found


class Finder:
    """The next place of a pattern at or behind a place. Asked from left to right, it reads the data once."""

    def __init__(self, data: bytes, pattern: re.Pattern):
        self.data, self.pattern = data, pattern
        self.asked, self.found = 0, -1

    def __call__(self, start: int) -> int:
        """Its place, or the end of the data."""
        if not self.asked <= start <= self.found:
            hit = self.pattern.search(self.data, start)
            self.asked, self.found = start, hit.start() if hit else len(self.data)
        return self.found


class Places:
    """Where the parts of records may be in some data."""

    def __init__(self, data: bytes):
        self.data = data
        self.member = Finder(data, re.compile(re.escape(_MEMBER)))
        self.version = Finder(data, _VERSION_LINE)
        self.next_version = Finder(data, _NEXT_VERSION)
        self.headers_end = Finder(data, re.compile(rb"\r\n\r\n"))
        self.length = Finder(data, _LENGTH_LINE)


def parse_record(places: Places, start: int) -> tuple[int, dict] | str:
    """The record at a place and where it ends, or why there is none.

    A record is whole when its lengths fit, it ends in two line ends, and the digests it names are
    those of its block and, for a response, of its payload. Nothing guards the other header lines
    of an archive that is not compressed. Headers may have any length; they end before the next
    version line, so that what is no record is left after a look at its own lines.
    """
    data = places.data
    if not _VERSION_LINE.match(data, start):
        return "no version line"
    stop = places.headers_end(start)
    if stop >= len(data) or places.next_version(start) < stop:
        return "headers without end"
    if places.length(start) > stop:
        return "no length"
    headers = _headers(data[start:stop])
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        return "no length"
    first = stop + 4
    last = first + int(length)
    if last + 4 > len(data) or data[last : last + 4] != b"\r\n\r\n":
        return "wrong length"
    block = data[first:last]
    named = headers.get("warc-block-digest")
    if named and named != f"sha1:{base32_digest(block)}":
        return "wrong block digest"
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = headers.get("warc-type", "")
    digest = headers.get("warc-payload-digest", "")
    if kind == "response" and digest and digest != f"sha1:{base32_digest(payload)}":
        return "wrong payload digest"
    full = _headers(http).get("content-length", "")
    identifier = lambda value: re.sub(r"^<urn:page:(.*)>$", r"\1", value) if value else None
    return last + 4, {
        "record_id": identifier(headers.get("warc-record-id")),
        "warc_type": kind,
        "refers_to": identifier(headers.get("warc-refers-to")),
        "uri": headers.get("warc-target-uri"),
        "payload_digest": digest.removeprefix("sha1:"),
        "payload_length": int(full) if full.isdigit() else len(payload),
        "payload": payload if kind == "response" else None,
    }


class Members:
    """The gzip members of some data. A stretch of packed data that is broken is unpacked once."""

    def __init__(self, data: bytes):
        self.data, self.zero = data, Finder(data, re.compile(rb"\0"))
        self.broken: dict[int, str] = {}

    def packed_at(self, start: int) -> int | None:
        """Where the packed data of a member begins, behind its header; nothing where it has no end."""
        data, at = self.data, start + 10
        if at > len(data):
            return None
        flags = data[start + 3]
        if flags & 0xE0:
            return None
        if flags & 4:
            at += 2 + int.from_bytes(data[at : at + 2], "little")
        for flag in (8, 16):  # a name and a comment end in a zero
            if flags & flag:
                at = (self.zero(at) if at < len(data) else len(data)) + 1
        if flags & 2:
            at += 2
        return at if at < len(data) else None

    def read(self, start: int) -> tuple[int, bytes] | str:
        """The member at a place, unpacked, and where it ends; its checksum is tested."""
        data, first = self.data, self.packed_at(start)
        if first is None:
            return "bad member: header"
        if first in self.broken:
            return self.broken[first]
        unpacker, parts, at = zlib.decompressobj(-15), [], first
        try:
            while not unpacker.eof and at < len(data):
                parts.append(unpacker.decompress(data[at : at + PIECE]))
                at = min(at + PIECE, len(data))
        except zlib.error as fault:
            self.broken[first] = f"bad member: {str(fault)[:60]}"
            return self.broken[first]
        end = at - len(unpacker.unused_data) + 8
        if not unpacker.eof or end > len(data):
            self.broken[first] = "member without end"
            return self.broken[first]
        inner = b"".join(parts)
        if zlib.crc32(inner) != int.from_bytes(data[end - 8 : end - 4], "little"):
            return "bad member: checksum"
        if len(inner) & 0xFFFFFFFF != int.from_bytes(data[end - 4 : end], "little"):
            return "bad member: length"
        return end, inner


def salvage(data: bytes) -> Iterator[tuple[int, int, str, str | None, dict]]:
    """(start, length, kind, reason, record) of all whole records of an archive, and of the gaps.

    After a failed check the search goes on at the next byte that begins a gzip member or a
    version line; what lies between is one quarantined gap, with the reason of its first failure.
    Records later in the file are found again. A member may hold several records; a failed one
    inside it is a gap of the member's bytes.
    """
    at, gap, why = 0, None, None
    places, members = Places(data), Members(data)
    while at < len(data):
        records: list[dict] = []
        fault, end = None, at
        if data.startswith(_MEMBER, at):
            member = members.read(at)
            if isinstance(member, str):
                fault = member
            else:
                end, inner = member
                place, inside = 0, Places(inner)
                while place < len(inner):
                    found = parse_record(inside, place)
                    if isinstance(found, str):
                        fault = fault or found
                        place = inside.version(place + 1)
                    else:
                        place = found[0]
                        records.append(found[1])
        else:
            found = parse_record(places, at)
            if isinstance(found, str):
                fault = found
            else:
                end = found[0]
                records.append(found[1])
        if fault and end == at:  # nothing whole begins here
            if gap is None:
                gap, why = at, fault
            at = min(places.member(at + 1), places.version(at + 1))
            continue
        if gap is not None:
            yield gap, at - gap, "gap", why, {}
            gap = None
        for record in records:
            yield at, end - at, "record", None, record
        if fault:
            yield at, end - at, "gap", fault, {}
        at = end
    if gap is not None:
        yield gap, len(data) - gap, "gap", why, {}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All whole records of the archives below ``path``, and the gaps between them.

    ``kind`` is record or gap; a gap has only file, start, length and reason. ``payload_length`` is
    that of the full payload, also for a revisit, whose payload is null. Each file is read as a
    whole by one task, so that archives should be of bounded size, as ``write_archives`` makes
    them. The search past damage reads a file once, whatever it holds. An empty file has no rows.
    """
    names = [part.split()[0] for part in RECORD_SCHEMA.split(", ") for part in [part.strip()]]

    def records(batches):
        for batch in batches:
            for name, data in zip(batch.column("path"), batch.column("content"), strict=True):
                out, held = [], 0
                for start, length, kind, reason, record in salvage(data.as_py() or b""):
                    out.append({"file": name.as_py(), "start": start, "length": length, "kind": kind, "reason": reason} | record)
                    held += len(record.get("payload") or b"")
                    if held > 8 << 20:
                        yield _batch(out, names)
                        out, held = [], 0
                if out:
                    yield _batch(out, names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(records, RECORD_SCHEMA)


_ARROW = {"start": pa.int64(), "length": pa.int64(), "payload_length": pa.int64(), "payload": pa.binary()}


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(n) for r in rows], _ARROW.get(n, pa.string())) for n in names], names
    )


def archive_round_trip(pages: DataFrame, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back."""
    path = f"{shared_folder(pages.sparkSession)}/archives"
    write_archives(pages, path, least_payload)
    return read_archives(pages.sparkSession, path)


def warc_query(spark, sf_dir) -> DataFrame:
    records = archive_round_trip(table(spark, sf_dir, "pages")).where("kind = 'record'")
    number = lambda c: F.when(F.col(c) != "null", F.col(c).cast("long"))
    return records.select(
        number("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )


WARC_SQL = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS digest
  FROM pages),
dealt AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS response_id FROM hashed)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(digest, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) % 32) + 1)::INT, 1)), '')
    AS payload_digest,
  CASE WHEN response_id IS NULL OR response_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN response_id = page_id THEN NULL ELSE response_id END AS refers_to
FROM dealt
"""

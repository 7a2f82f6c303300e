"""Web archives: written with revisits of equal payloads, read back with salvage of what is damaged."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.common import arrow_schema, land, pick, ship, whole_text

#: Date of every record; the pages carry none.
DATE = "2000-01-01T00:00:00Z"
#: Records of one archive at most, and the bytes it should not pass (a larger record has an archive of its own).
ARCHIVE_RECORDS, ARCHIVE_BYTES = 2000, 128 << 20
#: Bytes of a record beside its payload and url, about.
HEAD_BYTES = 1000
#: Payloads under this many bytes are never revisits.
LEAST_PAYLOAD = 0

# Fixed values of the format.
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
VERSION_LINE = b"WARC/1."
GZIP_MEMBER = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEAD_END = re.compile(rb"\r\n(?:\r\n|(?=WARC/1\.[01]\r\n))")
FEED = 1 << 16


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: five bytes make eight digits."""
    parts = [F.lpad(F.conv(F.substring(hexadecimal, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def payload_sums(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Landed rows (page_id, digest, size, record): SHA-1 and bytes of each payload, and about how long its record is."""
    payload = whole_text(html)
    size = F.octet_length(payload).cast("bigint")
    record = size + F.coalesce(F.octet_length(F.col(url).cast("string")), F.lit(0)) + HEAD_BYTES
    return land(pick(pages, page_id=page_id, digest=F.sha1(payload), size=size, record=record), "payloads")


def revisits_of(sums: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Rows (page_id, digest, refers_to) of the pages whose payload a smaller page_id has too."""
    sums = sums.filter(F.col("size") >= least)
    first = sums.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return land(sums.join(first, "digest").filter("NOT page_id <=> refers_to").select("page_id", "digest", "refers_to").distinct(), "revisits")


def records(pages: DataFrame, revisits: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One column ``value``: the record of each page, without its last line feed."""
    source = pick(pages, page_id=page_id, url=F.coalesce(F.col(url).cast("string"), F.lit("")), payload=whole_text(html)).withColumn("digest", F.sha1("payload"))
    again = revisits.select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to")
    joined = source.join(again, source.page_id.eqNullSafe(F.col("again_id")) & (source.digest == F.col("again_digest")), "left")
    is_revisit = F.col("again_digest").isNotNull()
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"))
    blocks = joined.withColumn("block", F.when(is_revisit, head).otherwise(F.concat(head, F.col("payload"))))
    target = F.regexp_replace(F.when(F.col("url") == "", urn(F.col("page_id"))).otherwise(F.col("url")), r"[\x00-\x20\x7f]", "%20")
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(is_revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id")), F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), target,
        F.when(is_revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), urn(F.col("refers_to")), F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}"))).otherwise(""),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32(F.col("digest")), F.lit("\r\nWARC-Block-Digest: sha1:"), base32(F.sha1("block")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("block").cast("string"), F.lit("\r\n\r\n"),
    )
    return blocks.select(F.concat(header, F.col("block"), F.lit("\r\n\r")).alias("value"))


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", *,
    least: int = LEAST_PAYLOAD, archive_records: int = ARCHIVE_RECORDS, archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write a WARC record for each row of ``pages`` to uncompressed archives below ``path``.

    An archive has at most ``archive_records`` records, and fewer if the longest record asks for it, so that it stays
    below ``archive_bytes`` (or holds one record).

    Of pages with equal payloads of at least ``least`` bytes, that with the smallest page_id is a response, the others
    are revisits that refer to it. A NULL html is an empty payload, a NULL or empty url is put as the record's own name,
    a NULL page_id as an empty one (it is a revisit of any other page with its payload). Rows that repeat a page_id and
    payload are all responses. Payloads are not shuffled unless the table of revisits outgrows Spark's limit for
    broadcasts. Every record ends in a line feed, so Spark's text writer writes the bytes of an archive as they are.
    """
    sums = payload_sums(pages, page_id, url, html)
    longest = sums.agg(F.max("record")).first()[0] or 1
    most = max(1, min(archive_records, archive_bytes // longest))
    found = records(pages, revisits_of(sums, least), page_id, url, html)
    found.write.option("maxRecordsPerFile", most).option("lineSep", "\n").text(path)


@dataclass
class Record:
    """A record that passed all checks: where it lies in its archive, its header fields (lower-case names), its block."""

    start: int
    end: int
    fields: dict[str, str]
    block: bytes = field(repr=False)

    def payload(self) -> bytes:
        if self.fields.get("content-type", "").startswith("application/http"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block

    def http_length(self) -> int | None:
        found = re.search(rb"(?i)\r\ncontent-length: *(\d+)\r\n", self.block.partition(b"\r\n\r\n")[0] + b"\r\n")
        return int(found[1]) if found else None


@dataclass
class Gap:
    """Bytes that no record could be read from, and what failed first."""

    start: int
    end: int
    reason: str


class Damaged(ValueError):
    pass


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


class Places:
    """Where patterns next occur in an archive. A place that was found is kept until it is passed, so each byte is searched once."""

    def __init__(self, data: bytes):
        self.data, self.found = data, {}

    def next(self, sign: bytes | re.Pattern, at: int) -> tuple[int, int]:
        """Begin and end of the first occurrence at or behind ``at``; twice the end of the archive if there is none."""
        found = self.found.get(sign)
        if found is None or found[0] < at:
            if isinstance(sign, bytes):
                begin = self.data.find(sign, at)
                found = (begin, begin + len(sign)) if begin >= 0 else None
            else:
                match = sign.search(self.data, at)
                found = match.span() if match else None
            found = self.found[sign] = found or (len(self.data), len(self.data))
        return found


def parse_record(data: bytes, at: int, places: Places | None = None) -> Record:
    """The record that begins at ``at``; raises Damaged where a check fails."""
    if not VERSION.match(data, at):
        raise Damaged("no version line")
    # A head may have any length; a line that is a version line belongs to the next record.
    head_end, begin = (places or Places(data)).next(HEAD_END, at)
    if begin - head_end < 4:
        raise Damaged("header without end")
    fields: dict[str, str] = {}
    line_at = data.find(b"\r\n", at, head_end)
    while line_at >= 0:
        line_end = data.find(b"\r\n", line_at + 2, head_end)
        line = data[line_at + 2 : head_end if line_end < 0 else line_end]
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without name")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        line_at = line_end
    if not fields.get("content-length", "").isdigit():
        raise Damaged("no content length")
    end = begin + int(fields["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("block does not end where its length says")
    block = data[begin:end]
    name, _, digest = fields.get("warc-block-digest", "").partition(":")
    if name == "sha1" and sha1_base32(block) != digest:
        raise Damaged("block digest differs")
    return Record(at, end + 4, fields, block)


def inflate(data: bytes, at: int) -> tuple[bytes, int]:
    """The gzip member that begins at ``at``, and where it ends."""
    stream, out, fed = zlib.decompressobj(31), [], at
    try:
        while not stream.eof:
            chunk = data[fed : fed + FEED]
            if not chunk:
                raise Damaged("member without end")
            fed += len(chunk)
            out.append(stream.decompress(chunk))
    except zlib.error as error:
        raise Damaged("member does not inflate") from error
    return b"".join(out), fed - len(stream.unused_data)


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """All records of an archive, plain or of gzip members, and the gaps between them; together they cover it.

    Where a record or member fails a check, the search goes on at the next byte that may begin a member or a version
    line; what lies between the failure and the next sound record is one gap. A member may hold
    several records; damage inside it is one gap of the whole member, and its sound records are kept.
    """
    at, gap, reason = 0, None, ""
    places = Places(data)
    while at < len(data):
        try:
            if data.startswith(GZIP_MEMBER, at):
                raw, end = inflate(data, at)
                found = list(salvage(raw)) if raw else []
                whole = [Record(at, end, r.fields, r.block) for r in found if isinstance(r, Record)]
                if not whole:
                    raise Damaged("member without record")
                broken = next((g.reason for g in found if isinstance(g, Gap)), None)
            else:
                whole, broken = [parse_record(data, at, places)], None
                end = whole[0].end
        except Damaged as error:
            gap, reason = (at, str(error)) if gap is None else (gap, reason)
            # A cut-off record may end within a line, so a version line is looked for anywhere; what it begins must pass all checks.
            at = min(places.next(GZIP_MEMBER, at + 1)[0], places.next(VERSION_LINE, at + 1)[0])
            continue
        if gap is not None:
            yield Gap(gap, at, reason)
            gap = None
        yield from whole
        if broken:
            yield Gap(at, end, f"inside a member: {broken}")
        at = end
    if gap is not None:
        yield Gap(gap, len(data), reason)


READ = (
    "archive string, start bigint, end bigint, gap string, warc_type string, record_id string, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes bigint, payload binary"
)


def read_archives(spark: SparkSession, path: str, *, payload: bool = True) -> DataFrame:
    """One row per record and per gap of the archives below ``path``.

    Gaps (quarantined bytes) have the failed check in ``gap`` and no record columns; records have NULL there. The
    payload digest of a response is computed from its payload; that of a revisit, and the length of the payload it
    stands for, are what its header says. Each archive is read whole by one task, so archives should be rotated as
    usual; an empty archive gives no rows. Whether an archive is compressed is seen from its bytes.
    """
    ship(spark)
    schema = arrow_schema(READ)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows, held = [], 0
                for found in salvage(content.as_py()):
                    rows.append(read_row(archive.as_py(), found, payload))
                    held += found.end - found.start if payload else 0
                    if len(rows) >= 5000 or held > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, READ)


def read_row(archive: str, found: Record | Gap, payload: bool) -> dict:
    row = {"archive": archive, "start": found.start, "end": found.end}
    if isinstance(found, Gap):
        return row | {"gap": found.reason}
    names = {"warc_type": "warc-type", "record_id": "warc-record-id", "refers_to": "warc-refers-to", "target_uri": "warc-target-uri"}
    row |= {n: found.fields.get(header) for n, header in names.items()}
    if row["warc_type"] == "revisit":
        digest = found.fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        return row | {"payload_digest": digest, "payload_bytes": found.http_length()}
    body = found.payload()
    return row | {"payload_digest": sha1_base32(body), "payload_bytes": len(body), "payload": body if payload else None}


def page_of(urn_column: str) -> Column:
    """The page id of a record's name; NULL for an empty one."""
    return F.regexp_extract(urn_column, r"^<urn:page:(.*)>$", 1)

"""WARC archives: a writer, and a reader that salvages damaged archives.

Writing is a DataFrame of whole records and Spark's text sink: a record is
UTF-8 text, and the sink's line separator is the two empty lines that end a
record. Task commits make a lost executor harmless.

Reading takes each archive's bytes, plain or gzip (one member per record, or
several records in a member). A record is checked: header syntax, declared
length, end mark, payload digest, gzip checksum. After a failed check the
reader searches for the next position where a valid member or record begins, goes on from
there, and logs the bytes between as a quarantined gap. Inside a member it searches the
decompressed bytes alike; of a member that ends early or fails its checksum it
takes the sound records that come before, and logs the member as a gap as well.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .keys import stage

REVISIT_BYTES = 1000      # equal payloads from this size on are stored once
RECORDS_PER_FILE = 4000
FILE_BYTES = 512 << 20    # no archive is written larger, unless one record is
DATE = "2024-01-01T00:00:00Z"

# --- fixed values of the format ---------------------------------------------
VERSION = "WARC/1.0"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
GZIP_MAGIC = b"\x1f\x8b\x08"
# ---------------------------------------------------------------------------


def _line(name: str, value):
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(value) one WARC record per row of ``pages`` (page_id, url, html),
    without its end mark. Of rows with equal payloads of ``revisit_bytes`` or
    more, the one with the largest page_id is the response and the others
    revisit it; rows that share that page_id, and groups of null ids alone, are
    responses. A null html is an empty payload, a null url an empty one."""
    html = F.coalesce("html", F.lit(""))
    p = pages.select(F.col("page_id"), F.translate(F.coalesce("url", F.lit("")), "\r\n", "").alias("url"),
                     html.alias("html"), F.octet_length(html).alias("bytes"),
                     F.sha1(F.encode(html, "UTF-8")).alias("digest"))
    holders = stage(p.filter(F.col("bytes") >= revisit_bytes).groupBy("digest")
                    .agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n"))
                    .filter("n > 1 and holder is not null").select("digest", "holder"), "holders")
    p = p.join(holders, "digest", "left")
    revisit = F.col("holder").isNotNull() & ~F.col("holder").eqNullSafe(F.col("page_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit(VERSION + "\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", ident(F.col("page_id"))), _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(revisit, F.concat(_line("WARC-Refers-To", ident(F.col("holder"))),
                                 _line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")))
    return p.select(F.concat(head, F.lit("\r\n"), block).alias("value"))


def write_archives(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES,
                   records_per_file: int = RECORDS_PER_FILE, file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages`` as plain WARC files under ``path``, of at most
    ``records_per_file`` records, and of so few that even the largest ones fit
    ``file_bytes`` (a file of one record may be larger)."""
    made = records(pages, revisit_bytes)
    # a record is its payload and a head of a few hundred bytes and the address
    largest = pages.agg(F.max(F.coalesce(F.octet_length("html"), F.lit(0)) + F.coalesce(F.octet_length("url"), F.lit(0)))).first()[0] or 0
    made.write.option("lineSep", END) \
        .option("maxRecordsPerFile", max(1, min(records_per_file, file_bytes // (largest + 1024)))).text(path)


class Damaged(Exception):
    """A check failed."""


def _digest_ok(declared: str, payload: bytes) -> bool:
    name, _, value = declared.partition(":")
    if name.lower() not in ("sha1", "md5", "sha256"):
        return True                                   # an algorithm that is not known here proves nothing
    raw = hashlib.new(name.lower(), payload)
    return value.lower() == raw.hexdigest() or value.upper().rstrip("=") == base64.b32encode(raw.digest()).decode().rstrip("=")


def read_record(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """(headers in lower case, payload, end) of the record at ``at``, or Damaged."""
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        raise Damaged("header does not end")
    lines = data[at:head_end].split(b"\r\n")
    if not re.fullmatch(rb"WARC/\d+\.\d+", lines[0]):
        raise Damaged("no version line")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!-9;-~]+", name):
            raise Damaged("bad header line")
        try:
            headers[name.decode().lower()] = value.strip().decode("utf-8")
        except UnicodeDecodeError:
            raise Damaged("bad header line") from None
    length = headers.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length) or "warc-type" not in headers:
        raise Damaged("no length or type")
    begin, end = head_end + 4, head_end + 4 + int(length)
    if data[end:end + 4] != b"\r\n\r\n":
        raise Damaged("no end mark at the declared length")
    payload = data[begin:end]
    if headers.get("content-type", "").startswith("application/http"):
        _, empty, payload = payload.partition(b"\r\n\r\n")
        if not empty:
            raise Damaged("no end of the HTTP header")
    if headers["warc-type"] != "revisit" and not _digest_ok(headers.get("warc-payload-digest", ""), payload):
        raise Damaged("payload digest differs")
    return headers, payload, end + 4


def _inflated(data: bytes, at: int) -> tuple[bytes, int, str, bool]:
    """(bytes, end, reason, sure) of the gzip member at ``at``: without a reason
    the member is whole; otherwise the bytes are those before the failure, and
    ``sure`` tells that the member only ends early."""
    z, parts, read = zlib.decompressobj(31), [], at
    try:
        while not z.eof and read < len(data):
            parts.append(z.decompress(data[read:read + (1 << 16)]))
            read += 1 << 16
    except zlib.error:
        # the failing piece again, in small steps, for what comes before the failure
        z = zlib.decompressobj(31)
        parts = [z.decompress(data[at:read])] if read > at else []
        try:
            for i in range(read, min(read + (1 << 16), len(data)), 64):
                parts.append(z.decompress(data[i:i + 64]))
        except zlib.error:
            pass
        return b"".join(parts), at, "bad gzip member", False
    if not z.eof:
        return b"".join(parts), at, "gzip member does not end", True
    return b"".join(parts), min(read, len(data)) - len(z.unused_data), "", True


def _inside(plain: bytes, sure: bool):
    """The records and gaps of decompressed bytes: (headers, payload) or
    (first, end, reason). Unless the bytes are ``sure``, a record must prove itself by a digest."""
    at, bad, why = 0, None, ""
    while at < len(plain):
        try:
            headers, payload, end = read_record(plain, at)
            if not sure and not (headers.get("warc-payload-digest") and headers["warc-type"] != "revisit"):
                raise Damaged("no digest to trust in a damaged member")
        except Damaged as e:
            if bad is None:
                bad, why = at, str(e)
            found = plain.find(b"WARC/", at + 1)
            at = found if found >= 0 else len(plain)
            continue
        if bad is not None:
            yield bad, at, why
            bad = None
        yield headers, payload
        at = end
    if bad is not None:
        yield bad, len(plain), why


def _start(data: bytes, at: int) -> int:
    """Where the next member or version line may begin, from ``at`` on."""
    places = [i for i in (data.find(GZIP_MAGIC, at), data.find(b"WARC/", at)) if i >= 0]
    return min(places, default=len(data))


def salvage(data: bytes):
    """Yield ("record", offset, end, headers, payload) and ("gap", offset, end,
    reason, None) in the order of the archive; they cover all of it. Records and
    gaps inside a member have the member's offsets. What is left of a damaged
    member has those of the gap that it leaves, and its records follow the gap."""
    at, bad, why, rest = 0, None, "", []

    def closed(end):
        yield "gap", bad, end, why, None
        for headers, payload in rest:
            yield "record", bad, end, headers, payload

    while at < len(data):
        found, failed = [], ""
        if data.startswith(GZIP_MAGIC, at):
            plain, end, failed, sure = _inflated(data, at)
            found = list(_inside(plain, sure))
        else:
            try:
                headers, payload, end = read_record(data, at)
                found = [(headers, payload)]
            except Damaged as e:
                failed = str(e)
        if failed:
            kept = [f for f in found if len(f) == 2]
            if bad is None:
                bad, why = at, failed
            elif kept:                          # a second damaged member is a gap of its own
                yield from closed(at)
                bad, why, rest = at, failed, []
            rest = rest + kept
            at = _start(data, at + 1)
            continue
        if bad is not None:
            yield from closed(at)
            bad, rest = None, []
        for f in found:
            if len(f) == 2:
                yield "record", at, end, *f
            else:
                yield "gap", at, end, f"{f[2]} (bytes {f[0]} to {f[1]} of the member)", None
        at = end
    if bad is not None:
        yield from closed(len(data))


ROWS = "path string, kind string, offset long, end long, reason string, headers map<string,string>, payload binary"


def _salvaged(batches):
    import pyarrow as pa
    kind = pa.schema([("path", pa.string()), ("kind", pa.string()), ("offset", pa.int64()), ("end", pa.int64()),
                      ("reason", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
    for batch in batches:
        for i in range(batch.num_rows):
            path, rows, size = batch.column(0)[i].as_py(), [], 0
            for what, at, end, more, payload in salvage(batch.column(1)[i].as_buffer().to_pybytes()):
                gap = what == "gap"
                rows.append({"path": path, "kind": what, "offset": at, "end": end, "reason": more if gap else None,
                             "headers": None if gap else list(more.items()), "payload": payload})
                size += len(payload or b"")
                if len(rows) >= 1000 or size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, kind)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, kind)


def read_archives(spark: SparkSession, path) -> DataFrame:
    """Rows (path, kind, offset, end, reason, headers, payload) of the
    archives under ``path``: kind "record" with headers (names in lower case)
    and payload (an HTTP message's body), or kind "gap" with the reason. An
    archive is one task's work, since its records can only be told apart in
    order; writers bound its size."""
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "content")
    return files.mapInArrow(_salvaged, ROWS)


def pages_of(rows: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type,
    refers_to, from what ``write_archives`` wrote."""
    r = rows.filter("kind = 'record'")
    head = lambda name: F.element_at("headers", name)
    page = lambda name: F.nullif(F.regexp_extract(head(name), "<urn:page:(.*)>", 1), F.lit("")).cast("long")
    revisit = head("warc-type") == "revisit"
    return r.select(
        page("warc-record-id").alias("page_id"),
        F.when(revisit, head("x-payload-length").cast("long")).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.when(revisit, F.regexp_replace(head("warc-payload-digest"), "^sha1:", "")).otherwise(F.sha1("payload")).alias("payload_digest"),
        head("warc-type").alias("record_type"), page("warc-refers-to").alias("refers_to"))

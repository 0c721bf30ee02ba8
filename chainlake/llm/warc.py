"""Legacy archives: ARC files read by their version's header line and declared lengths, and written on as WARC.

`arc_rows` makes ARC files of pages, of version 1 and 2 by turns, `read_arc` parses both, `to_warc` synthesises WARC/1.1 records (identifiers,
dates, types, digests), `read_warc` parses them. Archives are written by Spark's text writer, whose line separator is the
archive's record end (a string column holds any bytes), gzipped, into the shared folder, so its commit protocol covers lost and repeated
tasks; they are read through binaryFile, so any store will do.

Of records with equal payloads of at least `least_bytes`, the one with the smallest page id is a response, and the others are revisits
without a payload that refer to it. Digests are aggregated before the shuffle, so copies of one payload cost one row a task.

Identifiers are UUIDs of the page id, address, date and payload digest: the same archive converts to the same identifiers again.
Lines of the ARC file that break its grammar, or lengths beyond its end, raise ValueError with the place.

Files are bounded by bytes: records are written by class of length, the longer the fewer to a file (SIZES), so a file and its reader hold about 32 MB
at most, or a single record that is longer by itself.

Defined cases: null html is an empty payload; a null or empty address is written as "-" and read back as null; white space in addresses is
percent-encoded; a null page id is "-" and sorts last; rows that share the smallest page id and the payload all are responses; an empty
table gives empty archives; pages of up to the 2 GB that Spark holds in a value are read and written whole; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm.common import NO_ID, filesystem, read, saved, scratch_path, slices

#: Classes of records by their most bytes, None for any, and how many go to a file.
SIZES = ((1 << 14, 2048), (1 << 17, 256), (1 << 23, 4), (None, 1))
#: The header of a response that holds its page's id, as version 1 has no field for it.
PAGE_HEADER = b"X-Page-ID: "
#: Fixed values of the formats: the field lists that an ARC file's version block declares.
V1_FIELDS = "URL IP-address Archive-date Content-type Archive-length"
V2_FIELDS = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURED = "20240101000000"


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    content_type: str
    fields: dict[str, str]
    body: bytes


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file of either version, without its version block."""
    at, names = 0, None
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)].decode("utf-8", "replace").rstrip("\r")
        values = line.split(" ")
        if names is None:
            names = _version(data, at, end, line, values)
            at = end + 1 + int(values[-1])
            continue
        if end < 0 or len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"byte {at}: not an ARC header of {len(names)} fields: {line[:200]!r}")
        length = int(values[-1])
        body = data[end + 1 : end + 1 + length]
        if len(body) < length:
            raise ValueError(f"byte {at}: declares {length} bytes, but {len(body)} are left")
        at = end + 1 + length
        fields = dict(zip(names, values, strict=True))
        yield ArcRecord(fields["URL"], fields["IP-address"], fields["Archive-date"], fields["Content-type"], fields, body)


def _version(data: bytes, at: int, end: int, line: str, values: list[str]) -> list[str]:
    if not line.startswith("filedesc://") or end < 0 or not values[-1].isdigit():
        raise ValueError(f"byte {at}: no version block: {line[:200]!r}")
    block = data[end + 1 : end + 1 + int(values[-1])].decode("utf-8", "replace").split("\n")
    number = block[0].split(" ")[0]
    known = {"1": V1_FIELDS, "2": V2_FIELDS}
    if number not in known:
        raise ValueError(f"byte {at}: ARC version {number!r}")
    return (block[1].rstrip("\r") if len(block) > 1 and block[1].strip() else known[number]).split(" ")


def version_block(name: str, version: int = 2, date: str = CAPTURED) -> bytes:
    fields = {1: V1_FIELDS, 2: V2_FIELDS}[version]
    block = f"{version} 0 chainlake\n{fields}\n".encode()
    head = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"] + (["200", "-", "-", "0", name] if version == 2 else [])
    return " ".join([*head, str(len(block))]).encode() + b"\n" + block


def http_response(payload: bytes, content_type: str = "text/html; charset=utf-8", page_id: int | None = None) -> bytes:
    page = b"" if page_id is None else PAGE_HEADER + b"%d\r\n" % page_id
    return f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\nContent-Length: {len(payload)}\r\n".encode() + page + b"\r\n" + payload


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Headers with their closing blank line, and payload; all is payload if there are no HTTP headers."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block[: end + 4], block[end + 4 :]) if end >= 0 else (block, b"")


def iso(date: str) -> str:
    """An ARC date of 8 to 14 digits as WARC writes it; one that can't be read is the epoch."""
    try:
        return datetime.strptime(date.ljust(14, "0")[:14] if len(date) >= 8 else "", "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def record_id(page_id: int, url: str, date: str, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {date} {payload_digest}')}>"


def warc_record(record: ArcRecord, page_id: int, refers_to: dict | None) -> bytes:
    """Header and block of a WARC record, without the two line ends that close it. refers_to: page_id, url and date of the response
    that a revisit repeats."""
    head, payload = split_http(record.body)
    is_http = bool(head)
    sha, block = digest(payload), record.body
    kind = "response" if is_http else "resource"
    fields = [("WARC-Target-URI", record.url), ("WARC-Date", iso(record.date)), ("WARC-Record-ID", record_id(page_id, record.url, record.date, sha))]
    if record.ip not in ("-", "0.0.0.0"):
        fields.append(("WARC-IP-Address", record.ip))
    fields += [("WARC-Payload-Digest", f"sha1:{sha}"), ("X-Page-ID", "-" if page_id == NO_ID else str(page_id)), ("X-Payload-Length", str(len(payload)))]
    if refers_to is not None:
        kind, block = "revisit", head
        first, url, date = refers_to["page_id"], refers_to["url"], refers_to["date"]
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(first, url, date, sha)), ("WARC-Refers-To-Target-URI", url), ("WARC-Refers-To-Date", iso(date)), ("X-Refers-To-Page-ID", str(first))]
    fields += [("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Type", "application/http;msgtype=response" if is_http else record.content_type), ("Content-Length", str(len(block)))]
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\n{''.join(f'{k}: {v}\r\n' for k, v in fields)}\r\n".encode() + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"byte {at}: no WARC record")
        end = data.find(b"\r\n\r\n", at)
        lines = data[at : end if end >= 0 else at].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        if end < 0 or not fields.get("content-length", "").isdigit():
            raise ValueError(f"byte {at}: a WARC header without a length")
        stop = end + 4 + int(fields["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"byte {at}: the record does not end where its length says")
        yield fields, data[end + 4 : stop]
        at = stop + 4


def unpacked(data: bytes) -> bytes:
    """The content of a gzip file of one or more members, or data itself."""
    if data[:2] != b"\x1f\x8b":
        return data
    parts = []
    while data:
        d = zlib.decompressobj(31)
        parts.append(d.decompress(data) + d.flush())
        data = d.unused_data
    return b"".join(parts)


def _write(rows: DataFrame, length: Column, longest: int | None, make: Callable[[DataFrame, int], DataFrame], path: str, end: str, sizes: Sequence[tuple[int | None, int]], more: int = 0) -> None:
    """Archives of the records that make gives for rows, a folder for each class of lengths that there is; `more` records of a file are not rows'."""
    least = -1
    for k, (most, records) in enumerate(sizes):
        if k == 0 or (longest or 0) > least:
            own = rows if k == 0 and (most is None or (longest or 0) <= most) else rows.where((length > least) & (length <= most) if most is not None else length > least)
            text = make(own, records).select(F.col("record").cast("string").alias("value"))
            text.write.option("lineSep", end).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", records + more).text(f"{path}/{k}")
        if most is None:
            break
        least = most


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("content")


def arc_rows(pages: DataFrame, path: str, sizes: Sequence[tuple[int | None, int]] = SIZES, date: str = CAPTURED) -> None:
    """Write pages(page_id, url, html) as ARC files, of version 1 and 2 by turns. The page id is in a header of the response, in version 2 in the Filename
    field too."""

    def archives(rows: DataFrame, records: int) -> DataFrame:
        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = 0
            for b in slices(batches):
                out = []
                for page_id, url, html in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    version = 1 + n // records % 2
                    if n % records == 0:  # each file starts with its version block
                        out.append(version_block(f"pages-{n}.arc", version, date))
                    n += 1
                    payload = (html or "").encode("utf-8", "surrogatepass")
                    body = http_response(payload, page_id=page_id)
                    url = re.sub(r"[\s\x00-\x1f]", lambda m: "".join(f"%{x:02X}" for x in m.group().encode()), url or "-")
                    own = f"200 {digest(payload)} - 0 {'-' if page_id is None else page_id} " if version == 2 else ""
                    out.append(f"{url} 0.0.0.0 {date} text/html {own}{len(body)}\n".encode() + body)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

        return rows.mapInArrow(make, "record binary")

    rows, length = pages.select(F.col("page_id").cast("long"), "url", "html"), F.coalesce(F.octet_length("html"), F.lit(0))
    _write(rows, length, rows.agg(F.max(length)).first()[0], archives, path, "\n", sizes, 1)


def _page(record: ArcRecord, head: bytes) -> int:
    """The page id of the Filename field, or else of the response's headers."""
    name = record.fields.get("Filename", "").encode() or next((x[len(PAGE_HEADER) :] for x in head.split(b"\r\n") if x.startswith(PAGE_HEADER)), b"")
    return int(name) if name.lstrip(b"-").isdigit() else NO_ID


def to_warc(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 0, sizes: Sequence[tuple[int | None, int]] = SIZES) -> None:
    """Convert all ARC files under arc_path."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            found = [(_page(r, head), r.url, r.date, len(payload), hashlib.sha1(payload).digest()) for data in b.column(0).to_pylist() for r in parse_arc(unpacked(data)) for head, payload in [split_http(r.body)]]
            types = pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate(types)], ["page_id", "url", "date", "bytes", "sha"])

    every = saved(_files(spark, arc_path).mapInArrow(digests, "page_id long, url string, date string, bytes long, sha binary"), "digests")
    found = every.where(F.col("bytes") >= least_bytes)
    first = found.groupBy("sha", "bytes").agg(F.min(F.struct("page_id", "url", "date")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = saved(found.join(first, ["sha", "bytes"]).where("page_id > first.page_id").select("page_id", "sha", "first").distinct(), "revisits")

    def records_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            rows = []
            for data in b.column(0).to_pylist():
                for r in parse_arc(unpacked(data)):
                    head, payload = split_http(r.body)
                    rows.append((_page(r, head), hashlib.sha1(payload).digest(), r.url, r.ip, r.date, r.content_type, r.body, len(payload)))
            types = pa.int64(), pa.binary(), *[pa.string()] * 4, pa.binary(), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(types)], ["page_id", "sha", "url", "ip", "date", "type", "body", "bytes"])

    def warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = zip(*(c.to_pylist() for c in b.columns[:-1]), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([warc_record(ArcRecord(url, ip, date, kind, {}, body), page, first) for page, first, url, ip, date, kind, body in rows], pa.binary())], ["record"])

    def convert(path: str, sizes: Sequence[tuple[int | None, int]], out: str) -> None:
        rows = _files(spark, path).mapInArrow(records_of, "page_id long, sha binary, url string, ip string, date string, type string, body binary, bytes long")
        rows = rows.join(revisits, ["page_id", "sha"], "left").select("page_id", "first", "url", "ip", "date", "type", "body", "bytes")
        longest = every.agg(F.max("bytes")).first()[0]
        _write(rows, F.when(F.col("first").isNull(), F.col("bytes")).otherwise(0), longest, lambda own, _: own.mapInArrow(warc, "record binary"), out, "\r\n\r\n", sizes)

    own = [k for k in range(len(sizes)) if (at := filesystem(spark, f"{arc_path}/{k}"))[0].exists(at[1])]
    for k in own:  # archives of arc_rows have their classes already
        convert(f"{arc_path}/{k}", ((None, sizes[k][1]),), f"{warc_path}/{k}")
    if not own:
        convert(arc_path, sizes, warc_path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record; of a revisit, payload_bytes and payload_digest are those of the full payload."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: int(x) if x and x.lstrip("-").isdigit() else None
        for b in slices(batches, 1):
            out = []
            for data in b.column(0).to_pylist():
                for f, block in parse_warc(unpacked(data)):
                    payload = split_http(block)[1]
                    sha, size = f["warc-payload-digest"].removeprefix("sha1:"), int(f["x-payload-length"])
                    if f["warc-type"] != "revisit" and (digest(payload), len(payload)) != (sha, size):
                        raise ValueError(f"{f['warc-record-id']}: the payload is not the one that was written")
                    url = f["warc-target-uri"]
                    out.append((number(f["x-page-id"]), size, sha, f["warc-type"], number(f.get("x-refers-to-page-id")), None if url == "-" else url, f["warc-date"], f["warc-record-id"]))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate([pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.string()] * 3])], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "warc_date", "record_id"])

    return _files(spark, path).mapInArrow(rows, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, warc_date string, record_id string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    arc_rows(read(spark, sf_dir, "pages"), arc)
    to_warc(spark, arc, warc)
    return read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex, coalesce(url, '') AS url FROM pages),
d AS (SELECT page_id, payload_bytes, url,
  list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, CAST(1 + 5 * i AS INT), 5) AS BIGINT) >> b) & 31 AS INT), 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to FROM m"""

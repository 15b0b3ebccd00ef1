"""Web archives: ARC files in, WARC files out.

ARC (versions 1 and 2) is a version block and then records of one header line, whose fields depend on
the version, and as many bytes as the line declares.  The converter reads that, and makes what WARC
asks for and ARC lacks: record ids, ISO timestamps, record types and digests.  Records with equal
payloads become revisits of the one with the smallest key.

Files are written and read by Spark, so any store Spark reaches will do.  A file is read whole by one
task and holds at most the records of one task that wrote it; ``records_per_file`` bounds that.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import store

#: Fixed values of the formats: the fields of a record's header line in each ARC version.
ARC_FIELDS = {
    b"1": ("url", "ip", "date", "type", "length"),
    b"2": ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"),
}
NAMES_OF_VERSION = {v: b" ".join(x) for v, x in {
    b"1": (b"URL", b"IP-address", b"Archive-date", b"Content-type", b"Archive-length"),
    b"2": (b"URL", b"IP-address", b"Archive-date", b"Content-type", b"Result-code", b"Checksum", b"Location", b"Offset",
           b"Filename", b"Archive-length"),
}.items()}
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SMALLEST_REVISIT = 100
RECORDS_PER_FILE = 2_000
KEY_HEADER = b"X-Archive-Key"

ENTRY = "key long, url string, date string, type string, head binary, payload binary, payload_digest string, block_digest string"


# --- ARC -------------------------------------------------------------------------------------


def arc_record(version: bytes, url: bytes, ip: bytes, date: bytes, kind: bytes, content: bytes) -> bytes:
    """Header line and content; what version 2 adds is unknown here and written as ``-``."""
    url = url.replace(b" ", b"%20").replace(b"\n", b"%0A").replace(b"\r", b"%0D").replace(b"\t", b"%09") or b"-"
    middle = [] if version == b"1" else [b"200", b"-", b"-", b"0", b"-"]
    return b" ".join([url, ip, date, kind, *middle, b"%d" % len(content)]) + b"\n" + content


def arc_version_block(version: bytes, date: bytes) -> bytes:
    lines = version + b" 0 archive\n" + NAMES_OF_VERSION[version] + b"\n"
    # the block's own line always has the five fields of version 1
    return b"filedesc://pages.arc 0.0.0.0 %s text/plain %d\n" % (date, len(lines)) + lines


def parse_arc(data: bytes) -> Iterator[dict[str, bytes]]:
    """Records of an ARC file: the header fields by name, and ``content``.

    The version block tells the fields.  Lengths rule: content is never searched for line ends.  A file
    that breaks its own lengths raises ValueError.
    """
    at, fields = 0, ARC_FIELDS[b"1"]
    while at < len(data):
        if data[at:at + 1] == b"\n":  # the line end after a record
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)]
        first = line.startswith(b"filedesc://")
        names = ARC_FIELDS[b"1"] if first else fields
        values = line.rstrip(b"\r").split(b" ")
        if end < 0 or len(values) < len(names) or not values[-1].isdigit():
            raise ValueError(f"no ARC header at byte {at}: {line[:80]!r}")
        # a content type may hold blanks: what is too many belongs to it
        extra = len(values) - len(names)
        where = names.index("type")
        values[where:where + extra + 1] = [b" ".join(values[where:where + extra + 1])]
        record = dict(zip(names, values, strict=True))
        at = end + 1 + int(record["length"])
        if at > len(data):
            raise ValueError(f"ARC record is cut short: {line[:80]!r}")
        content = data[end + 1:at]
        if first:
            version = content.split(b" ", 1)[0]
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version!r}")
            fields = ARC_FIELDS[version]
        else:
            yield record | {"content": content}


def http_parts(content: bytes) -> tuple[bytes, bytes]:
    """Status line with headers, and payload; content that is no HTTP message is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    ends = [i + len(mark) for mark in (b"\r\n\r\n", b"\n\n") if (i := content.find(mark)) >= 0]
    cut = min(ends, default=len(content))
    return content[:cut], content[cut:]


def header(head: bytes, name: bytes) -> bytes | None:
    for line in head.split(b"\n"):
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.lower():
            return value.strip()
    return None


def iso_date(arc_date: bytes) -> str:
    """yyyymmddhhmmss (or its first parts) as WARC-Date; a date that is none becomes the epoch."""
    d = arc_date.decode("ascii", "replace")
    if not d.isdigit() or len(d) < 8:
        return "1970-01-01T00:00:00Z"
    d = d[:14].ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def write_arc(pages: DataFrame, path: str, version: str = "1", date: str = "20240101000000", records_per_file: int = RECORDS_PER_FILE) -> None:
    """Pages (page_id, url, html) as ARC files, each record an HTTP response that names its page_id."""
    v, when = version.encode(), date.encode()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        for batch in batches:
            out = []
            for key, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                body = (html or "").encode()
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n" % len(body)
                head += b"%s: %d\r\n\r\n" % (KEY_HEADER, key) if key is not None else b"\r\n"
                record = arc_record(v, (url or "").encode(), b"0.0.0.0", when, b"text/html", head + body)
                if written % records_per_file == 0:  # the writer begins a file here
                    record = arc_version_block(v, when) + b"\n" + record
                written += 1
                out.append(record)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    _write_records(pages.select("page_id", "url", "html").mapInArrow(run, "value binary"), path, "\n", records_per_file)


def _write_records(records: DataFrame, path: str, end: str, records_per_file: int) -> None:
    # the text writer puts the bytes as they are, and ``end`` after each record
    records.select(F.col("value").cast("string")).write.option("lineSep", end).option("compression", "gzip") \
        .option("maxRecordsPerFile", records_per_file).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def unpacked(content: bytes) -> bytes:
    """The bytes of a file, gzip members (one or many) undone."""
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out) if out else content


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of ARC files with what WARC asks for: see ``ENTRY``.

    ``key`` is the page id the HTTP head names, null where there is none.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("content"):
                yield from _entries(parse_arc(unpacked(file.as_py())))

    return _files(spark, path).mapInArrow(run, ENTRY)


def _entries(records: Iterator[dict[str, bytes]], batch_rows: int = 500) -> Iterator[pa.RecordBatch]:
    rows = []
    for r in records:
        head, payload = http_parts(r["content"])
        key = header(head, KEY_HEADER)
        rows.append((
            int(key) if key is not None else None, r["url"].decode("utf-8", "replace"), iso_date(r["date"]),
            "application/http; msgtype=response" if head else r["type"].decode("latin-1"), head, payload,
            hashlib.sha256(payload).hexdigest(), hashlib.sha256(r["content"]).hexdigest()))
        if len(rows) == batch_rows:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[pa.string()] * 3, pa.binary(), pa.binary(), pa.string(), pa.string()]
    names = [f.split(" ")[0] for f in ENTRY.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


# --- WARC ------------------------------------------------------------------------------------


def record_id(key: int | None, url: str, digest: str) -> str:
    """The same record always gets the same id."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key} {url} {digest}')}>"


def warc_record(fields: list[tuple[bytes, str | bytes]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", *(n + b": " + (v if isinstance(v, bytes) else v.encode()) for n, v in fields), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Converts ARC files into WARC files.

    Of the records whose payloads are equal and have 100 bytes at least, the one with the smallest key is a
    response and the others revisit it (a null key counts as largest).  The files are parsed once for the
    digests and once for the records; only digests and keys are shuffled, folded before they move.
    """
    entries = read_arc(spark, arc_path)
    digests = entries.filter(F.octet_length("payload") >= SMALLEST_REVISIT).select("payload_digest", "key", "url")
    first = F.min_by(F.struct("key", "url"), F.coalesce(F.col("key"), F.lit((1 << 63) - 1)))
    groups = digests.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"), first.alias("first")) \
        .filter("n > 1").select("payload_digest", F.col("first.key").alias("first_key"), F.col("first.url").alias("first_url"))
    joined = entries.join(store(groups, "payloads"), "payload_digest", "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                revisit = r["first_key"] is not None and r["first_key"] != r["key"]
                fields: list[tuple[bytes, str | bytes]] = [
                    (b"WARC-Type", b"revisit" if revisit else b"response"), (b"WARC-Record-ID", record_id(r["key"], r["url"], r["payload_digest"])),
                    (b"WARC-Date", r["date"]), (b"WARC-Target-URI", r["url"]), (b"Content-Type", r["type"]),
                    (b"WARC-Payload-Digest", "sha256:" + r["payload_digest"])]
                block = r["head"] if revisit else r["head"] + r["payload"]
                if revisit:
                    fields += [(b"WARC-Profile", REVISIT_PROFILE), (b"WARC-Refers-To", record_id(r["first_key"], r["first_url"], r["payload_digest"])),
                               (b"WARC-Refers-To-Key", b"%d" % r["first_key"]), (b"WARC-Payload-Length", b"%d" % len(r["payload"]))]
                else:
                    fields.append((b"WARC-Block-Digest", "sha256:" + r["block_digest"]))
                out.append(warc_record(fields, block))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    _write_records(joined.mapInArrow(run, "value binary"), warc_path, "\r\n\r\n", records_per_file)


def parse_warc(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of each record; lengths rule."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        head = data[at:end]
        length = header(head, b"Content-Length")
        if end < 0 or not head.startswith(b"WARC/") or length is None:
            raise ValueError(f"no WARC header at byte {at}")
        block = data[end + 4:end + 4 + int(length)]
        if len(block) < int(length):
            raise ValueError("WARC record is cut short")
        yield head, block
        at = end + 4 + int(length)
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError("WARC record does not end where it says")
        at += 4


RECORD = ("key long, record_id string, record_type string, target_uri string, date string, payload_digest string, "
          "payload_bytes long, refers_to string, refers_to_key long, payload binary")


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of WARC files: see ``RECORD``.  The digest of a response is computed from what is read and must be the stated one."""
    names = [f.split(" ")[0] for f in RECORD.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = [kinds[f.split(" ")[1]] for f in RECORD.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("content"):
                rows = []
                for head, block in parse_warc(unpacked(file.as_py())):
                    said = {n: (v.decode() if (v := header(head, n)) is not None else None) for n in (
                        b"WARC-Record-ID", b"WARC-Type", b"WARC-Target-URI", b"WARC-Date", b"WARC-Payload-Digest", b"WARC-Payload-Length",
                        b"WARC-Refers-To", b"WARC-Refers-To-Key")}
                    http, payload = http_parts(block)
                    key = header(http, KEY_HEADER)
                    digest, size = said[b"WARC-Payload-Digest"].removeprefix("sha256:"), len(payload)
                    if said[b"WARC-Type"] == "revisit":
                        size, payload = int(said[b"WARC-Payload-Length"]), None
                    elif hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {said[b'WARC-Record-ID']} does not match its digest")
                    refers = said[b"WARC-Refers-To-Key"]
                    rows.append((int(key) if key is not None else None, said[b"WARC-Record-ID"], said[b"WARC-Type"], said[b"WARC-Target-URI"],
                                 said[b"WARC-Date"], digest, size, said[b"WARC-Refers-To"], int(refers) if refers else None, payload if payloads else None))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), schema, strict=True)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), schema, strict=True)], names)

    return _files(spark, path).mapInArrow(run, RECORD)
